import json

import pytest

from jobs import publish, score_batch, score_stream, train
from txguard.plans import views
from txguard.schema import FIELDS
from txguard.sources import run_log
from txguard.streaming.delivery import Delivery


@pytest.fixture(scope="module")
def home(spark, medium, tmp_path_factory):
    home = tmp_path_factory.mktemp("jobs")
    tx = views.learnable(views.transactions(spark, medium))
    views.messages(views.raw_fields(tx.select(*FIELDS))).write.text(str(home / "in"))
    train.main(
        [
            "--files", str(home / "in"), "--package", str(home / "packages"), "--runs", str(home / "runs"),
            "--rejects", str(home / "rejects"), "--n-iter", "1", "--folds", "2", "--max-trees", "3",
        ]
    )
    return home


def test_training_job_leaves_package_rejects_and_log(spark, home):
    runs = run_log.read_runs(spark, str(home / "runs"))
    kinds = {row.kind: row["count"] for row in runs.groupBy("kind").count().collect()}
    assert kinds["metric"] == 7 and kinds["model"] == 1 and kinds["param"] >= 10
    assert runs.filter("name = 'fraud_model/1'").count() == 1
    kept = runs.filter("kind = 'model'").first().value
    (matrix,) = spark.read.parquet(f"{kept}/confusion_matrix").collect()
    curve = spark.read.parquet(f"{kept}/pr_curve")
    assert curve.agg({"tp": "max"}).first()[0] == matrix.tp + matrix.fn and curve.agg({"pp": "max"}).first()[0] == sum(matrix)
    rejects = {row.reason: row["count"] for row in spark.read.parquet(str(home / "rejects")).groupBy("reason").count().collect()}
    two = rejects.pop("is_fraud")
    assert two == 103 and sum(rejects.values()) == 624


def test_scoring_jobs_agree(spark, home):
    package = run_log.read_runs(spark, str(home / "runs")).filter("kind = 'model'").first().value
    common = ["--files", str(home / "in"), "--package", package]
    score_batch.main([*common, "--alerts", str(home / "batch"), "--rejects", str(home / "batch_rejects")])
    score_stream.main(
        [
            *common, "--alerts", str(home / "stream"), "--rejects", str(home / "stream_rejects"),
            "--checkpoint", str(home / "state"), "--available-now", "--progress", str(home / "progress"),
            "--exclude", "is_fraud",
        ]
    )
    batch = spark.read.parquet(str(home / "batch"))
    stream = spark.read.parquet(str(home / "stream"))
    assert batch.count() > 0
    assert sorted(r.key for r in batch.collect()) == sorted(r.key for r in stream.collect())
    assert "is_fraud" in json.loads(batch.first().value) and "is_fraud" not in json.loads(stream.first().value)
    rejects = [spark.read.parquet(str(home / name)).count() for name in ("batch_rejects", "stream_rejects")]
    assert rejects == [624, 624]
    score_stream.main([*common, "--deliver", str(home / "delivered"), "--checkpoint", str(home / "state2"), "--available-now"])
    out = Delivery(spark, str(home / "delivered"), None, 0.5)
    assert sorted(r.key for r in out.read("alerts").collect()) == sorted(r.key for r in batch.collect())
    assert out.read("rejects").count() == 624 and out.counts().first().messages == 10_000
    seen = spark.read.parquet(str(home / "progress")).selectExpr("sum(messages)", "sum(unusable)").first()
    assert tuple(seen) == (10_000, 624)


def test_files_have_no_cap(home):
    with pytest.raises(ValueError):
        train.main(["--files", str(home / "in"), "--package", "p", "--runs", "r", "--max-messages", "5"])


def test_another_merchant_list_is_refused(spark, home):
    package = run_log.read_runs(spark, str(home / "runs")).filter("kind = 'model'").first().value
    with pytest.raises(ValueError):
        score_batch.main(["--files", str(home / "in"), "--package", package, "--high-risk-merchants", "Other"])


def test_publishing_keeps_invalid_records_back(spark, tmp_path):
    rows = [("1", "1500", "20.0", "USD", "M", "2024-05-01T10:00:00", "US", "0"), ("2", "1500", "-1", "USD", "M", "x", "US", "0")]
    spark.createDataFrame(rows, FIELDS).write.parquet(str(tmp_path / "in"))
    publish.main(["--table", str(tmp_path / "in"), "--rejects", str(tmp_path / "bad"), "--messages", str(tmp_path / "out")])
    (message,) = spark.read.parquet(str(tmp_path / "out")).collect()
    assert message.key == "1500" and json.loads(message.value)["transaction_id"] == "1"
    (bad,) = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert bad.violations == ["amount", "timestamp"]
