import json
import pickle
from pathlib import Path

import pytest
from amount_model import AmountModel
from pyspark.sql import functions as F

from txguard.operators import scoring
from txguard.operators.featurize import add_features
from txguard.plans import views
from txguard.plans.scoring import alerts, messages_to_features, score_messages


def scores(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "fraud_probability double")


def test_equal_to_the_threshold_is_fraud(spark):
    rows = scoring.apply_threshold(scores(spark, 0.49, 0.5, 0.51, None, float("nan")), 0.5)
    assert [row.prediction for row in rows.collect()] == [0, 1, 1, 0, 0]
    assert scoring.fraud_only(rows).count() == 2


def test_adapter_takes_function_or_model(spark, small):
    features = add_features(views.transactions(spark, small))
    by_function = scoring.score_with_python(features, predict=lambda batch: (batch["amount"] > 500).astype(float))
    spark.sparkContext.addPyFile(str(Path(__file__).with_name("amount_model.py")))
    by_model = scoring.score_with_python(features, model=AmountModel())
    for scored in (by_function, by_model):
        assert scored.filter((F.col("fraud_probability") == 1.0) != (F.col("amount") > 500)).isEmpty()
    with pytest.raises(ValueError):
        scoring.score_with_python(features)


def test_file_is_loaded_once_by_a_worker(spark, small, tmp_path):
    features = add_features(views.transactions(spark, small)).repartition(24)
    spark.sparkContext.addPyFile(str(Path(__file__).with_name("amount_model.py")))
    place, loads = tmp_path / "amount-model-7.pickle", str(tmp_path)
    place.write_bytes(pickle.dumps(AmountModel()))

    def load(path):
        import os
        import uuid

        Path(f"{loads}/load-{os.getpid()}-{uuid.uuid4().hex}").touch()
        return pickle.loads(Path(path).read_bytes())

    scored = scoring.score_with_file(features, str(place), load)
    for _ in range(2):
        assert scored.filter((F.col("fraud_probability") == 1.0) != (F.col("amount") > 500)).isEmpty()
    by_model = scoring.score_with_python(features, model=AmountModel())
    assert sorted(r.fraud_probability for r in scored.collect()) == sorted(r.fraud_probability for r in by_model.collect())
    workers = [found.name.split("-")[1] for found in tmp_path.glob("load-*")]
    assert workers and len(workers) == len(set(workers))


def test_large_models_are_not_broadcast(spark, small, monkeypatch):
    monkeypatch.setattr(scoring, "MAX_BROADCAST_BYTES", 10)
    with pytest.raises(ValueError, match="score_with_file"):
        scoring.score_with_python(add_features(views.transactions(spark, small)), model=AmountModel())


def test_python_model_runs_once(spark, small):
    messages = views.clean_messages(views.transactions(spark, small))

    def scorer(features):
        return scoring.score_with_python(features, predict=views.fixed_score_model())

    plan = alerts(score_messages(messages, scorer, 0.5))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert plan.count("from_json(") == 1


def test_both_ways_of_the_fixed_score_agree(spark, small):
    features = add_features(views.transactions(spark, small))
    in_jvm = features.withColumn("fraud_probability", views.fixed_score())
    in_python = scoring.score_with_python(features, predict=views.fixed_score_model())
    a, b = (df.select("transaction_id", F.round("fraud_probability", 9).alias("p")) for df in (in_jvm, in_python))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_message_layout(spark):
    rows = spark.createDataFrame([("7", 1.5, None, 1)], "transaction_id string, amount double, merchant string, is_fraud int")
    row = scoring.to_messages(rows).first()
    assert row.key == "7"
    assert json.loads(row.value) == {"transaction_id": "7", "amount": 1.5, "is_fraud": 1}
    assert "is_fraud" not in scoring.to_messages(rows, exclude=["is_fraud"]).first().value


def test_unusable_messages_are_never_scored(spark):
    messages = spark.createDataFrame([("not json",), ("{}",)], "value string")
    assert messages_to_features(messages).isEmpty()
