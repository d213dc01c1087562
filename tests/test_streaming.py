from pyspark.sql import functions as F

from txguard.operators.decode import decode_json
from txguard.operators.quality import counting, tag_reasons
from txguard.plans import views
from txguard.plans.scoring import alerts, score_messages
from txguard.streaming import sinks


def fixed_scorer(features):
    return features.withColumn("fraud_probability", views.fixed_score())


def messages_in(spark, tx, folder):
    views.clean_messages(tx).repartition(3).write.mode("append").text(str(folder))


def run(spark, folder, tmp_path):
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(folder))
    found = alerts(score_messages(stream, fixed_scorer, 0.5))
    return sinks.run_available(sinks.file_writer(found, str(tmp_path / "out"), str(tmp_path / "checkpoint")))


def test_stream_equals_batch_over_several_batches(spark, small, tmp_path):
    tx = views.transactions(spark, small)
    messages_in(spark, tx, tmp_path / "in")
    run(spark, tmp_path / "in", tmp_path)
    batch = alerts(score_messages(spark.read.text(str(tmp_path / "in")), fixed_scorer, 0.5))
    streamed = spark.read.parquet(str(tmp_path / "out"))
    assert streamed.count() == batch.count() > 0
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_restart_continues_after_the_checkpoint(spark, small, tmp_path):
    tx = views.transactions(spark, small)
    early, late = tx.filter("transaction_id % 2 = 0"), tx.filter("transaction_id % 2 = 1")
    messages_in(spark, early, tmp_path / "in")
    run(spark, tmp_path / "in", tmp_path)
    first = spark.read.parquet(str(tmp_path / "out")).count()
    messages_in(spark, late, tmp_path / "in")
    run(spark, tmp_path / "in", tmp_path)
    rows = spark.read.parquet(str(tmp_path / "out"))
    expected = alerts(score_messages(views.clean_messages(tx), fixed_scorer, 0.5))
    assert 0 < first < rows.count() == expected.count()
    assert rows.select("key").distinct().count() == rows.count()


def test_progress_counts_every_message(spark, small, tmp_path):
    tx = views.transactions(spark, small)
    bad = spark.createDataFrame([("not json",), ("{}",)], "value string")
    views.clean_messages(tx).union(bad).repartition(2).write.text(str(tmp_path / "in"))
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "in"))
    tagged = counting(tag_reasons(decode_json(stream)))
    writer = sinks.file_writer(tagged.select("reason"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    log = sinks.ProgressLog(spark, str(tmp_path / "progress"))
    table = log.table(sinks.run_available(writer)).filter("input_rows > 0")
    log.close()
    total = table.agg(F.sum("input_rows"), F.sum("messages"), F.sum("unusable"), F.countDistinct("batch_id")).first()
    assert tuple(total) == (tx.count() + 2, tx.count() + 2, 2, 2)


def test_scoring_plan_has_no_shuffle(spark, tmp_path):
    batch = spark.createDataFrame([("{}",)], "value string")
    plan = alerts(score_messages(batch, fixed_scorer, 0.5))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
