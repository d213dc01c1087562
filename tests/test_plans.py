"""What the planner makes of the main plans."""

import pytest
from pyspark.sql import functions as F

from txguard.operators.ranked import ranked_cumulative
from txguard.plans import queries, views
from txguard.sources.tables import read_table

JIT_LIMIT = 8000  # bytes of a method beyond which the JVM does not compile it


@pytest.mark.parametrize(
    "name",
    ["decode_json", "clean_rows", "rejected_rows", "validate_rules", "violation_counts", "message_feature_table", "fraud_messages"],
)
def test_generated_methods_stay_small(spark, small, name):
    df = queries.registry()[name](spark, small)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = df.select("*")._jdf.queryExecution().debug().codegenToSeq()
        sizes = [parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and max(sizes) < JIT_LIMIT


def test_hot_customer_is_split_at_run_time(spark, small):
    events = read_table(spark, small, "events").crossJoin(spark.range(40)).drop("id")
    hot = events.withColumn("user_id", F.when(F.rand(1) < 0.34, F.lit(7)).otherwise(F.col("user_id")).cast("bigint"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = views.transactions(spark, small, hot)
        rows = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(rows) == 40_000
    assert "skew=true" in plan


def test_hot_score_is_one_row_before_any_sorting(spark):
    scored = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0.5)).otherwise(F.col("id") / 9000).alias("p"), (F.col("id") % 2).cast("int").alias("is_fraud")
    )
    table = ranked_cumulative(scored)
    assert table.filter("score = 0.5").first().n >= 3000
    assert table.agg(F.max("pp")).first()[0] == 9000


def test_every_query_gives_a_stable_schema(spark, small):
    for name in ("feature_table", "message_feature_table", "evaluation_summary", "pattern_summary"):
        first, second = (queries.registry()[name](spark, small).schema for _ in range(2))
        assert first.simpleString() == second.simpleString()
