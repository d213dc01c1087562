import pytest
from pyspark.sql import functions as F

from txguard.operators import patterns
from txguard.plans import views

SCHEMA = "transaction_id string, user_id int, amount double, merchant string, location string, is_fraud int"


def tx(spark, *rows):
    return spark.createDataFrame([(str(i), *row, 0) for i, row in enumerate(rows)], SCHEMA)


def watch(spark, *users):
    return spark.createDataFrame([(user,) for user in users], "user_id int")


def in_order(df, name):
    return [row[name] for row in df.orderBy("transaction_id").collect()]


def test_takeover_needs_list_and_amount(spark):
    rows = tx(spark, (1001, 500.0, "M", "US"), (1001, 500.01, "M", "US"), (1002, 900.0, "M", "US"), (None, 900.0, "M", "US"))
    flagged = patterns.account_takeover(rows, watch(spark, 1001, 1001, None))
    assert in_order(flagged, "rule_account_takeover") == [0, 1, 0, 0]
    assert flagged.count() == 4


def test_long_list_gives_the_same_answer(spark, small):
    rows = views.transactions(spark, small)
    listed = views.watch_list(rows)
    short = patterns.mark_watch_list(rows, listed)
    spread = patterns.mark_watch_list(rows, listed, max_broadcast=0, salts=7)
    assert short.exceptAll(spread).isEmpty() and spread.exceptAll(short).isEmpty()
    assert short.count() == rows.count()


def test_short_list_is_broadcast(spark, small):
    rows = views.transactions(spark, small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = patterns.mark_watch_list(rows, views.watch_list(rows))._jdf.queryExecution().executedPlan().toString()
        long_plan = patterns.mark_watch_list(rows, views.watch_list(rows), max_broadcast=0)
        long_plan = long_plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan
    assert "BroadcastHashJoin" not in long_plan and "_salt" in long_plan


def test_hot_user_is_dealt_to_many_partitions(spark):
    hot = spark.range(20_000).selectExpr("cast(id as string) transaction_id", "cast(1001 as int) user_id", "600.0D amount")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        marked = patterns.mark_watch_list(hot, watch(spark, 1001), max_broadcast=0, salts=64)
        sizes = marked.selectExpr("spark_partition_id() p").groupBy("p").count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 8 and max(row["count"] for row in sizes) < 20_000 / 2
    assert marked.filter("on_watch_list").count() == 20_000


def test_card_testing(spark):
    rows = tx(spark, (2000, 1.5, "M", "US"), (2000, 2.0, "M", "US"), (2001, 1.5, "M", "US"), (2000, None, "M", "US"))
    assert in_order(patterns.card_testing(rows), "rule_card_testing") == [1, 0, 0, 0]


def test_collusion(spark):
    rows = tx(spark, (1, 300.0, "QuickCash", "US"), (1, 300.01, "QuickCash", "US"), (1, 900.0, "M", "US"), (1, 900.0, None, "US"))
    assert in_order(patterns.merchant_collusion(rows), "rule_merchant_collusion") == [0, 1, 0, 0]


def test_geo(spark):
    rows = tx(spark, (1500, 1.0, "M", "cn"), (1501, 1.0, "M", "NG"), (0, 1.0, "M", None))
    flagged = patterns.geo_anomaly(rows)
    assert in_order(flagged, "rule_geo_anomaly") == [1, 0, 1]
    assert in_order(flagged, "high_risk_location") == [1, 1, 0]


def test_first_match_wins(spark):
    rows = tx(
        spark,
        (2000, 600.0, "QuickCash", "US"),
        (3000, 1.0, "QuickCash", "US"),
        (3000, 400.0, "QuickCash", "US"),
        (3000, 200.0, "QuickCash", "US"),
        (3001, 200.0, "QuickCash", "US"),
    )
    named = patterns.fraud_pattern(rows, watch(spark, 2000))
    assert in_order(named, "pattern") == ["account_takeover", "card_testing", "merchant_collusion", "geo_anomaly", "none"]
    summary = {row.pattern: row for row in patterns.pattern_summary(named).collect()}
    assert len(summary) == 5 and summary["none"].n == 1 and summary["none"].share == 0.2


def test_long_list_copies_hot_users_only(spark):
    # one user with a third of all rows, rows without an id, and a list that is not copied as a whole
    rows = spark.range(3000).select(
        F.lit(None).cast("string").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("user_id"),
        "id",
    )
    listed = spark.range(0, 3000, 7).select(F.col("id").cast("int").alias("user_id"))
    marked = patterns.mark_watch_list(rows, listed, max_broadcast=0)
    assert marked.filter("on_watch_list <> (user_id % 7 = 0)").count() == 0 and marked.count() == 3000
    assert [row.user_id for row in patterns._hot_users(rows).collect()] == [7]
    spread = marked.collect()
    assert sum(row.user_id == 7 for row in spread) >= 1000


# Chi-square statistics and their upper tails, from published tables.
@pytest.mark.parametrize(
    ("statistic", "freedom", "beyond"),
    [(3.841459, 1, 0.05), (7.814728, 3, 0.05), (11.344867, 3, 0.01), (0.584374, 3, 0.9), (18.307038, 10, 0.05), (0.0, 3, 1.0), (5000.0, 3, 0.0)],
)
def test_upper_tail_of_chi_square(spark, statistic, freedom, beyond):
    row = spark.range(1).select(patterns.chi_square_beyond(F.lit(statistic), freedom).alias("p")).first()
    assert row.p == pytest.approx(beyond, abs=1e-6)


def test_fit_to_a_mix(spark):
    counts = {"account_takeover": 45, "card_testing": 30, "merchant_collusion": 25, None: 70, "other": 9}
    frame = spark.createDataFrame([(name,) for name, n in counts.items() for _ in range(n)], "pattern string")
    rows = {row.pattern: row for row in patterns.pattern_fit(frame).collect()}
    assert {name: (row.n, row.expected) for name, row in rows.items()} == {
        "account_takeover": (45, 40.0), "card_testing": (30, 30.0), "merchant_collusion": (25, 20.0), "geo_anomaly": (0, 10.0)
    }
    assert rows["geo_anomaly"].statistic == pytest.approx(25 / 40 + 25 / 20 + 10) and rows["geo_anomaly"].p_value == pytest.approx(0.0078, abs=1e-3)
    assert {(row.statistic, row.p_value) for row in patterns.pattern_fit(frame.filter("false")).collect()} == {(0.0, 1.0)}
    with pytest.raises(ValueError):
        patterns.pattern_fit(frame, {"a": 0.5})
