from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from txguard.operators import cap


def shuffled(spark, n=1000):
    return spark.range(n).select(F.pmod(F.col("id") * 617, F.lit(n)).alias("t"), "id")


@pytest.mark.parametrize("keep, expected", [("oldest", range(100)), ("newest", range(900, 1000))])
def test_both_sides(spark, keep, expected):
    kept = cap.cap_rows(shuffled(spark), 100, ["t", "id"], keep)
    assert sorted(row.t for row in kept.collect()) == list(expected)


@pytest.mark.parametrize("n", [1, 7, 499, 501, 999])
def test_one_hot_first_key(spark, n):
    rows = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 10).alias("t"), "id")
    wanted = sorted((r.t, r.id) for r in rows.collect())[:n]
    assert sorted(map(tuple, cap.cap_rows(rows, n, ["t", "id"]).collect())) == wanted


@pytest.mark.parametrize("keep", ["oldest", "newest"])
@pytest.mark.parametrize("n", [1, 12, 25, 31, 39, 40, 41])
def test_ties_and_missing_keys(spark, keep, n):
    # ten rows without a key, keys of five rows each, and one row ten times
    rows = [(None, k) for k in range(10)] + [(k // 5, k) for k in range(20)] + [(9, 9)] * 10
    frame = spark.createDataFrame(rows, "t int, v int")
    first = cap.cap_rows(frame, n, ["t"], keep).collect()
    again = cap.cap_rows(frame.repartition(7), n, ["t"], keep).collect()
    assert sorted(map(str, first)) == sorted(map(str, again)) and len(first) == min(n, 40)
    known = sorted((r.t for r in frame.collect() if r.t is not None), reverse=keep == "newest")
    wanted = (known + [None] * 10)[:n]
    assert sorted(map(str, (r.t for r in first))) == sorted(map(str, wanted))


def test_text_keys_and_timestamps(spark):
    start = datetime(2024, 1, 1)
    rows = spark.createDataFrame(
        [(start + timedelta(microseconds=i // 2), f"k{i:03d}") for i in range(300)], "t timestamp, k string"
    )
    for keys in (["t", "k"], ["k"]):
        kept = cap.cap_rows(rows.repartition(4), 33, keys)
        assert sorted(row.k for row in kept.collect()) == [f"k{i:03d}" for i in range(33)]


def test_a_cap_beyond_the_rows_keeps_all(spark):
    assert cap.cap_rows(shuffled(spark), 5000, ["t"]).count() == 1000
    assert cap.cap_rows(shuffled(spark).limit(0), 5, ["t"]).count() == 0
    assert cap.cap_rows(shuffled(spark), 0, ["t"]).count() == 0


def test_unknown_side(spark):
    with pytest.raises(ValueError):
        cap.cap_rows(shuffled(spark), 1, ["t"], keep="middle")


def test_the_source_is_read_three_times(spark):
    """Percentiles, keys near the cut, and the filter by constants; both sides of the union count once each."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(value):
        read.add(1)
        return value

    source = shuffled(spark).select(seen("t").alias("t"), "id")
    kept = cap.cap_rows(source, 100, ["t", "id"])
    assert read.value <= 2 * 1000
    assert kept.count() == 100
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "rangepartitioning" not in plan
