import time

import pytest
from pyspark.sql import functions as F

from txguard.operators.cap import cap_rows
from txguard.streaming.bounded import IDLE_EVENTS, read_until_idle

SCHEMA = "id long, ts long, text string"


@pytest.fixture
def files(spark, tmp_path):
    rows = spark.range(100).select(F.col("id"), (F.col("id") * 7 % 50).alias("ts"), F.lit("x").alias("text"))
    folder = str(tmp_path / "in")
    rows.repartition(5).write.parquet(folder)
    return folder


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def test_ends_when_silent(spark, files):
    started = time.monotonic()
    read = read_until_idle(stream(spark, files), 1.0)
    assert read.stopped_by == "idle" and read.rows_read == 100 and read.batches == 5
    assert sorted(row.id for row in read.rows.collect()) == list(range(100))
    assert time.monotonic() - started < 60
    assert not spark.streams.active
    assert spark.conf.get(IDLE_EVENTS, None) in (None, "10000ms", "10000")


def test_rows_that_come_before_the_time_is_up_are_read(spark, files, tmp_path):
    from threading import Timer

    late = spark.createDataFrame([(1000, 1, "late")], SCHEMA)
    timer = Timer(2.0, lambda: late.write.mode("append").parquet(files))
    timer.start()
    read = read_until_idle(stream(spark, files), 8.0)
    timer.join()
    assert read.rows.filter("id = 1000").count() == 1 and read.rows_read == 101


def test_ends_at_the_number_of_rows_and_equals_the_cap(spark, files):
    read = read_until_idle(stream(spark, files), 60.0, max_rows=90, order_by=["ts", "id"])
    assert read.stopped_by == "rows" and 90 <= read.rows_read <= 100
    # all five files are needed for 90 rows, so the result is the cap of the whole table
    if read.rows_read == 100:
        whole = cap_rows(spark.read.parquet(files), 90, ["ts", "id"])
        assert sorted(read.rows.collect()) == sorted(whole.collect())
    assert read.rows.count() == 90


@pytest.mark.parametrize("keep", ["oldest", "newest"])
def test_cap_larger_than_the_stream(spark, files, keep):
    read = read_until_idle(stream(spark, files), 1.0, max_rows=1000, order_by=["ts", "id"], keep=keep)
    assert read.stopped_by == "idle" and read.rows.count() == 100


def test_goes_on_after_it_was_broken_off(spark, files, tmp_path):
    place = {"path": str(tmp_path / "out"), "checkpoint": str(tmp_path / "state")}
    first = read_until_idle(stream(spark, files), 60.0, max_rows=20, order_by=["id"], **place)
    assert first.stopped_by == "rows"
    second = read_until_idle(stream(spark, files), 1.0, **place)
    assert second.rows_read < 100 and sorted(row.id for row in second.rows.collect()) == list(range(100))


def test_empty_streams_wrong_times_and_failures(spark, tmp_path):
    (tmp_path / "none").mkdir()
    read = read_until_idle(stream(spark, str(tmp_path / "none")), 0.5)
    assert read.stopped_by == "idle" and read.rows.collect() == [] and read.rows_read == 0
    assert read_until_idle(stream(spark, str(tmp_path / "none")), 0.5, max_rows=0).rows.collect() == []
    with pytest.raises(ValueError):
        read_until_idle(stream(spark, str(tmp_path / "none")), 0)
    spark.range(3).select(F.col("id"), F.col("id").alias("ts"), F.lit("x").alias("text")).write.parquet(str(tmp_path / "bad"))
    failing = stream(spark, str(tmp_path / "bad")).withColumn("text", F.raise_error(F.lit("broken row")).cast("string"))
    with pytest.raises(Exception, match="broken row"):
        read_until_idle(failing, 5.0)
    assert not spark.streams.active
