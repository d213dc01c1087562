import json

import pytest
from pyspark.sql import functions as F

from txguard.operators import scoring
from txguard.streaming import sinks
from txguard.streaming.delivery import ALERTS, REJECTS, Delivery


def message(k, amount):
    return json.dumps(
        {"transaction_id": str(k), "user_id": 1000 + k, "amount": amount, "currency": "USD", "merchant": "QuickCash",
         "timestamp": "2024-05-01T03:00:00+00:00", "location": "US", "is_fraud": 0}
    )


@pytest.fixture
def source(spark, tmp_path):
    folder = str(tmp_path / "in")
    lines = [(message(k, 900.0 if k % 3 == 0 else 5.0),) for k in range(30)] + [("not json",), ("{}",)]
    spark.createDataFrame(lines, "value string").repartition(4).write.text(folder)
    return folder


def scorer(df):
    return df.withColumn(scoring.SCORE, F.when(F.col("amount") > 500, 0.9).otherwise(0.1))


def run(spark, source, tmp_path, kind=Delivery):
    out = kind(spark, str(tmp_path / "out"), scorer, 0.5)
    messages = spark.readStream.option("maxFilesPerTrigger", 1).text(source)
    sinks.run_available(out.writer(messages, str(tmp_path / "state")))
    return out


def check(out):
    keys = sorted(int(row.key) for row in out.read(ALERTS).collect())
    assert keys == [k for k in range(30) if k % 3 == 0] or keys == [1000 + k for k in range(30) if k % 3 == 0]
    rejects = out.read(REJECTS)
    assert sorted(str(row.raw_text) for row in rejects.collect()) == ["None", "not json"]  # an object decodes, though nothing is in it
    total = out.counts().agg(F.sum("messages"), F.sum("unusable"), F.sum("alerts"), F.count("*")).first()
    assert tuple(total) == (32, 2, 10, 4)
    by_batch = {row.batch_id: row.alerts for row in out.counts().collect()}
    found = {row.batch_id: row["count"] for row in out.read(ALERTS).groupBy("batch_id").count().collect()}
    assert {k: n for k, n in by_batch.items() if n} == found


def test_every_row_once(spark, source, tmp_path):
    check(run(spark, source, tmp_path))


@pytest.mark.parametrize("where", [ALERTS, REJECTS, "marker", "after"])
def test_a_run_killed_on_the_way_and_restarted(spark, source, tmp_path, where):
    class Killed(Delivery):
        batches = 0

        def deliver(self, batch, batch_id):
            self.batches += 1
            if self.batches == 2 and where == "marker":
                put, self.markers.put = self.markers.put, None
                try:
                    super().deliver(batch, batch_id)
                finally:
                    self.markers.put = put
            super().deliver(batch, batch_id)
            if self.batches == 2 and where == "after":
                raise RuntimeError("killed")

        def _write(self, rows, kind, *others):
            written = super()._write(rows, kind, *others)
            if self.batches == 2 and kind == where:
                raise RuntimeError("killed")
            return written

    with pytest.raises(Exception):
        run(spark, source, tmp_path, Killed)
    check(run(spark, source, tmp_path))


def test_nothing_delivered_yet(spark, tmp_path):
    out = Delivery(spark, str(tmp_path / "out"), scorer, 0.5)
    assert out.read(ALERTS).columns == ["key", "value", "batch_id"] and out.read(ALERTS).count() == 0
    assert out.counts().count() == 0
