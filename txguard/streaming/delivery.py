"""Alerts, quarantine and delivery counts of a scoring stream, from one read and one parse, each row once.

Every batch is decoded once into a staging folder, parted by whether a message is usable. Alerts and
rejects are written from it into folders of this attempt, and a marker with the number of the batch
names them and holds the counts. Only folders that a marker names are read, and a batch with a marker
is done: so whatever a run that was broken off has left behind, and however often the engine repeats a
batch, a row is delivered once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from txguard.functions.features import HIGH_RISK_MERCHANTS
from txguard.operators.decode import coerce_types, decode_json
from txguard.operators.featurize import add_features
from txguard.operators.quality import tag_reasons
from txguard.operators.scoring import apply_threshold
from txguard.plans.scoring import Scorer, alerts
from txguard.schema import FIELDS
from txguard.sources.commits import Commits

DELIVERY = "batch_id long, messages long, unusable long, alerts long"
ALERTS, REJECTS = "alerts", "rejects"


class Delivery:
    """Where a stream's alerts and rejects go: a folder that every executor reaches.

    ``exclude`` names columns left out of the alerts. Alerts are key and value, as they would be
    published.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        scorer: Scorer,
        threshold: float,
        high_risk: Sequence[str] = HIGH_RISK_MERCHANTS,
        exclude: Sequence[str] = (),
    ):
        self.spark = spark
        self.path = path
        self.scorer = scorer
        self.threshold = threshold
        self.high_risk = high_risk
        self.exclude = exclude
        self.markers = Commits(spark, f"{path}/batches")

    def writer(self, messages: DataFrame, checkpoint: str) -> DataStreamWriter:
        """The stream that delivers every batch of ``messages``, not yet started."""
        return messages.writeStream.foreachBatch(self.deliver).option("checkpointLocation", checkpoint)

    def deliver(self, batch: DataFrame, batch_id: int) -> None:
        """One batch: parse, write both sides, put the marker. Does nothing for a batch that has one."""
        number = batch_id + 1
        if number in self.markers.read(after=batch_id):
            return
        attempt = f"batch-{number}-{uuid.uuid4().hex}"
        seen = Observation()
        tagged = tag_reasons(decode_json(batch)).observe(
            seen, F.count(F.lit(1)).alias("messages"), F.count("reason").alias("unusable")
        )
        staged = self._write(tagged.withColumn("usable", F.col("reason").isNull()), "staged", attempt, "usable")
        typed = coerce_types(staged.filter("usable")).select(*FIELDS)
        scored = apply_threshold(self.scorer(add_features(typed, self.high_risk)), self.threshold)
        sent = Observation()
        self._write(alerts(scored, self.exclude).observe(sent, F.count(F.lit(1)).alias("alerts")), ALERTS, attempt)
        self._write(staged.filter("NOT usable").select(*FIELDS, "raw_text", "reason"), REJECTS, attempt)
        counts = {**_counts(seen, "messages", "unusable"), **_counts(sent, "alerts")}
        self.markers.put(number, json.dumps({"folder": attempt, **counts}))

    def _write(self, rows: DataFrame, kind: str, attempt: str, *partition_by: str) -> DataFrame:
        place = f"{self.path}/{kind}/{attempt}"
        rows.write.partitionBy(*partition_by).parquet(place)
        return self.spark.read.schema(rows.schema).parquet(place)

    def read(self, kind: str) -> DataFrame:
        """The delivered rows of :data:`ALERTS` or :data:`REJECTS`, with the ``batch_id`` they came in."""
        schema = _SCHEMAS[kind]
        found = sorted(self.markers.read().items())
        folders = [f"{self.path}/{kind}/{json.loads(text)['folder']}" for _, text in found]
        if not folders:
            return self.spark.createDataFrame([], T.StructType([*schema, T.StructField("batch_id", T.LongType())]))
        number = F.regexp_extract(F.input_file_name(), rf"/{kind}/batch-(\d+)-", 1).cast("long") - 1
        return self.spark.read.schema(schema).parquet(*folders).withColumn("batch_id", number)

    def counts(self) -> DataFrame:
        """What every batch brought, one row for each: no job is needed for it but the batch's own."""
        rows = []
        for number, text in sorted(self.markers.read().items()):
            told = json.loads(text)
            rows.append((number - 1, told["messages"], told["unusable"], told["alerts"]))
        return self.spark.createDataFrame(rows, DELIVERY)


def _counts(observed: Observation, *names: str) -> dict[str, int]:
    found = observed.get
    return {name: int(found.get(name) or 0) for name in names}


_SCHEMAS = {
    ALERTS: T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]),
    REJECTS: T.StructType([T.StructField(name, T.StringType()) for name in (*FIELDS, "raw_text", "reason")]),
}
