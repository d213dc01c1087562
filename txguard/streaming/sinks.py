"""File sink and progress of a scoring stream."""

from __future__ import annotations

from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from txguard.operators.decode import decode_json
from txguard.operators.quality import OBSERVED, counting, tag_reasons

PROGRESS = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("messages", T.LongType()),
        T.StructField("unusable", T.LongType()),
        T.StructField("duration_ms", T.LongType()),
    ]
)

def file_writer(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append-mode parquet sink, not yet started."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process all present input in as many batches as needed, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def reject_stream(messages: DataFrame, label_required: bool = False) -> DataFrame:
    """Unusable messages of a stream; all messages are counted on the way."""
    tagged = counting(tag_reasons(decode_json(messages), label_required))
    return tagged.filter(F.col("reason").isNotNull())


class ProgressLog(StreamingQueryListener):
    """Every micro-batch of the session's streams, as it happens, or of those called ``name``.

    The session itself keeps the last batches only. Here each batch becomes a row, in memory or,
    with ``path``, appended to a table at once, so a stream that never ends has its table too.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, name: str | None = None):
        self.spark = spark
        self.path = path
        self.name = name
        self.rows: dict[str, list[tuple]] = {}
        self.ended: dict[str, Event] = {}
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        self._end_of(event.runId)

    def onQueryProgress(self, event) -> None:
        batch = event.progress
        if self.name is not None and batch.name != self.name:
            return
        seen = batch.observedMetrics.get(OBSERVED)
        row = (
            batch.batchId,
            batch.numInputRows,
            seen["messages"] if seen else None,
            seen["unusable"] if seen else None,
            batch.durationMs.get("triggerExecution"),
        )
        if self.path:
            self.spark.createDataFrame([row], PROGRESS).coalesce(1).write.mode("append").parquet(self.path)
        else:
            self.rows.setdefault(str(batch.runId), []).append(row)

    def onQueryTerminated(self, event) -> None:
        self._end_of(event.runId).set()

    def _end_of(self, run_id) -> Event:
        return self.ended.setdefault(str(run_id), Event())

    def table(self, query: StreamingQuery, timeout: float = 60) -> DataFrame:
        """The batches of one ended stream; waits until its last event has arrived."""
        if not self._end_of(query.runId).wait(timeout):
            raise TimeoutError("the end of the stream has not been reported")
        if self.path:
            return self.spark.read.schema(PROGRESS).parquet(self.path)
        return self.spark.createDataFrame(self.rows.get(str(query.runId), []), PROGRESS)

    def close(self) -> None:
        self.spark.streams.removeListener(self)
