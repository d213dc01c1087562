"""Bounded reads of a stream: until nothing has come for a while, or until enough rows are there."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from threading import Condition

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from txguard.operators.cap import cap_rows
from txguard.session import work_path

# How often the engine says that a stream has nothing to do; it is ten seconds unless set.
IDLE_EVENTS = "spark.sql.streaming.noDataProgressEventInterval"


class IdleStop(StreamingQueryListener):
    """Follows one stream by its events: the rows it has read, and since when it has had nothing to do.

    Events come on a thread of the session. They only note what happened; :meth:`wait` decides on the
    caller's thread, because a stream cannot be stopped from within its own events.
    """

    def __init__(self, spark: SparkSession, name: str, clock: Callable[[], float] = time.monotonic):
        self.name = name
        self.clock = clock
        self.rows = 0
        self.batches = 0
        self.run_id: str | None = None
        self.idle_since: float | None = None
        self.error: str | None = None
        self.ended = False
        self.news = Condition()
        self.spark = spark
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            with self.news:
                self.run_id = str(event.runId)
                self.news.notify_all()

    def onQueryProgress(self, event) -> None:
        batch = event.progress
        if str(batch.runId) != self.run_id:
            return
        with self.news:
            if batch.numInputRows > 0:
                self.rows += batch.numInputRows
                self.batches += 1
                self.idle_since = None
            elif self.idle_since is None:
                self.idle_since = self.clock()
            self.news.notify_all()

    def onQueryIdle(self, event) -> None:
        if str(event.runId) == self.run_id:
            with self.news:
                if self.idle_since is None:
                    self.idle_since = self.clock()
                self.news.notify_all()

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run_id:
            with self.news:
                self.ended, self.error = True, event.exception
                self.news.notify_all()

    def wait(self, idle_seconds: float, max_rows: int | None) -> str:
        """Blocks until the stream should stop: ``rows``, ``idle``, or ``ended`` where it has stopped by itself."""
        with self.news:
            while True:
                if max_rows is not None and self.rows >= max_rows:
                    return "rows"
                if self.ended:
                    return "ended"
                left = None
                if self.idle_since is not None:
                    left = self.idle_since + idle_seconds - self.clock()
                    if left <= 0:
                        return "idle"
                self.news.wait(left)

    def close(self) -> None:
        self.spark.streams.removeListener(self)


@dataclass
class BoundedRead:
    """What a bounded read landed: the rows, why it ended, and how much it had read."""

    rows: DataFrame
    stopped_by: str
    rows_read: int
    batches: int


def read_until_idle(
    stream: DataFrame,
    idle_seconds: float,
    max_rows: int | None = None,
    order_by: list[str] | None = None,
    keep: str = "oldest",
    path: str | None = None,
    checkpoint: str | None = None,
    interval: str = "0 seconds",
) -> BoundedRead:
    """Reads a stream until it has had nothing new for ``idle_seconds``, or ``max_rows`` have arrived.

    The rows are landed in ``path`` as Parquet, batch by batch, so nothing is held by the driver and
    only whole batches count, however often a task or the read itself is run again: with the same
    ``path`` and ``checkpoint`` a read that was broken off goes on where it was. Both are fresh
    places in the shared folder unless given.

    The last batch may bring more than ``max_rows``, so the landed rows are capped: the ``keep`` ones
    by ``order_by`` (see :func:`cap_rows`; all columns where no order is given). A stream without any
    rows gives an empty table. A stream that fails raises its error. Limits on the size of a batch
    are those of the source.
    """
    spark = stream.sparkSession
    if idle_seconds <= 0:
        raise ValueError("idle_seconds must be positive")
    if max_rows is not None and max_rows <= 0:
        return BoundedRead(spark.createDataFrame([], stream.schema), "rows", 0, 0)
    path = path or work_path(spark, "landed")
    checkpoint = checkpoint or work_path(spark, "landing")
    name = "bounded-" + checkpoint.rstrip("/").split("/")[-1]
    before = spark.conf.get(IDLE_EVENTS, None)
    spark.conf.set(IDLE_EVENTS, str(max(100, int(idle_seconds * 250))))
    watch = IdleStop(spark, name)
    try:
        query = _landing(stream, path, checkpoint, name, interval)
        try:
            stopped_by = watch.wait(idle_seconds, max_rows)
        finally:
            query.stop()
        if query.exception() is not None and stopped_by == "ended":
            raise query.exception()
    finally:
        watch.close()
        spark.conf.unset(IDLE_EVENTS) if before is None else spark.conf.set(IDLE_EVENTS, before)
    landed = spark.read.schema(stream.schema).parquet(path)
    if max_rows is not None:
        landed = cap_rows(landed, max_rows, order_by or stream.columns, keep)
    return BoundedRead(landed, stopped_by, watch.rows, watch.batches)


def _landing(stream: DataFrame, path: str, checkpoint: str, name: str, interval: str) -> StreamingQuery:
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").queryName(name).trigger(processingTime=interval).start()
