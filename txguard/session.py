"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every plan of this package relies on; all of them may be set on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Python workers see texts; small batches bound what a worker holds at a time
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}

# Unpacked rows that a task of a learner should hold, in bytes.
TASK_BYTES = 64 * 2**20


def get_session(app_name: str = "txguard", **settings: str) -> SparkSession:
    """Session for the jobs. Settings already given on the command line are kept."""
    builder = SparkSession.builder.appName(app_name)
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else may own. Never stops it."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    On a cluster it has to be named in ``spark.checkpoint.dir`` (or set on the context), because
    every executor must reach it. Only where all executors share this process (``local[...]``) a
    folder beside the warehouse is taken instead.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is not None:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named:
        if context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-work"
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, scan: DataFrame | None = None) -> DataFrame:
    """Deal the rows out to all cores when the input has fewer splits than that.

    A file with one row group, or a capped read, would otherwise keep one core busy with all the
    parsing or fitting. Inputs with enough splits pass through without a shuffle. ``scan`` is the
    plain table scan to look at when ``df`` has more than that in it. Counting the splits of a plan
    with shuffles would run them, so such a plan is taken as spread already: they deal rows out.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    looked_at = df if scan is None else scan
    if _has_shuffle(looked_at):
        return df
    return df.repartition(cores) if looked_at.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame, rows: int, row_bytes: int, task_bytes: int) -> DataFrame:
    """The same rows in as many parts as keep the ``rows`` of ``row_bytes`` that a task holds below ``task_bytes``.

    For steps that unpack rows: splits of a table go by its packed bytes, which may be a hundredth of
    that. Rows that a table has in so many splits already pass through without a shuffle; a plan with
    shuffles is not run to count its splits.
    """
    parts = -(-rows * row_bytes // task_bytes)
    if parts <= 1 or not _has_shuffle(df) and df.rdd.getNumPartitions() >= parts:
        return df
    return df.repartition(parts)


def _has_shuffle(df: DataFrame) -> bool:
    """Whether the plan, before it runs, has a step that moves rows."""
    return "Exchange" in df._jdf.queryExecution().executedPlan().toString()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once, keeping its partitions; survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a columnar table in the shared folder and read it back.

    Preferred over a checkpoint when the table is read several times with different columns.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
