"""Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Stored schemas of the tables the transaction view reads: with them no footer is opened to plan a query.
SCHEMAS = {
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{directory}/{name}.parquet")


def stream_table(spark: SparkSession, directory: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same table as a file stream."""
    schema = SCHEMAS.get(name) or read_table(spark, directory, name).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # a stream needs a folder or a pattern; this pattern fits a single file and a folder of files alike
    return reader.parquet(f"{directory}/{name}.parque[t]")
