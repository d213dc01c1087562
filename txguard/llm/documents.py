"""What the operators share: reading the tables, columns computed from texts in Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A table of the folder; the stored schema is given, so no footer is opened for planning."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{directory}/{name}.parquet")


def utf8(column: str) -> Column:
    """Bytes of a text column; a null text counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def per_value(make: Callable[[], Callable], kind: str, arrow: pa.DataType) -> Callable[[str | Column], Column]:
    """A column function that runs Python over single values, in Arrow batches.

    ``make`` is called once per task and returns the function for one value. Results may be
    dictionaries where ``kind`` is a struct; lists of numbers come as numpy arrays. Values are
    handled one after another, so besides the batch only one value's work is in memory.
    """

    @F.arrow_udf(kind)
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        function = make()
        for batch in batches:
            yield pa.array(_each(function, batch), type=arrow)
        del function
        give_back()

    return apply


def give_back() -> None:
    """Hands what a task has freed back to the system: workers outlive their tasks, and several share an executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library than glibc
        pass


def _each(function: Callable, values: pa.Array) -> Iterator:
    if pa.types.is_list(values.type):
        for value in values:
            yield function(value.values.to_numpy() if value.is_valid else None)
        return
    for value in values:
        yield function(value.as_py())
