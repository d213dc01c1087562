"""Keep costly columns from being computed twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a costly column so that a later filter on it does not compute it a second time.

    Filters are not pushed through a generator, and exploding a one-element array keeps every row.
    """
    return df.select("*", F.explode(F.array(column)).alias(name))
