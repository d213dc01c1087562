"""Bounded reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txguard.operators.prefix import running_sums
from txguard.session import cut_lineage

_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
# Percentiles that narrow the search for the last kept key.
GRID = 1000


def cap_rows(df: DataFrame, n: int, order_by: Sequence[str], keep: str = "oldest") -> DataFrame:
    """The ``n`` oldest (or newest) rows by ``order_by``, or all rows if there are fewer.

    Rows with a NULL in a key come after all others on both sides, by the keys before it. Rows
    equal in all keys are ordered by a hash of the whole row; rows equal in that too are the same
    row, and any of them are taken. So the result is the same for every ``n`` and every layout.

    Only the key of the last kept row is looked up: percentiles of the first key narrow the search,
    the keys near the cut are written once and ranked, and the rows are then filtered by constants.
    The source is read three times; no task holds the result, and the other columns are never
    sorted or shuffled.
    """
    if keep not in ("oldest", "newest"):
        raise ValueError("keep is 'oldest' or 'newest'")
    if n <= 0:
        return df.limit(0)
    ascending = keep == "oldest"
    columns: dict[str, Column] = {}
    for i, name in enumerate(order_by):
        columns[f"_none{i}"] = F.col(name).isNull().cast("int")
        columns[f"_key{i}"] = _comparable(df, name)
    columns["_tie"] = F.xxhash64(*[F.col(f"`{name}`") for name in df.columns])
    total, grid = _grid(df, columns["_none0"], columns["_key0"])
    if n >= total:
        return df

    last, taken = _last_key(df, columns, n, total, grid, ascending)
    before, same = _compare(columns, last, ascending)
    # rows that equal the last kept one in key and hash are one row several times
    return df.filter(before).unionByName(df.filter(same).limit(n - taken))


def _comparable(df: DataFrame, name: str) -> Column:
    """The key as it is compared; timestamps as microseconds, which survive the way over the driver unchanged."""
    if df.schema[name].dataType.typeName().startswith("timestamp"):
        return F.unix_micros(F.col(name).cast("timestamp"))
    return F.col(name)


def _grid(df: DataFrame, missing: Column, key: Column) -> tuple[int, list | None]:
    """Row count and, for a numeric first key, its approximate percentiles over the rows that have it."""
    kind = df.select(key.alias("k")).schema["k"].dataType
    if not isinstance(kind, _NUMBERS):
        return df.count(), None
    shares = [i / GRID for i in range(GRID + 1)]
    row = df.agg(F.count(F.lit(1)).alias("total"), F.percentile_approx(key, shares, 100 * GRID).alias("grid")).first()
    return row.total, row.grid


def _last_key(
    df: DataFrame, columns: dict[str, Column], n: int, total: int, grid: list | None, ascending: bool
) -> tuple[Row, int]:
    """Key of the ``n``-th row in the wanted order, and the number of rows before that key."""
    keys = df.select(*[column.alias(name) for name, column in columns.items()])
    if grid:
        place = n / total if ascending else 1 - n / total
        at = int(place * GRID)
        low, high = grid[max(at - 2, 0)], grid[min(at + 3, GRID)]
        near = (F.col("_none0") == 0) & F.col("_key0").between(low, high)
        outside = F.col("_key0") < low if ascending else F.col("_key0") > high
        seen = Observation()
        counted = keys.observe(seen, F.count_if(outside & (F.col("_none0") == 0)).alias("outside"))
        close = cut_lineage(counted.filter(near))
        skipped = seen.get["outside"]
        if skipped < n <= skipped + close.count():
            return _ranked_key(close, n - skipped, ascending, skipped)
    return _ranked_key(keys, n, ascending, 0)


def _ranked_key(keys: DataFrame, position: int, ascending: bool, skipped: int) -> tuple[Row, int]:
    names = keys.columns
    order = []
    for name in names:
        column = F.col(name)
        rising = ascending or name.startswith("_none") or name == "_tie"
        order.append(column.asc_nulls_last() if rising else column.desc_nulls_last())
    grouped = keys.groupBy(*names).agg(F.count(F.lit(1)).alias("_rows"))
    ranked = running_sums(grouped, order, {"_through": "_rows"})
    reached = ranked.filter((F.col("_through") >= position) & (F.col("_through") - F.col("_rows") < position)).first()
    return reached, skipped + reached["_through"] - reached["_rows"]


def _compare(columns: dict[str, Column], last: Row, ascending: bool) -> tuple[Column, Column]:
    """Whether a row comes before the last kept key, and whether it equals it."""
    before, same = F.lit(False), F.lit(True)
    for name, column in columns.items():
        value = last[name]
        rising = ascending or name.startswith("_none") or name == "_tie"
        if value is not None:
            less = column < F.lit(value) if rising else column > F.lit(value)
            before = before | (same & F.coalesce(less, F.lit(False)))
        same = same & column.eqNullSafe(F.lit(value))
    return before, same
