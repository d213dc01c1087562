"""Deterministic hash buckets for splitting.

A row's bucket depends on its own id and the seed only: no sort, no shuffle, the same answer on
any number of partitions and after rows are added, and copies of one id never straddle a split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard.schema import FIELDS

BUCKETS = 10_000
SEED = 42


def row_key(df: DataFrame, key: str = "transaction_id") -> Column:
    """The id as text; for a row without one, a digest of its record fields in alphabetical order.

    So no row is left out of a split or fold, and rows equal in all fields stay together. A table
    with none of the fields is digested by all its columns. Timestamps count as microseconds.
    """
    parts = []
    fields = [name for name in df.columns if name in FIELDS and name != key]
    for name in sorted(fields or [name for name in df.columns if name != key]):
        column = F.col(f"`{name}`")
        if df.schema[name].dataType.typeName().startswith("timestamp"):
            column = F.unix_micros(column.cast("timestamp"))
        parts.append(F.coalesce(column.cast("string"), F.lit("")))
    content = F.md5(F.concat_ws("|", *parts))
    return F.coalesce(F.col(key).cast("string"), content) if key in df.columns else content


def bucket(key: Column, salt: str, buckets: int = BUCKETS) -> Column:
    digest = F.md5(F.concat(F.lit(f"{salt}:"), key))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def split_name(position: Column, test_share: float = 0.20, validation_share: float = 0.20) -> Column:
    """``test`` / ``validation`` / ``train`` from a bucket number."""
    test_until = round(test_share * BUCKETS)
    validation_until = test_until + round(validation_share * BUCKETS)
    return (
        F.when(position < test_until, "test").when(position < validation_until, "validation").otherwise("train")
    )


def fold(key: Column, folds: int, seed: int | None = None) -> Column:
    """Fold number; its own salt keeps it independent of the split."""
    salt = "fold" if seed is None else f"fold:{seed}"
    return F.pmod(bucket(key, salt), F.lit(folds)).cast("int")
