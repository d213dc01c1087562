"""Running sums over a global order without sending everything to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txguard.session import cut_lineage


def running_sums(
    df: DataFrame, order_by: Sequence[Column], sums: dict[str, str], by: Sequence[str] = (), totals: dict[str, str] | None = None
) -> DataFrame:
    """Adds inclusive running sums (``{output: input}``) of ``df`` in ``order_by`` order.

    ``by`` restarts the sums per value, for a few values such as splits; a value may hold any
    share of the rows because ranges cut through it. ``totals`` adds whole-group sums the same way.
    Rows must be unique on ``by`` and ``order_by``, and ``by`` must not be NULL.

    Rows are placed into sorted ranges, each range is summed on its own, and the small table of
    sums before each range (one row per range and group) is joined back. Range limits come from
    a sample, so the placed rows are written to the checkpoint folder: a task that runs again sees
    the same ranges.
    """
    totals = totals or {}
    by = list(by)
    ranged = df.repartitionByRange(*[F.col(name) for name in by], *order_by)
    placed = cut_lineage(ranged.withColumn("_range", F.spark_partition_id()))

    inputs = sorted({*sums.values(), *totals.values()})
    per_range = placed.groupBy(*by, "_range").agg(*[F.sum(name).alias(f"_sum_{name}") for name in inputs])
    group = Window.partitionBy(*by)
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(f"_sum_{name}").over(before), F.lit(0)).alias(f"_before_{out}") for out, name in sums.items()],
        *[F.sum(f"_sum_{name}").over(group).alias(out) for out, name in totals.items()],
    )

    within = Window.partitionBy(*by, "_range").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    running = placed.withColumns({f"_in_{out}": F.sum(name).over(within) for out, name in sums.items()})
    # one row per range and group: bounded by the number of shuffle partitions
    joined = running.join(F.broadcast(offsets), [*by, "_range"])
    return joined.select(
        *df.columns,
        *[(F.col(f"_before_{out}") + F.col(f"_in_{out}")).alias(out) for out in sums],
        *totals,
    )
