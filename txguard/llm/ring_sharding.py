"""Shards on a consistent-hash ring with bounded loads.

Every shard has virtual nodes on a ring; a row belongs to the first node clockwise from the hash of
its id. No shard takes more than its capacity: rows that find a full shard continue clockwise to
the next node with room. Capacities add up to the number of rows, so row counts differ by one at most.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txguard.session import cut_lineage

SHARDS = 24
VIRTUAL_NODES = 64
ROW_BYTES = 8  # added to the bytes of the text
# Rows of an arc are ranked in so many parts; equal rows are dealt over the parts in lots.
PARTS = 64
LOT = 10_000


@dataclass
class Segment:
    """Rows ``first`` to ``past`` (exclusive) of an arc, by rank, go to ``shard`` from ``slot`` on."""

    arc: int
    first: int
    past: int
    shard: int
    slot: int


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> tuple[np.ndarray, list[int]]:
    """Places of the nodes in ring order, as signed 64-bit hashes, and their shards."""
    nodes = []
    for shard in range(shards):
        for node in range(virtual_nodes):
            place = hashlib.md5(f"{shard}:{node}".encode(), usedforsecurity=False).digest()[:8]
            nodes.append((int.from_bytes(place, "big", signed=True), shard))
    nodes.sort()
    return np.array([place for place, _ in nodes], np.int64), [shard for _, shard in nodes]


def capacities(natural: list[int]) -> list[int]:
    """Equal capacities for all rows; the rows that do not divide go to the shards with most rows of their own."""
    each, rest = divmod(sum(natural), len(natural))
    larger = set(sorted(range(len(natural)), key=lambda s: (-natural[s], s))[:rest])
    return [each + (shard in larger) for shard in range(len(natural))]


def plan(loads: dict[int, int], owner: list[int], shards: int) -> list[Segment]:
    """Where the rows of every arc go, from the number of rows on each arc.

    A shard first takes rows of its own arcs in ring order. What is left of an arc then continues
    clockwise, arc after arc, to the next nodes whose shards have room.
    """
    natural = [0] * shards
    for arc, rows in loads.items():
        natural[owner[arc]] += rows
    room = capacities(natural)
    taken = [0] * shards
    out: list[Segment] = []
    left: dict[int, int] = {}

    def take(arc: int, first: int, past: int, shard: int) -> int:
        size = min(past - first, room[shard])
        if size:
            out.append(Segment(arc, first, first + size, shard, taken[shard]))
            room[shard] -= size
            taken[shard] += size
        return first + size

    for arc in sorted(loads):
        reached = take(arc, 0, loads[arc], owner[arc])
        if reached < loads[arc]:
            left[arc] = reached
    for arc, reached in left.items():
        node = arc
        while reached < loads[arc]:
            node = (node + 1) % len(owner)
            reached = take(arc, reached, loads[arc], owner[node])
    return out


def assign_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    virtual_nodes: int = VIRTUAL_NODES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: ``id_col``, ``size``, ``text_crc32``, ``shard`` and ``slot``, gapless from 0 in each shard.

    ``size`` is the UTF-8 bytes of the text (none for null) and eight more. The order of rows on an
    arc follows from their id, size and text alone, so the result does not depend on how the table
    is stored. Rows equal in all three are interchangeable; they are counted before the shuffle and
    dealt out in lots afterwards. Rows without an id share one place on the ring. An empty table
    gives no rows; other columns are ignored. The driver sees one count for each node.
    """
    spark = docs.sparkSession
    places, owner = ring(shards, virtual_nodes)
    shared = spark.sparkContext.broadcast(places)

    @F.arrow_udf("int")
    def arc_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        nodes = shared.value
        for hashes in batches:
            # the first node at or after the hash; behind the last node the ring closes
            yield pa.array(np.searchsorted(nodes, hashes.to_numpy(zero_copy_only=False)) % len(nodes), pa.int32())

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    equal = rows.groupBy("_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("_times"))
    lots = equal.select("*", F.explode(F.sequence(F.lit(0), F.expr(f"(_times - 1) div {LOT}").cast("int"))).alias("_lot"))
    hashed = F.xxhash64("_id", "size", "text_crc32", "_lot")
    lots = lots.select(
        "_id",
        "size",
        "text_crc32",
        F.least(F.lit(LOT), F.col("_times") - F.col("_lot") * LOT).alias("_rows"),
        hashed.alias("_order"),
        F.pmod(hashed, F.lit(PARTS)).cast("int").alias("_part"),
        arc_of(F.xxhash64("_id")).alias("_arc"),
    )
    lots = cut_lineage(lots)
    parts = cut_lineage(lots.groupBy("_arc", "_part").agg(F.sum("_rows").alias("_part_rows")))
    loads = {row[0]: row[1] for row in parts.groupBy("_arc").agg(F.sum("_part_rows")).collect()}
    schema = "_at int, first long, past long, shard int, start long"
    segments = spark.createDataFrame([(s.arc, s.first, s.past, s.shard, s.slot) for s in plan(loads, owner, shards)], schema)

    earlier = Window.partitionBy("_arc").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("_arc", "_part", F.coalesce(F.sum("_part_rows").over(earlier), F.lit(0)).alias("_before"))
    within = (
        Window.partitionBy("_arc", "_part")
        .orderBy("_order", "_id", "size", "text_crc32")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = lots.select("*", F.sum("_rows").over(within).alias("_through")).join(starts, ["_arc", "_part"])
    last = F.col("_before") + F.col("_through") - 1
    single = ranked.select("_id", "size", "text_crc32", "_arc", F.explode(F.sequence(last - F.col("_rows") + 1, last)).alias("_rank"))
    inside = (F.col("_arc") == F.col("_at")) & (F.col("_rank") >= F.col("first")) & (F.col("_rank") < F.col("past"))
    return single.join(F.broadcast(segments), inside).select(
        F.col("_id").alias(id_col), "size", "text_crc32", "shard", (F.col("start") + F.col("_rank") - F.col("first")).alias("slot")
    )


def shard_of(place: int, places: np.ndarray, owner: list[int]) -> int:
    """Shard of a place on the ring without any bound."""
    return owner[bisect_right(places, place - 1) % len(owner)]
