"""Merkle manifest of a table by cogrouped subtree exchange.

Rows are leaves. Within a group (a source) they stand in order of their ids, and every ``FAN``
consecutive nodes become one until one is left; the groups' nodes become one in the same way. A
superblock is a full subtree of ``FAN ** LEVELS`` leaves. Superblocks are reduced first, then the
small tree above them, which gives every superblock the nodes it needs from outside. These outer
nodes are cogrouped with the leaves by superblock, and one pass over a superblock reduces it again,
joins the proofs and folds them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txguard.session import cut_lineage

FAN = 16
_SHIFT = 4
LEVELS = 2
BLOCK = FAN**LEVELS

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(text: Column) -> Column:
    """The text with A-Z in lower case."""
    return F.translate(text, _UPPER, _UPPER.lower())


def leaf_hash(*fields: Column) -> Column:
    """SHA-256, in hex, of the fields end to end: ``-`` for null, else UTF-8 byte count, colon and value."""
    told = [F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in (x.cast("string") for x in fields)]
    return F.sha2(F.concat(*told), 256)


def manifest(
    leaves: DataFrame, id_col: str, group_col: str, leaf_col: str = "leaf", check_col: str | None = None, keep_proof: bool = False
) -> DataFrame:
    """Per leaf: ``id_col``, ``group_col``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    The proof is the hashes of the siblings, level by level up to the root, left to right;
    ``keep_proof`` adds it as ``proof``. It is folded from ``check_col`` where that is not null, else
    from the leaf, and ``verified`` says whether that gives the root.

    Leaves of a group are ordered by id, nulls first, then by leaf; groups by their UTF-8 bytes, null
    first. Leaves equal in both are equal leaves beside each other. A lone leaf is the node of its
    group, a lone group's node is the root; a leaf without siblings has an empty proof. An empty
    table gives no rows; other columns are ignored.

    No task holds a group: order comes from sorted ranges, a superblock has 256 leaves and groups
    smaller than that share tasks. The driver sees the number of levels and the root.
    """
    spark = leaves.sparkSession
    group = F.col(group_col).cast("string")
    rows = leaves.select(
        F.when(group.isNull(), "").otherwise(F.concat(F.lit("="), group)).alias("key"),
        F.col(id_col).alias("id"),
        F.col(leaf_col).alias("leaf"),
        (F.col(check_col) if check_col else F.lit(None).cast("string")).alias("check"),
    )
    placed = cut_lineage(_placed(rows, "key", ["id", "leaf"]))
    placed = placed.withColumn("block", F.shiftright("at", _SHIFT * LEVELS))
    outer, root = _outer(placed)
    bundle = _bundle(placed)
    left = placed.select(*bundle, "key", "block", "at", F.col("id").cast("string").alias("id"), "leaf", "check")
    # named unlike the columns on the left, which come from the same rows
    right = outer.select(*bundle, F.col("key").alias("of"), F.col("block").alias("number"), F.col("n").alias("size"), "subroot", "before", "behind")
    folded = (
        left.groupBy("bundle", "part")
        .cogroup(right.groupBy("bundle", "part"))
        .applyInPandas(
            lambda own, its: _fold(own, its, keep_proof),
            "key string, id string, leaf string, subroot string, proof_sha256 string, folded_root string, proof string",
        )
    )
    kinds = {field.name: field.dataType for field in leaves.schema}
    return folded.select(
        F.col("id").cast(kinds[id_col]).alias(id_col),
        F.when(F.col("key") != "", F.substring("key", 2, 2**31 - 1)).cast(kinds[group_col]).alias(group_col),
        "leaf",
        "subroot",
        F.lit(root).cast("string").alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.lit(root)).alias("verified"),
        *(["proof"] if keep_proof else []),
    )


def _bundle(placed: DataFrame) -> list[Column]:
    """What superblocks are cogrouped by: those of large groups one by one, small groups together up to about as many leaves."""
    small = F.col("n") <= BLOCK
    bundles = max(1, placed.filter(small).count() // BLOCK)
    return [
        F.when(small, F.lit("")).otherwise(F.col("key")).alias("bundle"),
        F.when(small, F.pmod(F.xxhash64("key"), F.lit(bundles))).otherwise(F.col("block")).alias("part"),
    ]


def _placed(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``at``, the place within ``key`` from 0, and ``n``, the rows of the key.

    Rows are sorted into ranges that cut through keys, and equal rows are spread by where they come
    from. The ranges are written once, because their limits come from a sample.
    """
    spread = rows.withColumn("_from", F.monotonically_increasing_id())
    sort = [key, *order, "_from"]
    ranged = cut_lineage(spread.repartitionByRange(*sort).sortWithinPartitions(*sort).drop("_from"))
    ranged = ranged.withColumn("_row", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_row", 33))
    counts = ranged.groupBy(key, "_range").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    own = Window.partitionBy(key)
    before = F.sum("_n").over(own.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(key, "_range", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_start"), F.sum("_n").over(own).alias("n"))
    joined = ranged.join(starts, [key, "_range"])
    return joined.select(*rows.columns, (F.col("_row") + F.col("_start")).alias("at"), "n")


def _runs(level: DataFrame) -> DataFrame:
    """The runs of ``FAN`` consecutive nodes of every key that has more than one node."""
    return level.filter("n > 1").groupBy("key", F.shiftright("at", _SHIFT).alias("up")).agg(
        F.array_sort(F.collect_list(F.struct("at", "hash"))).alias("run"), F.min("n").alias("n")
    )


def _tree(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Runs of every level, lowest first, and the last node of every key, from ``key``, ``at``, ``hash``, ``n``."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, tops, level = [], [], nodes
    while most > 1:
        tops.append(level.filter("n = 1").select("key", "hash"))
        runs = cut_lineage(_runs(level))
        levels.append(runs)
        whole = F.array_join(F.transform("run", lambda x: x["hash"]), "")
        level = runs.select("key", F.col("up").alias("at"), F.sha2(whole, 256).alias("hash"), F.ceil(F.col("n") / FAN).alias("n"))
        most = -(-most // FAN)
    last = level.select("key", "hash")
    for top in tops:
        last = last.union(top)
    return levels, last


def _paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``key``, ``at`` and the hashes before and behind on the way up, for every node of the lowest level.

    ``tops`` has the way of each key's last node, in ``before`` and ``behind``.
    """
    carried = [c for c in tops.columns if c not in ("key", "before", "behind")]
    paths = tops.select("key", F.lit(0).cast("long").alias("at"), "before", "behind", *carried)
    for runs in reversed(levels):
        children = runs.select("key", "up", F.posexplode("run").alias("k", "node"), "run")
        hashes = F.transform("run", lambda x: x["hash"])
        sides = children.select(
            "key",
            "up",
            F.col("node.at").alias("at"),
            F.array_join(F.slice(hashes, F.lit(1), F.col("k")), "").alias("one"),
            F.array_join(F.slice(hashes, F.col("k") + 2, F.lit(FAN)), "").alias("two"),
        )
        above = paths.withColumnRenamed("at", "up")
        below = sides.join(above, ["key", "up"]).select(
            "key", "at", F.concat(F.array("one"), "before").alias("before"), F.concat(F.array("two"), "behind").alias("behind"), *carried
        )
        # keys that have no run at this level are still at their last node
        resting = paths.join(runs.select("key").distinct(), "key", "left_anti")
        paths = cut_lineage(below.unionByName(resting))
    return paths


def _outer(placed: DataFrame) -> tuple[DataFrame, str | None]:
    """Per superblock its key's size and subroot and the outer nodes, and the root."""
    ordered = F.array_sort(F.collect_list(F.struct("at", "leaf")))
    blocks = placed.groupBy("key", "block").agg(ordered.alias("nodes"), F.min("n").alias("n"))
    blocks = blocks.withColumn("nodes", F.transform("nodes", lambda x: x["leaf"]))
    for level in range(LEVELS):
        runs = F.sequence(F.lit(0), F.floor((F.size("nodes") - 1) / FAN).cast("int"))
        joined = F.transform(runs, lambda k: F.sha2(F.array_join(F.slice("nodes", k * FAN + 1, F.lit(FAN)), ""), 256))
        blocks = blocks.withColumn("nodes", F.when(F.col("n") > FAN**level, joined).otherwise(F.col("nodes")))
    blocks = cut_lineage(
        blocks.select("key", F.col("block").alias("at"), F.element_at("nodes", 1).alias("hash"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("n").alias("leaves"))
    )
    levels, subroots = _tree(blocks.drop("leaves"))
    subroots = cut_lineage(subroots)
    # the subroots are the leaves of a tree of their own, all under one key
    top = cut_lineage(_placed(subroots.select(F.lit("").alias("tree"), F.col("key").alias("source"), "hash"), "tree", ["source"]))
    root_levels, roots = _tree(top.select(F.col("tree").alias("key"), "at", "hash", "n"))
    found = roots.first()
    none = F.array().cast("array<string>")
    root_paths = _paths(root_levels, roots.select("key", none.alias("before"), none.alias("behind")))
    ways = top.join(root_paths.drop("key"), "at").select(F.col("source").alias("key"), "before", "behind", F.col("hash").alias("subroot"))
    paths = _paths(levels, ways)
    outer = paths.join(blocks.select("key", "at", F.col("leaves").alias("n")), ["key", "at"]).withColumnRenamed("at", "block")
    return outer, found.hash if found else None


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _fold(leaves: pd.DataFrame, outer: pd.DataFrame, keep_proof: bool) -> pd.DataFrame:
    """Proofs and folded roots of the leaves of some superblocks."""
    above = {(row.of, row.number): row for row in outer.itertuples()}
    leaves = leaves.sort_values(["key", "block", "at"])
    out: list[tuple] = []
    for where, own in leaves.groupby(["key", "block"], sort=False):
        way = above[where]
        sides = _inner(list(own.leaf), way.size)
        ending = "".join(a + b for a, b in zip(way.before, way.behind, strict=True))
        for k, (id_, leaf, check) in enumerate(zip(own.id, own.leaf, own.check, strict=True)):
            inner = [level[k >> (_SHIFT * height)] for height, level in enumerate(sides)]
            proof = "".join(a + b for a, b in inner) + ending
            node = leaf if check is None else check
            for a, b in inner:
                node = _sha(a + node + b)
            for a, b in zip(way.before, way.behind, strict=True):
                node = _sha(a + node + b)
            out.append((where[0], id_, leaf, way.subroot, _sha(proof), node, proof if keep_proof else None))
    return pd.DataFrame(out, columns=["key", "id", "leaf", "subroot", "proof_sha256", "folded_root", "proof"])


def _inner(nodes: list[str], n: int) -> list[list[tuple[str, str]]]:
    """What stands before and behind each node in its run, level by level up to the superblock's node."""
    sides = []
    for level in range(LEVELS):
        if n <= FAN**level:
            break
        runs = [nodes[k : k + FAN] for k in range(0, len(nodes), FAN)]
        sides.append([("".join(run[:k]), "".join(run[k + 1 :])) for run in runs for k in range(len(run))])
        nodes = [_sha("".join(run)) for run in runs]
    return sides
