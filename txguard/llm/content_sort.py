"""Exact duplicates by sorting contents.

Normalised texts are range-partitioned by splitters that Spark samples, each range is sorted
externally, and a row joins the group of its neighbour when their whole texts are equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txguard.session import cut_lineage

# Characters of a normalised text that lead the sort key. The rest of the key is a hash and, behind
# it, the whole text; so splitters, which the driver samples, stay small however long texts are.
KEY_CHARS = 32
WHITE_SPACE = r"[\x20\x09-\x0D]+"
# A text with more rows than this part of an average range is spread over several runs.
PART_OF_RANGE = 4


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def mark_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = None
) -> DataFrame:
    """Per row: the row of its group that stays, the size of the group, and whether this is it.

    Returns ``id_col``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, one row for each
    input row. Of equal texts the row with most code points in the original stays, then the one
    with the smallest id; a row without id loses to any with one. Rows equal in everything stay
    separate rows, of which one is kept. ``chars_col`` adds the code points of the original text. Null and empty texts and texts of white space alone are
    one group. An empty table gives no rows; further columns are ignored.

    A text held by many rows gets its rows dealt over several runs of the sort. Their heads are
    merged afterwards: at most ``2 * PART_OF_RANGE`` runs for each range, so that table is broadcast.
    """
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = normalised(F.col(text_col))
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.char_length(F.coalesce(F.col(text_col), F.lit(""))).alias("_chars"),
        text.alias("_text"),
        F.monotonically_increasing_id().alias("_row"),
    ).withColumn("_hash", F.xxhash64("_text"))

    frequent, limit = _frequent(docs.select(F.xxhash64(text).alias("_hash")), ranges)
    runs = F.ceil(F.coalesce(F.col("_times"), F.lit(1)) / F.lit(limit))
    dealt = (
        rows.join(F.broadcast(frequent), "_hash", "left")
        .withColumn("_run", F.when(runs > 1, F.pmod(F.xxhash64("_row"), runs) + 1).otherwise(0).cast("int"))
        .withColumn("_key", F.substring("_text", 1, KEY_CHARS))
        .drop("_times", "_row")
        .repartitionByRange(ranges, "_key", "_hash", "_run")
    )
    # the ranges already hold equal texts of a run together, so the windows need no further exchange
    equal = Window.partitionBy("_key", "_hash", "_run", "_text")
    best_first = equal.orderBy(F.desc("_chars"), F.asc_nulls_last("_id"))
    marked = dealt.select(
        "_id",
        "_chars",
        "_run",
        "_text",
        F.first("_id").over(best_first).alias("_head"),
        F.row_number().over(best_first).alias("_place"),
        F.count(F.lit(1)).over(equal).alias("_rows"),
    ).select("_id", "_chars", "_run", "_head", "_place", "_rows", F.sha2("_text", 256).alias("text_sha256"))
    marked = cut_lineage(marked)

    order = F.struct(
        (-F.col("_chars")).alias("chars"), F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_run").alias("run")
    )
    merged = (
        marked.filter((F.col("_run") > 0) & (F.col("_place") == 1))
        .groupBy("text_sha256")
        .agg(F.min(order).alias("_best"), F.sum("_rows").alias("_all"))
    )
    whole = F.col("_run") == 0
    return marked.join(F.broadcast(merged), "text_sha256", "left").select(
        F.col("_id").alias(id_col),
        F.when(whole, F.col("_head")).otherwise(F.col("_best.id")).alias("keep_id"),
        F.when(whole, F.col("_rows")).otherwise(F.col("_all")).cast("long").alias("group_size"),
        ((F.col("_place") == 1) & (whole | (F.col("_run") == F.col("_best.run")))).alias("kept"),
        "text_sha256",
        *([F.col("_chars").alias(chars_col)] if chars_col else []),
    )


def _frequent(hashes: DataFrame, ranges: int) -> tuple[DataFrame, int]:
    """Text hashes with more rows than a part of an average range: at most ``PART_OF_RANGE * ranges``."""
    limit = max(1, -(-hashes.count() // (PART_OF_RANGE * ranges)))
    counts = hashes.groupBy("_hash").agg(F.count(F.lit(1)).alias("_times"))
    return counts.filter(F.col("_times") > limit), limit


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows with the same id, normalised text and length count as one document, of which one stays.
    """
    key = ["_kept_id", "_kept_chars", "_kept_sha"]
    kept = mark_duplicates(docs.select(id_col, text_col), id_col, text_col, "_kept_chars").filter("kept")
    kept = kept.select(F.col(id_col).alias("_kept_id"), "_kept_chars", F.col("text_sha256").alias("_kept_sha"))
    text = F.col(text_col)
    same = (
        F.col(id_col).eqNullSafe(F.col("_kept_id"))
        & (F.char_length(F.coalesce(text, F.lit(""))) == F.col("_kept_chars"))
        & (F.sha2(normalised(text), 256) == F.col("_kept_sha"))
    )
    return docs.join(kept, same, "inner").dropDuplicates(key).select(*docs.columns)
