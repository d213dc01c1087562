"""Labels that may be learned from, and a bounded sample of labelled texts to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard.session import cut_lineage

# Expected number of labelled rows a classifier is fitted on. Where there are fewer, all are used.
SAMPLE_ROWS = 20_000
_SLOTS = 1 << 20


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(divisor))


def held_out(id_col: str, divisor: int, part: int) -> Column:
    """Whether a row's label may not be learned from. Rows without an id are not held out."""
    return F.coalesce(remainder(id_col, divisor) == part, F.lit(False))


def known_labels(labels: DataFrame, label: str, learnable: Column, id_col: str = "doc_id") -> DataFrame:
    """``_labelled``, the id, and ``label``: those of 0 and 1 that may be learned, the largest of several for one id."""
    told = labels.filter(F.col(label).isin(0, 1) & learnable & F.col(id_col).isNotNull())
    return told.groupBy(F.col(id_col).alias("_labelled")).agg(F.max(label).alias("label"))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    learnable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``text`` and ``label`` of about ``rows`` labelled documents, chosen by a hash of the id.

    Labels other than 0 and 1, null labels and null ids are left out. Of several labels for one id
    the largest counts; of several texts with one id the least. The chosen labels are few, so they
    are broadcast and the documents are not shuffled.
    """
    known = known_labels(labels, label, learnable, id_col)
    share = min(1.0, rows / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64("_labelled"), F.lit(_SLOTS)) < int(share * _SLOTS))
    texts = docs.select(F.col(id_col).alias("_labelled"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(chosen), "_labelled")
    return cut_lineage(joined.groupBy("_labelled").agg(F.min("text").alias("text"), F.max("label").alias("label")))
