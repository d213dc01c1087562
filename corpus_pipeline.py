"""Corpus pipeline: toxic documents and duplicates go, benchmark passages go, the rest is encoded."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard.llm import bpe_codec, content_sort, decontaminate, near_dup, toxicity
from txguard.llm.documents import table
from txguard.llm.labelled import held_out
from txguard.session import materialise, prepare

# SQL expresses neither the classifier nor the near-duplicate search and the encoding.
ORACLE_SQL = None

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return toxicity.keep_civil(docs, table(prepare(spark), sf_dir, "labels"), ~held_out("doc_id", 4, 2))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal contents."""
    prepare(spark)
    return content_sort.drop_duplicates(docs)


def dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    prepare(spark)
    return near_dup.drop_near_duplicates(docs)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean_documents(docs, table(prepare(spark), sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents, and whether they decode to the text again."""
    codec = bpe_codec.Codec(prepare(spark), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    coded = bpe_codec.encode_and_decode(docs, codec)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select(
        "doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", same.alias("round_trip")
    )


STAGES = [
    ("toxicity", civil),
    ("exact_dedup", distinct),
    ("near_dedup", dissimilar),
    ("decontamination", unseen),
    ("encoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written as Parquet for the next one."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
