"""Class balance, split, folds and weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.functions.buckets import SEED, bucket, fold, row_key, split_name
from txguard.schema import LABEL

# Fixed value: fewer positives than this cannot be trained on.
MIN_POSITIVES = 20


def fraud_rate(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.avg(label).alias("fraud_rate"))


def class_balance(df: DataFrame, label: str = LABEL) -> DataFrame:
    positive = F.count_if(F.col(label) == 1)
    return df.agg(
        positive.alias("positive"),
        F.count_if(F.col(label) == 0).alias("negative"),
        (positive / F.nullif(F.count("*"), F.lit(0))).alias("fraud_rate"),
    )


def require_positives(positive: int, minimum: int = MIN_POSITIVES) -> None:
    if positive < minimum:
        raise ValueError(f"{positive} fraud rows are too few to train on, at least {minimum} are needed")


def assign_split(
    df: DataFrame, seed: int = SEED, test_share: float = 0.20, validation_share: float = 0.20, key: str = "transaction_id"
) -> DataFrame:
    """Adds ``split``; per-class shares hold in expectation, without any shuffle."""
    return df.withColumn("split", split_name(bucket(row_key(df, key), str(seed)), test_share, validation_share))


def split_counts(with_split: DataFrame, label: str = LABEL) -> DataFrame:
    return with_split.groupBy("split", label).agg(F.count("*").alias("n"))


def assign_fold(df: DataFrame, folds: int = 3, key: str = "transaction_id", seed: int | None = None) -> DataFrame:
    """Adds ``fold``; equal shares of each class in expectation, without any shuffle (see ``assign_exact_folds``)."""
    return df.withColumn("fold", fold(row_key(df, key), folds, seed))


def class_weight(train: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: class counts and the weight of a positive row (negatives per positive)."""
    counts = class_balance(train, label).drop("fraud_rate")
    weight = F.col("negative") / F.greatest("positive", F.lit(1))
    return counts.withColumn("positive_weight", weight)


def add_weight(df: DataFrame, positive_weight: float, label: str = LABEL) -> DataFrame:
    return df.withColumn("weight", F.when(F.col(label) == 1, F.lit(float(positive_weight))).otherwise(F.lit(1.0)))


def location_vocabulary(df: DataFrame, column: str = "location") -> DataFrame:
    """Distinct locations with row counts; partial counts are made before the shuffle."""
    return df.groupBy(column).agg(F.count("*").alias("n"))
