"""Exact ranked metrics with ties, from one table per scored set.

Rows are first grouped by score. Everything below works on that table, whose running sums are
made range by range (see ``prefix``), so neither a hot score nor many distinct scores overload a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.operators.prefix import running_sums
from txguard.schema import LABEL

# Threshold used when there are no scores, and the guard against 0/0 in F1.
DEFAULT_THRESHOLD = 0.5
F1_EPSILON = 1e-12


def ranked_cumulative(scored: DataFrame, score: str = "p", label: str = LABEL, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score, from the highest: ``pos`` and ``n`` at the score, ``tp`` and ``pp`` at or
    above it, ``positives`` and ``total`` of the whole set. A missing score ranks last."""
    value = F.nanvl(F.col(score), F.lit(None).cast("double"))
    grouped = scored.groupBy(*by, value.alias("score")).agg(F.sum(label).alias("pos"), F.count("*").alias("n"))
    return running_sums(
        grouped, [F.col("score").desc()], {"tp": "pos", "pp": "n"}, by, {"positives": "pos", "total": "n"}
    )


def _precision():
    return F.col("tp") / F.col("pp")


def _recall():
    # recall is 1 everywhere when there is nothing to find
    return F.coalesce(F.try_divide("tp", "positives"), F.lit(1.0))


def pr_curve(ranked: DataFrame) -> DataFrame:
    """Points by threshold plus the end point (precision 1, recall 0, no threshold)."""
    points = ranked.select(
        F.col("score").alias("threshold"), _precision().alias("precision"), _recall().alias("recall"), "tp", "pp"
    )
    end = ranked.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
        F.lit(0).cast("bigint").alias("tp"),
        F.lit(0).cast("bigint").alias("pp"),
    )
    return points.unionByName(end)


def roc_curve(ranked: DataFrame) -> DataFrame:
    """Points by threshold plus the origin. A rate without a class to rate is NULL."""
    points = ranked.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("pp") - F.col("tp"), F.col("total") - F.col("positives")).alias("fpr"),
        F.try_divide("tp", "positives").alias("tpr"),
    )
    origin = ranked.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def best_threshold(ranked: DataFrame) -> DataFrame:
    """One row: the threshold with the highest F1, the lowest such threshold on ties."""
    f1 = 2 * _precision() * _recall() / (_precision() + _recall() + F.lit(F1_EPSILON))
    best = F.max(F.struct(f1.alias("f1"), (-F.col("score")).alias("negated")))
    found = ranked.filter(F.col("score").isNotNull()).agg(best.alias("best"))
    return found.select(
        F.coalesce(-F.col("best.negated"), F.lit(DEFAULT_THRESHOLD)).alias("threshold"), F.col("best.f1").alias("f1")
    )


# Ratios are formed per term: products of two row counts would overflow on large sets.
def _average_precision_sum():
    terms = F.try_divide("pos", "positives") * _precision()
    return F.coalesce(F.sum(terms), F.lit(0.0))


def _roc_auc_sum():
    negatives_here = F.col("n") - F.col("pos")
    ranked_above = F.col("tp") - F.col("pos") + F.col("pos") / 2
    return F.sum(
        F.try_divide(negatives_here, F.col("total") - F.col("positives")) * F.try_divide(ranked_above, "positives")
    )


def average_precision(ranked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Step sum over the PR curve; 0 without positives. One row, or one for each ``by``."""
    return ranked.groupBy(*by).agg(_average_precision_sum().alias("average_precision"))


def roc_auc(ranked: DataFrame) -> DataFrame:
    """Tied pairs count one half; NULL unless both classes are there."""
    return ranked.agg(_roc_auc_sum().alias("roc_auc"))


def evaluation_summary(ranked: DataFrame, threshold: float) -> DataFrame:
    """The seven run metrics in one aggregation over the ranked table."""
    chosen = F.coalesce(F.col("score") >= F.lit(float(threshold)), F.lit(False))
    tp = F.coalesce(F.sum(F.when(chosen, F.col("pos"))), F.lit(0))
    pp = F.coalesce(F.sum(F.when(chosen, F.col("n"))), F.lit(0))
    sums = ranked.agg(
        _roc_auc_sum().alias("roc_auc"),
        _average_precision_sum().alias("auc_pr"),
        tp.alias("tp"),
        pp.alias("pp"),
        F.max("positives").alias("positives"),
        F.max("total").alias("total"),
    )
    zero = F.lit(0.0)
    return sums.select(
        "roc_auc",
        "auc_pr",
        F.coalesce(F.try_divide("tp", "pp"), zero).alias("precision"),
        F.coalesce(F.try_divide("tp", "positives"), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("tp"), F.col("pp") + F.col("positives")), zero).alias("f1"),
        F.lit(float(threshold)).alias("threshold"),
        F.try_divide("pp", "total").alias("predicted_fraud_rate"),
    )
