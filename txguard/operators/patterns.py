"""Fraud-pattern flags over transactions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import lgamma

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txguard.functions import rules
from txguard.functions.features import HIGH_RISK_MERCHANTS
from txguard.session import cut_lineage

# A broadcast id list of this length stays near 10 MB.
MAX_BROADCAST_IDS = 500_000
# A user with more than one in so many rows is spread; so there are fewer such users than that.
HOT_SHARE = 200
SALTS = 64


def mark_watch_list(
    df: DataFrame,
    watch_list: DataFrame,
    flag: str = "on_watch_list",
    max_broadcast: int = MAX_BROADCAST_IDS,
    salts: int = SALTS,
) -> DataFrame:
    """Adds a boolean: is the user on the list?

    The list is counted first (never further than the limit). A short one is broadcast. A longer
    one is joined by shuffle; users with a large share of the rows, fewer than ``HOT_SHARE``, are
    found by a count, and only their rows and their entries of the list are spread over ``salts``
    parts. Rows are dealt to the parts by a hash of the whole row.
    """
    # read twice, by the count and by the join: whatever made the list should not run twice
    ids = cut_lineage(watch_list.select("user_id").filter(F.col("user_id").isNotNull()).distinct())
    marked = ids.withColumn(flag, F.lit(True))
    if ids.limit(max_broadcast + 1).count() <= max_broadcast:
        joined = df.join(F.broadcast(marked), "user_id", "left")
    else:
        hot = [row.user_id for row in _hot_users(df).collect()]
        is_hot = F.col("user_id").isin(hot) if hot else F.lit(False)
        parts = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        spread = marked.withColumn("_salt", F.explode(parts))
        content = F.xxhash64(*[F.col(f"`{name}`") for name in df.columns])
        salted = df.withColumn("_salt", F.when(is_hot, F.pmod(content, F.lit(salts)).cast("int")).otherwise(0))
        joined = salted.join(spread, ["user_id", "_salt"], "left").drop("_salt")
    return joined.select(*df.columns, F.coalesce(flag, F.lit(False)).alias(flag))


def _hot_users(df: DataFrame) -> DataFrame:
    """Users with more than ``1 / HOT_SHARE`` of all rows; counted before the shuffle."""
    limit = df.count() // HOT_SHARE
    counts = df.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > limit).select("user_id")


def account_takeover(df: DataFrame, watch_list: DataFrame, **options) -> DataFrame:
    marked = mark_watch_list(df, watch_list, "_listed", **options)
    return marked.select(*df.columns, rules.account_takeover(F.col("_listed")).alias("rule_account_takeover"))


def card_testing(df: DataFrame) -> DataFrame:
    return df.withColumn("rule_card_testing", rules.card_testing())


def merchant_collusion(df: DataFrame, high_risk: Sequence[str] = HIGH_RISK_MERCHANTS) -> DataFrame:
    return df.withColumn("rule_merchant_collusion", rules.merchant_collusion(high_risk))


def geo_anomaly(df: DataFrame, locations: Sequence[str] = rules.HIGH_RISK_LOCATIONS) -> DataFrame:
    return df.withColumns(
        {"rule_geo_anomaly": rules.geo_anomaly(), "high_risk_location": rules.high_risk_location(locations)}
    )


def fraud_pattern(
    df: DataFrame, watch_list: DataFrame, high_risk: Sequence[str] = HIGH_RISK_MERCHANTS, **options
) -> DataFrame:
    """All flags plus ``pattern``, the first that applies. One join and one projection."""
    marked = mark_watch_list(df, watch_list, "_listed", **options)
    columns = {
        "account_takeover": rules.account_takeover(F.col("_listed")),
        "card_testing": rules.card_testing(),
        "merchant_collusion": rules.merchant_collusion(high_risk),
        "geo_anomaly": rules.geo_anomaly(),
    }
    flags = [columns[name].alias(f"rule_{name}") for name in rules.PATTERNS]
    return marked.select(*df.columns, *flags, rules.first_match(columns).alias("pattern"))


def pattern_summary(with_pattern: DataFrame) -> DataFrame:
    """Rows, share of all rows, label count and label rate of each pattern.

    Only a handful of patterns exist, so the total is taken over the grouped rows.
    """
    grouped = with_pattern.groupBy("pattern").agg(
        F.count("*").alias("n"), F.sum("is_fraud").alias("n_fraud"), F.avg("is_fraud").alias("fraud_rate")
    )
    share = F.col("n") / F.sum("n").over(Window.partitionBy())
    return grouped.select("pattern", "n", share.alias("share"), "n_fraud", "fraud_rate")


# Terms of the series of the incomplete gamma function, and the statistic from which its complement is nothing.
TERMS = 1500
NO_CHANCE = 1000.0


def pattern_fit(with_pattern: DataFrame, mix: Mapping[str, float] = rules.STATED_MIX) -> DataFrame:
    """How the rows with a pattern are shared among the patterns, against a stated mix.

    One row for each pattern of ``mix``, also for those without rows: ``n``, the ``expected`` number, their
    difference over the root of the expected number (``residual``), and for all together the
    chi-square ``statistic`` and its ``p_value``, the chance of one as large where the mix holds.
    Without any rows the statistic is 0 and the chance 1. Patterns outside the mix do not count.
    """
    if abs(sum(mix.values()) - 1) > 1e-9 or min(mix.values()) <= 0:
        raise ValueError("the shares of a mix are positive and sum up to 1")
    wide = with_pattern.agg(*[F.count_if(F.col("pattern") == name).alias(name) for name in mix])
    total = reduce(lambda a, b: a + b, (F.col(name) for name in mix))
    rows = [F.struct(F.lit(name).alias("pattern"), F.col(name).alias("n"), (total * share).alias("expected")) for name, share in mix.items()]
    told = wide.select(F.array(*rows).alias("rows"))
    off = F.aggregate("rows", F.lit(0.0), lambda sum_, x: sum_ + F.coalesce(F.try_divide((x["n"] - x["expected"]) ** 2, x["expected"]), F.lit(0.0)))
    fitted = told.withColumn("statistic", off).withColumn("p_value", chi_square_beyond(F.col("statistic"), len(mix) - 1))
    each = fitted.select(F.explode("rows").alias("row"), "statistic", "p_value")
    residual = F.coalesce(F.try_divide(F.col("row.n") - F.col("row.expected"), F.sqrt("row.expected")), F.lit(0.0))
    return each.select("row.pattern", "row.n", "row.expected", residual.alias("residual"), "statistic", "p_value")


def chi_square_beyond(statistic: Column, freedom: int) -> Column:
    """The chance that a chi-square variable is larger: one less the series of the lower incomplete gamma function."""
    if freedom <= 0:
        return F.lit(1.0)
    a, x = freedom / 2, statistic / 2
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(done: Column, k: Column) -> Column:
        term = done["term"] * x / (k + a)
        return F.struct(term.alias("term"), (done["sum"] + term).alias("sum"))

    series = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda done: done["sum"])
    lower = F.exp(a * F.log(x) - x - lgamma(a + 1) + F.log(series))
    return F.when(statistic <= 0, 1.0).when(statistic >= NO_CHANCE, 0.0).otherwise(F.greatest(F.lit(0.0), 1 - lower))
