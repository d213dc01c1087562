"""The 14 model inputs, defined once for training and for scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Merchants that count as risky unless a list is given.
HIGH_RISK_MERCHANTS = ["QuickCash", "GlobalDigital", "FastMoneyX"]

NIGHT_FROM, NIGHT_UNTIL = 22, 5


def flag(condition: Column) -> Column:
    """0/1 column; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def time_features(ts: Column) -> dict[str, Column]:
    hour = F.hour(ts)
    return {
        "transaction_hour": hour,
        "is_night": flag((hour >= NIGHT_FROM) | (hour < NIGHT_UNTIL)),
        "is_weekend": flag(F.weekday(ts) >= 5),
        "transaction_day": F.dayofmonth(ts),
    }


def amount_features(amount: Column) -> dict[str, Column]:
    # greatest(amount, 0) would turn a missing amount into 0
    return {
        "amount_log": F.log1p(F.when(amount < 0, F.lit(0.0)).otherwise(amount)),
        "amount_over_500": flag(amount > 500),
        "amount_over_1000": flag(amount > 1000),
    }


def user_features(user_id: Column) -> dict[str, Column]:
    columns = {}
    for base in (500, 1000):
        remainder = F.pmod(user_id, F.lit(base))
        columns[f"user_id_mod_{base}"] = remainder
        columns[f"user_id_divisible_{base}"] = flag(remainder == 0)
    return columns


def merchant_features(merchant: Column, high_risk: Sequence[str] = HIGH_RISK_MERCHANTS) -> dict[str, Column]:
    return {"merchant_risk": flag(merchant.isin(list(high_risk)))}


def location_features(location: Column) -> dict[str, Column]:
    return {"location": F.upper(F.coalesce(location, F.lit("UNKNOWN")))}


def all_features(high_risk: Sequence[str] = HIGH_RISK_MERCHANTS) -> dict[str, Column]:
    """Every derived column over the canonical transaction columns."""
    return {
        **time_features(F.col("timestamp")),
        **amount_features(F.col("amount")),
        **user_features(F.col("user_id")),
        **merchant_features(F.col("merchant"), high_risk),
        **location_features(F.col("location")),
    }
