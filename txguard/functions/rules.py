"""Fraud-pattern conditions on a transaction as it arrives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from txguard.functions.features import HIGH_RISK_MERCHANTS, flag

# Limits and the destination list of the patterns.
TAKEOVER_OVER = 500
CARD_TEST_UNDER = 2.0
CARD_TEST_USER_STEP = 1000
COLLUSION_OVER = 300
GEO_USER_STEP = 500
HIGH_RISK_LOCATIONS = ["CN", "RU", "NG"]

PATTERNS = ["account_takeover", "card_testing", "merchant_collusion", "geo_anomaly"]
# How the patterns are said to share the fraud cases.
STATED_MIX = {"account_takeover": 0.4, "card_testing": 0.3, "merchant_collusion": 0.2, "geo_anomaly": 0.1}


def account_takeover(on_watch_list: Column) -> Column:
    return flag(on_watch_list & (F.col("amount") > TAKEOVER_OVER))


def card_testing() -> Column:
    return flag((F.col("amount") < CARD_TEST_UNDER) & (F.pmod(F.col("user_id"), F.lit(CARD_TEST_USER_STEP)) == 0))


def merchant_collusion(high_risk: Sequence[str] = HIGH_RISK_MERCHANTS) -> Column:
    return flag(F.col("merchant").isin(list(high_risk)) & (F.col("amount") > COLLUSION_OVER))


def geo_anomaly() -> Column:
    return flag(F.pmod(F.col("user_id"), F.lit(GEO_USER_STEP)) == 0)


def high_risk_location(locations: Sequence[str] = HIGH_RISK_LOCATIONS) -> Column:
    return flag(F.upper(F.col("location")).isin(list(locations)))


def first_match(flags: dict[str, Column]) -> Column:
    """Name of the first raised flag in the given order, else ``none``."""
    return F.coalesce(*[F.when(raised == 1, F.lit(name)) for name, raised in flags.items()], F.lit("none"))
