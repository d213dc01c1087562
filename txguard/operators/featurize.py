"""Feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from txguard.functions.features import HIGH_RISK_MERCHANTS, all_features
from txguard.schema import FEATURES, LABEL


def add_features(df: DataFrame, high_risk: Sequence[str] = HIGH_RISK_MERCHANTS) -> DataFrame:
    """All derived columns in one projection; ``location`` is replaced by its upper-case form."""
    return df.withColumns(all_features(high_risk))


def feature_table(df: DataFrame, high_risk: Sequence[str] = HIGH_RISK_MERCHANTS) -> DataFrame:
    """The 14 model inputs and the label, in model order."""
    return add_features(df, high_risk).select(*FEATURES, LABEL)
