"""From score to decision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decide(score: Column, threshold: float) -> Column:
    """1 at or above the threshold; a missing score is 0. NaN sorts above everything, so it is removed first."""
    usable = F.nanvl(score, F.lit(None).cast("double"))
    return F.when(usable >= F.lit(float(threshold)), 1).otherwise(0)
