"""Lenient text-to-value coercion: whatever cannot be read becomes NULL, nothing raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Java number parsing also takes "12d", "12f" and "0x1p3"; the "f" of "inf" is allowed.
JAVA_ONLY = "[dDxX]|[0-9.][fF]"


def to_number(text: Column) -> Column:
    """Text or JSON boolean to double. NaN counts as missing."""
    value = F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))
    return (
        F.when(text == "true", F.lit(1.0)).when(text == "false", F.lit(0.0)).when(~text.rlike(JAVA_ONLY), value)
    )


def to_int(text: Column) -> Column:
    """Number narrowed towards zero; out-of-range and infinite values become NULL."""
    return to_number(text).try_cast("int")


# Compact ISO form, such as 20240501T233000Z.
BASIC_ISO = "yyyyMMdd['T'HHmmss[XXX]]"


def to_utc(text: Column) -> Column:
    """Any ISO date or date-time; without an offset it is UTC (the session zone).

    A bare time such as "12:30" or "T12" would be completed with the current day, so it is not read.
    """
    trimmed = F.btrim(text, F.lit(" \t\r\n"))
    colon = F.instr(trimmed, ":")
    dated = ~trimmed.startswith("T") & ((colon == 0) | (colon > len("2024-1-1")))
    return F.when(dated, F.coalesce(text.try_cast("timestamp"), F.try_to_timestamp(trimmed, F.lit(BASIC_ISO))))
