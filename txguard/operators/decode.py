"""JSON messages to typed transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txguard.functions.coercion import to_int, to_number, to_utc
from txguard.operators.barrier import evaluate_once
from txguard.schema import FIELDS, RAW

_END = "_end"
WHITE_SPACE = " \t\r\n"


def decode_json(messages: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Parse each message once into the text-typed record fields.

    Adds ``bad_json`` (not exactly one JSON object) and ``raw_text`` (the message, for bad ones
    only). White space around the object is no fault; single-quoted text and anything behind the
    object is one.

    The parser by itself stops behind the first object. So the message is parsed as the first
    element of an array, and the second, which holds a hash of the message, must be reached. The
    parse sits under a generator: later filters on the fields cannot be pushed below it, which would
    parse every message a second time.
    """
    text = F.col(value).cast("string")
    message = F.col("_text")
    end = F.xxhash64(message).cast("string")
    fields = T.StructType([*RAW.fields, T.StructField(_END, T.StringType())])
    wrapped = F.concat(F.lit("["), message, F.lit(f',{{"{_END}":"'), end, F.lit('"}]'))
    parsed = evaluate_once(
        messages.select(*keep, text.alias("_text")),
        "_parsed",
        F.from_json(wrapped, T.ArrayType(fields), {"allowSingleQuotes": "false"}),
    )
    trimmed = F.btrim(message, F.lit(WHITE_SPACE))
    whole = (
        (F.size("_parsed") == 2)
        & (F.get("_parsed", F.lit(1))[_END] == end)
        & trimmed.startswith("{")
        & trimmed.endswith("}")
    )
    bad = ~F.coalesce(whole, F.lit(False))
    first = F.get("_parsed", F.lit(0))
    return parsed.select(
        *keep,
        *[F.when(~bad, first[name]).alias(name) for name in FIELDS],
        bad.alias("bad_json"),
        F.when(bad, message).alias("raw_text"),
    )


def coerce_types(raw: DataFrame) -> DataFrame:
    """Canonical types; unreadable values become NULL. Columns that are not record fields pass through."""
    others = [name for name in raw.columns if name not in FIELDS]
    return raw.select(
        "transaction_id",
        to_int(F.col("user_id")).alias("user_id"),
        to_number(F.col("amount")).alias("amount"),
        "currency",
        "merchant",
        to_utc(F.col("timestamp")).alias("timestamp"),
        "location",
        to_int(F.col("is_fraud")).alias("is_fraud"),
        *others,
    )
