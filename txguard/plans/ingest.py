"""Messages to clean transactions and a quarantine, decoding every message once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.operators.decode import coerce_types, decode_json
from txguard.operators.quality import quarantine, require_columns, require_rows, tag_reasons, valid_rows
from txguard.schema import FIELDS
from txguard.session import materialise, spread


def route(messages: DataFrame, for_training: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(clean, rejects)`` of a batch of messages; training asks for a label of 0 or 1.

    The decoded rows are written once, partitioned by usability; each side then reads only its own
    folder. Raises on an empty source.
    """
    tagged = tag_reasons(decode_json(spread(messages)), for_training, for_training)
    routed = materialise(tagged.withColumn("usable", F.col("reason").isNull()), "routed", ["usable"])
    require_rows(routed)
    clean = coerce_types(routed.filter("usable")).select(*FIELDS)
    rejects = routed.filter(~F.col("usable")).select(*FIELDS, "raw_text", "reason")
    return clean, rejects


def outgoing(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records to be published: keyed messages of the valid ones, and the others with their violations."""
    payload = F.to_json(F.struct(*FIELDS))
    messages = valid_rows(records).select(F.col("user_id").alias("key"), payload.alias("value"))
    return messages, quarantine(records)


def from_table(table: DataFrame) -> DataFrame:
    """Text-typed records from a table that already has columns (a CSV or JSON export)."""
    require_columns(table)
    absent = [name for name in FIELDS if name not in table.columns]
    filled = table.withColumns({name: F.lit(None).cast("string") for name in absent})
    return filled.select(*[F.col(name).cast("string").alias(name) for name in FIELDS])
