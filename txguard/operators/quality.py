"""Cleaning with a quarantine, and record validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard.functions.coercion import to_number, to_utc
from txguard.operators.barrier import evaluate_once
from txguard.operators.decode import coerce_types
from txguard.schema import FIELDS, LABEL

# Columns a source must have, and columns a clean row must have a value in.
REQUIRED_COLUMNS = ["user_id", "amount", "currency", "merchant", "timestamp", "location", "is_fraud"]
REQUIRED_VALUES = ["user_id", "amount", "merchant", "timestamp", "location", "is_fraud"]

# Record rules.
USER_ID_RANGE = (1000, 9999)
AMOUNT_RANGE = (0.01, 100000)
CURRENCY_PATTERN = "^[A-Z]{3}$"
LOCATION_PATTERN = "^[A-Z]{2}$"


def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    absent = [name for name in required if name not in df.columns]
    if absent:
        raise ValueError(f"source lacks the columns {', '.join(absent)}")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("the source holds no messages")
    return df


def reject_reason(typed: DataFrame, label_required: bool = True, binary_label: bool = False) -> Column:
    """First reason for which a coerced row cannot be used; NULL for a usable row.

    ``binary_label`` also refuses labels other than 0 and 1, which no classifier can be fitted on.
    """
    needed = [name for name in REQUIRED_VALUES if label_required or name != LABEL]
    reasons = [F.when(_missing(typed, name), F.lit(name)) for name in needed]
    if "bad_json" in typed.columns:
        reasons.insert(0, F.when(F.col("bad_json"), F.lit("bad_json")))
    if binary_label:
        reasons.append(F.when(~F.col(LABEL).isin(0, 1), F.lit(LABEL)))
    return F.coalesce(*reasons)


def _missing(typed: DataFrame, name: str) -> Column:
    """NULL, or NaN in a floating-point column."""
    value = F.col(name)
    if typed.schema[name].dataType.typeName() in ("double", "float"):
        value = F.nanvl(value, F.lit(None).cast("double"))
    return value.isNull()


# Name under which messages and unusable ones are counted on their way through a plan.
OBSERVED = "decoded"


def counting(with_reason: DataFrame) -> DataFrame:
    """Count messages and unusable ones on the way through; needs the ``reason`` column."""
    return with_reason.observe(OBSERVED, F.count("*").alias("messages"), F.count("reason").alias("unusable"))


def clean(typed: DataFrame, label_required: bool = True, counted: bool = False) -> DataFrame:
    """Usable rows only, with the record fields and any carried columns."""
    kept = [name for name in typed.columns if name not in ("bad_json", "raw_text")]
    judged = _with_reason(typed, label_required)
    judged = counting(judged) if counted else judged
    return judged.filter(F.col("reason").isNull()).select(*kept)


def rejects(raw: DataFrame, label_required: bool = True) -> DataFrame:
    """Unusable rows as they came in, each with its reason: the counterpart of :func:`clean`."""
    return tag_reasons(raw, label_required).filter(F.col("reason").isNotNull())


def tag_reasons(raw: DataFrame, label_required: bool = True, binary_label: bool = False) -> DataFrame:
    """Text-typed rows plus ``reason``; write it partitioned by reason to route both ways in one pass."""
    typed = coerce_types(raw.select(F.struct(*FIELDS).alias("_raw"), "*"))
    carried = [name for name in raw.columns if name not in FIELDS and name != "bad_json"]
    return _with_reason(typed, label_required, binary_label).select("_raw.*", *carried, "reason")


def _with_reason(typed: DataFrame, label_required: bool, binary_label: bool = False) -> DataFrame:
    """The reason is fixed before it is filtered on, else every field would be coerced twice."""
    judged = typed.withColumn("_reason", reject_reason(typed, label_required, binary_label))
    return evaluate_once(judged, "reason", F.col("_reason")).drop("_reason")


def reject_reasons(raw: DataFrame, label_required: bool = True) -> DataFrame:
    return rejects(raw, label_required).groupBy("reason").agg(F.count("*").alias("n"))


def record_rules() -> dict[str, Column]:
    """Rule name to "the record breaks it", over the text-typed fields.

    Inclusive ranges. ``merchant`` and ``location`` may be absent; every merchant text is allowed.
    """

    def absent(name: str) -> Column:
        return F.col(name).isNull()

    def outside(number: Column, low: float, high: float) -> Column:
        return ~F.coalesce(number.between(low, high), F.lit(False))

    def no_match(name: str, pattern: str) -> Column:
        return ~F.coalesce(F.col(name).rlike(pattern), F.lit(False))

    label = to_number(F.col("is_fraud"))
    return {
        "transaction_id": absent("transaction_id"),
        "user_id": outside(to_number(F.col("user_id")), *USER_ID_RANGE),
        "amount": outside(to_number(F.col("amount")), *AMOUNT_RANGE),
        "currency": no_match("currency", CURRENCY_PATTERN),
        "timestamp": to_utc(F.col("timestamp")).isNull(),
        "location": ~absent("location") & no_match("location", LOCATION_PATTERN),
        "is_fraud": ~F.coalesce(label.isin(0.0, 1.0), F.lit(False)),
    }


# JSON kinds of the fields, as far as a record states them. A whole number is a number.
JSON_KINDS = {
    "transaction_id": ["STRING"],
    "user_id": ["BIGINT"],
    "amount": ["BIGINT", "DECIMAL", "DOUBLE"],
    "currency": ["STRING"],
    "merchant": ["STRING"],
    "timestamp": ["STRING"],
    "location": ["STRING"],
    "is_fraud": ["BIGINT"],
}


def validate_types(messages: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``type_violations``: fields of a JSON message that are there but of another JSON kind.

    The message is parsed once, into a variant, which keeps the kinds that text-typed fields lose.
    Null and text that is no JSON have none here; they are unusable for other reasons.
    """
    parsed = evaluate_once(messages, "_variant", F.try_parse_json(F.col(value).cast("string")))
    wrong = []
    for name, kinds in JSON_KINDS.items():
        kind = F.schema_of_variant(F.try_variant_get("_variant", f"$.{name}", "variant"))
        plain = F.regexp_replace(kind, r"\(.*", "")
        wrong.append(F.when(~plain.isin("VOID", *kinds), F.lit(name)))
    return parsed.withColumn("type_violations", F.array_compact(F.array(*wrong))).drop("_variant")


def validate(raw: DataFrame) -> DataFrame:
    """Adds ``violations`` (names of broken rules, in field order) and ``valid``."""
    names = [F.when(broken, F.lit(name)) for name, broken in record_rules().items()]
    violations = F.array_compact(F.array(*names))
    return raw.withColumn("violations", violations).withColumn("valid", F.size("violations") == 0)


def valid_rows(raw: DataFrame) -> DataFrame:
    return validate(raw).filter("valid").drop("violations", "valid")


def quarantine(raw: DataFrame) -> DataFrame:
    return validate(raw).filter(~F.col("valid")).drop("valid")


def violation_counts(raw: DataFrame) -> DataFrame:
    """Rows breaking each rule. One pass with one counter per rule, no row is multiplied."""
    rules = record_rules()
    counters = [F.count_if(broken).alias(name) for name, broken in rules.items()]
    pairs = [F.struct(F.lit(name).alias("rule"), F.col(name).alias("n")) for name in rules]
    return raw.agg(*counters).select(F.inline(F.array(*pairs)))
