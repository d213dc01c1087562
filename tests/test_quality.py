import pytest
from pyspark.sql import functions as F

from txguard.operators import quality
from txguard.operators.decode import coerce_types, decode_json
from txguard.plans.ingest import from_table, route
from txguard.schema import FIELDS

BASE = {
    "transaction_id": "t", "user_id": "1500", "amount": "20", "currency": "USD", "merchant": "M",
    "timestamp": "2024-05-01T10:00:00+00:00", "location": "US", "is_fraud": "0",
}


def raw(spark, *changes):
    rows = [tuple({**BASE, **change}[name] for name in FIELDS) for change in changes]
    return spark.createDataFrame(rows, ", ".join(f"{name} string" for name in FIELDS))


def reasons(spark, *changes, **options):
    return [row.reason for row in quality.tag_reasons(raw(spark, *changes), **options).collect()]


def violations(spark, *changes):
    return [row.violations for row in quality.validate(raw(spark, *changes)).collect()]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="merchant, location"):
        quality.require_columns(raw(spark, {}).drop("merchant", "location"))
    frame = raw(spark, {})
    assert quality.require_columns(frame) is frame


def test_empty_source(spark):
    with pytest.raises(ValueError, match="no messages"):
        quality.require_rows(spark.range(0))
    with pytest.raises(ValueError, match="no messages"):
        route(spark.range(0).select(F.lit("{}").alias("value")))


def test_reasons_follow_field_order(spark):
    assert reasons(
        spark,
        {},
        {"user_id": None, "amount": "x"},
        {"amount": "nan"},
        {"merchant": None},
        {"timestamp": "bad"},
        {"location": None},
        {"is_fraud": "maybe"},
        {"currency": None},
    ) == [None, "user_id", "amount", "merchant", "timestamp", "location", "is_fraud", None]


def test_label_is_needed_for_training_only(spark):
    assert reasons(spark, {"is_fraud": None}) == ["is_fraud"]
    assert reasons(spark, {"is_fraud": None}, label_required=False) == [None]
    assert reasons(spark, {"is_fraud": "2"}) == [None]
    assert reasons(spark, {"is_fraud": "2"}, binary_label=True) == ["is_fraud"]


def test_clean_and_rejects_share_all_rows(spark):
    rows = raw(spark, {}, {"amount": "x"}, {"merchant": None}, {"amount": "-5"})
    assert quality.clean(coerce_types(rows)).count() == 2
    kept = quality.rejects(rows).orderBy("reason").collect()
    assert [(row.reason, row.amount) for row in kept] == [("amount", "x"), ("merchant", "20")]


def test_nan_of_a_typed_source_is_rejected(spark):
    typed = coerce_types(raw(spark, {}, {})).withColumn("amount", F.lit(float("nan")))
    assert quality.clean(typed).count() == 0


@pytest.mark.parametrize(
    "change, broken",
    [
        ({}, []),
        ({"transaction_id": None}, ["transaction_id"]),
        ({"user_id": "999"}, ["user_id"]),
        ({"user_id": "1000"}, []),
        ({"user_id": "9999"}, []),
        ({"user_id": "10000"}, ["user_id"]),
        ({"user_id": "1000.5"}, []),
        ({"amount": "0.01"}, []),
        ({"amount": "0"}, ["amount"]),
        ({"amount": "100000"}, []),
        ({"amount": "100000.01"}, ["amount"]),
        ({"currency": "usd"}, ["currency"]),
        ({"currency": "USDX"}, ["currency"]),
        ({"currency": None}, ["currency"]),
        ({"merchant": None}, []),
        ({"timestamp": "bad"}, ["timestamp"]),
        ({"location": None}, []),
        ({"location": "us"}, ["location"]),
        ({"is_fraud": "2"}, ["is_fraud"]),
        ({"is_fraud": "0.5"}, ["is_fraud"]),
        ({"is_fraud": "1.0"}, []),
        ({"user_id": None, "amount": None, "is_fraud": None}, ["user_id", "amount", "is_fraud"]),
    ],
)
def test_rules(spark, change, broken):
    assert violations(spark, change) == [broken]


def test_counts_and_branches(spark):
    rows = raw(spark, {}, {"amount": "0"}, {"amount": "0", "currency": "x"})
    counts = {row.rule: row.n for row in quality.violation_counts(rows).collect()}
    assert counts["amount"] == 2 and counts["currency"] == 1 and counts["user_id"] == 0
    assert quality.valid_rows(rows).count() == 1
    assert quality.quarantine(rows).count() == 2


def test_route_splits_one_decode(spark):
    good = raw(spark, {}, {"location": "de"}).select(F.to_json(F.struct(*FIELDS)).alias("value"))
    messages = good.union(spark.createDataFrame([("not json",), ('{"amount": 1}',)], "value string"))
    clean, rejects = route(messages)
    assert clean.count() == 2
    assert sorted(row.reason for row in rejects.collect()) == ["bad_json", "user_id"]
    assert rejects.filter("reason = 'bad_json'").first().raw_text == "not json"


def test_bad_json_is_counted(spark):
    messages = spark.createDataFrame([("x",), (None,), ("{}",)], "value string")
    counts = {row.reason: row.n for row in quality.reject_reasons(decode_json(messages)).collect()}
    assert counts == {"bad_json": 2, "user_id": 1}


def test_table_without_optional_id(spark):
    table = raw(spark, {}).drop("transaction_id")
    assert from_table(table).first().transaction_id is None
