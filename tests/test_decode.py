import random
import re
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from txguard.operators.decode import coerce_types, decode_json
from txguard.operators.quality import clean, rejects
from txguard.schema import FIELDS, TRANSACTION

GOOD = (
    '{"transaction_id":"a","user_id":1000,"amount":12.5,"currency":"USD","merchant":"M","timestamp":'
    '"2024-05-01T23:30:00.123456+00:00","location":"us","is_fraud":0}'
)


def messages(spark, *values):
    return spark.createDataFrame([(i, value) for i, value in enumerate(values)], "n int, value string")


def decoded(spark, *values):
    return decode_json(messages(spark, *values), keep=["n"]).orderBy("n").collect()


def coerced(spark, field, *texts):
    rows = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], f"n int, {field} string")
    raw = rows.select("n", *[F.col(name) if name == field else F.lit(None).cast("string").alias(name) for name in FIELDS])
    return [row[field] for row in coerce_types(raw).orderBy("n").collect()]


@pytest.mark.parametrize("value", ["not json", None, "", "[]", "[{}]", '"text"', "12", "null", '{"user_id":1', "{} tail", "{}{}", "{},{}", "{}] {}", "{'user_id':1}"])
def test_no_object_is_bad_json(spark, value):
    (row,) = decoded(spark, value)
    assert row.bad_json and row.raw_text == value
    assert all(row[name] is None for name in FIELDS)


@pytest.mark.parametrize("before, after", [("", "\n"), ("\t", "\r\n"), (" ", " \t")])
def test_white_space_around_the_object(spark, before, after):
    (row,) = decoded(spark, before + GOOD + after)
    assert not row.bad_json and row.merchant == "M" and row.raw_text is None


def test_every_message_gives_one_row(spark):
    rows = decoded(spark, GOOD, "not json", None, "{}", GOOD)
    assert [row.n for row in rows] == [0, 1, 2, 3, 4]
    assert [row.bad_json for row in rows] == [False, True, True, False, False]
    assert rows[0].raw_text is None


def test_fields_stay_text_and_unknown_ones_are_ignored(spark):
    row = decoded(spark, '{"transaction_id":5,"user_id":1000.0,"amount":"12","is_fraud":true,"extra":1}')[0]
    assert (row.transaction_id, row.user_id, row.amount, row.is_fraud) == ("5", "1000.0", "12", "true")
    assert row.merchant is None


def test_binary_values(spark):
    rows = messages(spark, GOOD).withColumn("value", F.col("value").cast("binary"))
    assert decode_json(rows).first().merchant == "M"


def test_numbers(spark):
    texts = ["12", " 12 ", "1e3", "-5", "+5", ".5", "inf", "nan", "NaN", "oops", "", None, "12d", "12F", "0x1p3", "true"]
    expected = [12.0, 12.0, 1000.0, -5.0, 5.0, 0.5, float("inf")] + [None] * 8 + [1.0]
    assert coerced(spark, "amount", *texts) == expected


def test_numbers_are_read_as_pandas_reads_them(spark):
    source = random.Random(3)
    texts = {"".join(source.choice("0123456789.e-+dDfFxX ina_,") for _ in range(source.randint(0, 6))) for _ in range(3000)}
    texts = sorted(text for text in texts if not re.search(r"[eE][+-]?\d{3}", text))  # overflow is infinite here, missing there
    expected = [pd.to_numeric(pd.Series([text], dtype=object), errors="coerce")[0] for text in texts]
    wanted = [None if pd.isna(value) else float(value) for value in expected]
    got = coerced(spark, "amount", *texts)
    assert [value is None for value in got] == [value is None for value in wanted]
    assert [value for value in got if value is not None] == pytest.approx([value for value in wanted if value is not None])
    assert sum(value is not None for value in wanted) > 100


def test_integers_are_narrowed_towards_zero(spark):
    assert coerced(spark, "user_id", "7", "1000.0", "1000.9", "-0.9", "inf", "3000000000", "x") == [
        7, 1000, 1000, 0, None, None, None,
    ]
    assert coerced(spark, "is_fraud", "true", "false", "1", "0.0", "yes") == [1, 0, 1, 0, None]


def test_every_iso_form_is_read_as_utc(spark):
    texts = {
        "2024-05-01T23:30:00.123456+00:00": "2024-05-01 23:30:00.123456",
        "2024-05-01T23:30:00+00:00": "2024-05-01 23:30:00",
        "2024-05-01T23:30:00Z": "2024-05-01 23:30:00",
        "2024-05-01T23:30:00": "2024-05-01 23:30:00",
        "2024-05-01 23:30:00+02:00": "2024-05-01 21:30:00",
        "2024-05-02T01:00:00+02:00": "2024-05-01 23:00:00",
        "2024-05-01": "2024-05-01 00:00:00",
        "20240501": "2024-05-01 00:00:00",
        "20240501T233000": "2024-05-01 23:30:00",
        "20240501T233000+02:00": "2024-05-01 21:30:00",
    }
    rows = spark.createDataFrame([(text,) for text in texts], "timestamp string")
    raw = rows.select(*[F.col(n) if n == "timestamp" else F.lit(None).cast("string").alias(n) for n in FIELDS])
    assert [r[0] for r in coerce_types(raw).select(F.col("timestamp").cast("string")).collect()] == list(texts.values())


def test_bare_times_and_nonsense_are_not_dates(spark):
    texts = ["12:30", " 12:30:00", "T12", "T12:30", "now", "bad", "2024-13-01", "1700000000", ""]
    assert coerced(spark, "timestamp", *texts) == [None] * len(texts)


def test_coerced_schema_is_the_transaction_schema(spark):
    typed = coerce_types(decode_json(messages(spark, GOOD))).select(*FIELDS)
    assert [(f.name, f.dataType) for f in typed.schema] == [(f.name, f.dataType) for f in TRANSACTION]
    assert typed.first().timestamp == datetime(2024, 5, 1, 23, 30, 0, 123456)


def test_message_is_parsed_once(spark):
    typed = coerce_types(decode_json(messages(spark, GOOD)))
    plan = clean(typed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    plan = rejects(decode_json(messages(spark, GOOD)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
