import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from txguard.operators.featurize import add_features, feature_table
from txguard.plans import views
from txguard.plans.scoring import messages_to_features
from txguard.schema import FEATURES, LABEL

SCHEMA = (
    "transaction_id string, user_id int, amount double, currency string, merchant string, timestamp timestamp, "
    "location string, is_fraud int"
)


def tx(spark, **columns):
    base = {
        "transaction_id": "t", "user_id": 1500, "amount": 20.0, "currency": "USD", "merchant": "M",
        "timestamp": datetime(2024, 5, 1, 10), "location": "US", "is_fraud": 0,
    }
    (name, values), *_ = columns.items()
    rows = [tuple({**base, name: value}.values()) for value in values]
    return add_features(spark.createDataFrame(rows, SCHEMA).coalesce(1))


def column(df, name):
    return [row[name] for row in df.select(name).collect()]


def test_night_bounds(spark):
    stamps = [datetime(2024, 5, 1, 21, 59, 59), datetime(2024, 5, 1, 22), datetime(2024, 5, 1, 4, 59, 59), datetime(2024, 5, 1, 5)]
    df = tx(spark, timestamp=[*stamps, None])
    assert column(df, "is_night") == [0, 1, 1, 0, 0]
    assert column(df, "transaction_hour") == [21, 22, 4, 5, None]


def test_weekend_bounds(spark):
    # 3 May 2024 is a Friday
    stamps = [datetime(2024, 5, 3, 23, 59, 59), datetime(2024, 5, 4), datetime(2024, 5, 5, 23, 59, 59), datetime(2024, 5, 6)]
    df = tx(spark, timestamp=stamps)
    assert column(df, "is_weekend") == [0, 1, 1, 0]
    assert column(df, "transaction_day") == [3, 4, 5, 6]


def test_amount_bounds(spark):
    amounts = [-1.0, 0.0, 0.01, 500.0, 500.01, 1000.0, 1000.01, None]
    df = tx(spark, amount=amounts)
    assert column(df, "amount_over_500") == [0, 0, 0, 0, 1, 1, 1, 0]
    assert column(df, "amount_over_1000") == [0, 0, 0, 0, 0, 0, 1, 0]
    logs = column(df, "amount_log")
    assert logs[:2] == [0.0, 0.0] and logs[-1] is None
    assert logs[3] == pytest.approx(math.log1p(500))


def test_user_remainders(spark):
    df = tx(spark, user_id=[-7, 0, 999, 1000, 1500, 2000, None])
    assert column(df, "user_id_mod_500") == [493, 0, 499, 0, 0, 0, None]
    assert column(df, "user_id_mod_1000") == [993, 0, 999, 0, 500, 0, None]
    assert column(df, "user_id_divisible_500") == [0, 1, 0, 1, 1, 1, 0]
    assert column(df, "user_id_divisible_1000") == [0, 1, 0, 1, 0, 1, 0]


def test_merchant_risk(spark):
    df = tx(spark, merchant=["QuickCash", "quickcash", None, "", "FastMoneyX"])
    assert column(df, "merchant_risk") == [1, 0, 0, 0, 1]
    custom = add_features(df.drop(*[c for c in FEATURES if c not in ("amount", "location")]), high_risk=["quickcash"])
    assert column(custom, "merchant_risk") == [0, 1, 0, 0, 0]


def test_location(spark):
    assert column(tx(spark, location=["us", "DE", None]), "location") == ["US", "DE", "UNKNOWN"]


def test_table_order_and_types(spark, small):
    table = feature_table(views.transactions(spark, small))
    assert table.columns == [*FEATURES, LABEL]
    kinds = {name: kind for name, kind in table.dtypes}
    assert kinds["amount"] == kinds["amount_log"] == "double" and kinds["location"] == "string"
    assert {kinds[name] for name in FEATURES if name not in ("amount", "amount_log", "location")} == {"int"}


def test_messages_and_columns_agree(spark, small):
    direct = add_features(views.transactions(spark, small)).select("transaction_id", *FEATURES, LABEL)
    decoded = messages_to_features(views.clean_messages(views.transactions(spark, small)), label_required=True)
    decoded = decoded.select("transaction_id", *FEATURES, LABEL)
    assert direct.exceptAll(decoded).isEmpty() and decoded.exceptAll(direct).isEmpty()


def test_features_take_one_projection_and_no_python(spark, small):
    plan = feature_table(views.transactions(spark, small))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("FileScan") == 3
    assert "SortMergeJoin" not in plan


def test_scan_reads_only_needed_columns(spark, small):
    rates = views.transactions(spark, small).agg(F.avg("is_fraud"))
    plan = rates._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan
    assert "c_name" not in plan and "c_acctbal" not in plan
