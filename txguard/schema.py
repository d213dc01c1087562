"""Record schemas. One fixed schema serves batch, streaming, training and scoring."""

from __future__ import annotations

from pyspark.sql import types as T

TRANSACTION = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.IntegerType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("merchant", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("location", T.StringType()),
        T.StructField("is_fraud", T.IntegerType()),
    ]
)

FIELDS = TRANSACTION.fieldNames()

# As decoded from a message, before any coercion.
RAW = T.StructType([T.StructField(name, T.StringType()) for name in FIELDS])

LABEL = "is_fraud"

# Model input columns, in model order, and the version written into packages.
FEATURES = [
    "amount",
    "amount_log",
    "amount_over_500",
    "amount_over_1000",
    "transaction_hour",
    "is_night",
    "is_weekend",
    "transaction_day",
    "user_id_mod_500",
    "user_id_mod_1000",
    "user_id_divisible_500",
    "user_id_divisible_1000",
    "merchant_risk",
    "location",
]
FEATURE_VERSION = "v2"

NUMERIC_FEATURES = [name for name in FEATURES if name != "location"]

RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("logged_at", T.TimestampType()),
        T.StructField("kind", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)
