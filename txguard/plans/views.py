"""Transaction views over the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard.functions.buckets import SEED, bucket
from txguard.functions.features import HIGH_RISK_MERCHANTS
from txguard.operators.balance import assign_split
from txguard.schema import FIELDS
from txguard.sources.tables import read_table


def transactions(spark: SparkSession, directory: str, events: DataFrame | None = None) -> DataFrame:
    """Events as transactions. ``events`` may be a stream of the same table.

    Customer and nation are pruned to their join columns. Customer is joined first and on its own:
    the planner then sees its true size and broadcasts it if that is small, where the estimate of
    customer with nation would be the product of both. Beyond that it is a shuffled join, and a
    customer with a very large share of the events is split at run time by adaptive skew handling.
    """
    if events is None:
        events = read_table(spark, directory, "events")
    customer = read_table(spark, directory, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, directory, "nation").select(
        "n_nationkey", F.concat(_letter("n_regionkey"), _letter("n_nationkey")).alias("location")
    )
    slim = events.select(
        "event_id", "user_id", "value", "ts", "event_type", F.get_json_object("props", "$.k").alias("k")
    )
    slot = F.pmod(F.col("k").cast("int"), F.lit(25))
    merchant = F.concat(F.lit("M"), F.col("k"))
    for number in reversed(range(len(HIGH_RISK_MERCHANTS))):
        merchant = F.when(slot == number, F.lit(HIGH_RISK_MERCHANTS[number])).otherwise(merchant)
    placed = slim.join(customer, F.col("user_id") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return placed.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        (1000 + F.col("user_id") * 10 % 9000).cast("int").alias("user_id"),
        F.round(F.col("value") * 10, 2).alias("amount"),
        F.lit("USD").alias("currency"),
        merchant.alias("merchant"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        "location",
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("is_fraud"),
    )


def _letter(key: str):
    return F.char(65 + F.col(key))


def nameless(tx: DataFrame) -> DataFrame:
    """Rows without an id that differ in their content: what a table export without ids looks like."""
    return tx.select(
        F.lit(None).cast("string").alias("transaction_id"),
        F.concat(F.lit("row "), "transaction_id").alias("merchant"),
        "user_id",
        "timestamp",
        "is_fraud",
    )


def watch_list(tx: DataFrame) -> DataFrame:
    return tx.filter(F.col("user_id") % 70 == 0).select("user_id").distinct()


def bucketed(tx: DataFrame) -> DataFrame:
    return tx.withColumn("bucket", bucket(F.col("transaction_id"), str(SEED)))


def scored(tx: DataFrame) -> DataFrame:
    """A fixed score with many ties; ``split`` and the transaction are kept."""
    points = (F.col("bucket") % 1000 * 7 / 10).cast("bigint") + 300 * F.col("is_fraud")
    return assign_split(bucketed(tx)).withColumn("p", points.cast("double") / 1000)


def learnable(tx: DataFrame) -> DataFrame:
    """The same transactions with a label that depends on the features, plus some noise."""
    rule = F.col("merchant").isin(HIGH_RISK_MERCHANTS) & (F.col("amount") > 300)
    noisy = rule != (bucket(F.col("transaction_id"), "noise") < 150)
    return bucketed(tx).withColumn("is_fraud", noisy.cast("int")).drop("bucket")


def raw_fields(tx: DataFrame) -> DataFrame:
    """Text-typed records with one known defect per class of the id."""
    k = F.col("transaction_id").cast("bigint") % 97
    stamp = F.concat(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    user = F.col("user_id").cast("string")
    fields = {
        "transaction_id": F.col("transaction_id"),
        "user_id": F.when(k == 3, F.lit(None)).when(k == 12, "99").when(k == 5, F.concat(user, F.lit(".0"))).otherwise(user),
        "amount": F.when(k == 2, "oops").when(k == 6, "nan").when(k == 9, "-5").otherwise(F.col("amount").cast("string")),
        "currency": F.when(k == 10, "usd").otherwise(F.col("currency")),
        "merchant": F.when(k != 7, F.col("merchant")),
        "timestamp": F.when(k == 4, "bad").otherwise(stamp),
        "location": F.when(k == 8, F.lower("location")).otherwise(F.col("location")),
        "is_fraud": F.when(k == 11, "2").otherwise(F.col("is_fraud").cast("string")),
    }
    return tx.select(*[F.when(k != 1, fields[name]).alias(name) for name in FIELDS])


def messages(raw: DataFrame) -> DataFrame:
    """Raw records as message values; a record without any field stands for an undecodable message."""
    nothing = F.coalesce(*FIELDS).isNull()
    return raw.select(F.when(nothing, "not json").otherwise(F.to_json(F.struct(*FIELDS))).alias("value"))


def typed_messages(tx: DataFrame) -> DataFrame:
    """Messages with numbers as JSON numbers; in four of five classes of ids one field is of another kind."""
    k = F.pmod(F.col("transaction_id").cast("bigint"), F.lit(5))
    fields = F.to_json(F.struct("amount", "currency", "location", F.col("timestamp").cast("string").alias("timestamp")))
    name, user, label = F.col("transaction_id"), F.col("user_id").cast("string"), F.col("is_fraud").cast("string")

    def quoted(text):
        return F.concat(F.lit('"'), text, F.lit('"'))

    value = F.concat(
        F.lit('{"transaction_id":'), F.when(k == 1, name).otherwise(quoted(name)),
        F.lit(',"user_id":'), F.when(k == 2, quoted(user)).otherwise(user),
        F.lit(',"is_fraud":'), F.when(k == 3, F.when(F.col("is_fraud") == 1, "true").otherwise("false")).otherwise(label),
        F.lit(',"merchant":'), F.when(k == 4, user).otherwise(quoted(F.col("merchant"))),
        F.lit(","), F.substring(fields, 2, 1_000_000),
    )
    return tx.select(name.alias("id"), value.alias("value"))


def clean_messages(tx: DataFrame) -> DataFrame:
    """Well-formed messages, as a producer would send them."""
    return tx.select(F.to_json(F.struct(*FIELDS)).alias("value"))


def fixed_score():
    """A fixed linear score over features, for checks that need no model."""
    points = (
        200 * F.col("merchant_risk")
        + 300 * F.col("amount_over_500")
        + 150 * F.col("is_night")
        + 100 * F.col("is_weekend")
        + 50 * F.col("user_id_divisible_500")
        + 5 * F.col("transaction_hour")
    )
    return points.cast("double") / 1000


def fixed_score_model():
    """The same score as a function of a batch of inputs, for the Python-model adapter.

    Made here and not at module level so that it travels to the workers by value.
    """

    def predict(batch):
        points = (
            200 * batch["merchant_risk"]
            + 300 * batch["amount_over_500"]
            + 150 * batch["is_night"]
            + 100 * batch["is_weekend"]
            + 50 * batch["user_id_divisible_500"]
            + 5 * batch["transaction_hour"]
        )
        return points / 1000.0

    return predict
