import hashlib

import pytest
from pyspark.sql import functions as F

from txguard.functions.buckets import bucket
from txguard.operators import balance
from txguard.plans import views


def labels(spark, positive, negative):
    return spark.range(positive + negative).select(
        F.col("id").cast("string").alias("transaction_id"), F.when(F.col("id") < positive, 1).otherwise(0).alias("is_fraud")
    )


def test_counts_and_rate(spark):
    row = balance.class_balance(labels(spark, 3, 9)).first()
    assert (row.positive, row.negative, row.fraud_rate) == (3, 9, 0.25)
    assert balance.fraud_rate(labels(spark, 3, 9)).first().fraud_rate == 0.25
    assert balance.class_balance(labels(spark, 0, 0)).first().fraud_rate is None


def test_few_positives():
    balance.require_positives(20)
    with pytest.raises(ValueError, match="19 fraud rows"):
        balance.require_positives(19)


def test_weight(spark):
    assert balance.class_weight(labels(spark, 3, 9)).first().positive_weight == 3.0
    assert balance.class_weight(labels(spark, 0, 9)).first().positive_weight == 9.0
    weighted = balance.add_weight(labels(spark, 1, 2), 2.0)
    assert sorted(row.weight for row in weighted.collect()) == [1.0, 1.0, 2.0]


def test_bucket_is_the_stated_hash(spark):
    rows = spark.range(50).select(F.col("id").cast("string").alias("k")).withColumn("b", bucket(F.col("k"), "42"))
    for row in rows.collect():
        digest = hashlib.md5(f"42:{row.k}".encode()).hexdigest()
        assert row.b == int(digest[:8], 16) % 10_000


def test_split_shares_per_class(spark, medium):
    rows = balance.assign_split(views.transactions(spark, medium))
    counts = {(row.split, row.is_fraud): row.n for row in balance.split_counts(rows).collect()}
    assert counts == {
        ("test", 0): 1573, ("test", 1): 419, ("validation", 0): 1610, ("validation", 1): 367,
        ("train", 0): 4803, ("train", 1): 1228,
    }


def test_split_does_not_depend_on_partitions_and_needs_no_shuffle(spark):
    rows = labels(spark, 100, 900)
    once = balance.assign_split(rows)
    again = balance.assign_split(rows.repartition(7))
    assert once.exceptAll(again).isEmpty()
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    other = balance.assign_split(rows, seed=7)
    assert not once.exceptAll(other).isEmpty()


def test_shares_are_parameters(spark):
    rows = balance.assign_split(labels(spark, 0, 4000), test_share=0.5, validation_share=0.0)
    counts = {row["split"]: row["count"] for row in rows.groupBy("split").count().collect()}
    assert set(counts) == {"test", "train"} and abs(counts["test"] - 2000) < 150


def test_folds_are_independent_of_the_split(spark):
    rows = balance.assign_fold(balance.assign_split(labels(spark, 0, 6000)), 3).filter("split = 'test'")
    counts = [row["count"] for row in rows.groupBy("fold").count().collect()]
    assert len(counts) == 3 and min(counts) > 0.25 * sum(counts)


def test_vocabulary_aggregates_before_the_shuffle(spark, small):
    plan = balance.location_vocabulary(views.transactions(spark, small))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
