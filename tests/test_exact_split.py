import hashlib

import pytest
from pyspark.sql import functions as F

from txguard.operators.exact_split import assign_exact_folds, assign_exact_split, part_sizes


def rows(spark, positive, negative):
    return spark.range(positive + negative).select(
        F.col("id").cast("string").alias("transaction_id"), F.when(F.col("id") < positive, 1).otherwise(0).alias("is_fraud")
    )


def counts(df):
    return {(r.split, r.is_fraud): r["count"] for r in df.groupBy("split", "is_fraud").count().collect()}


def test_sizes_round_up_in_total_and_keep_proportions():
    assert part_sizes({0: 80, 1: 20}, 0.2) == {0: 16, 1: 4}
    assert part_sizes({0: 12, 1: 3}, 0.2) == {0: 2, 1: 1}
    assert sum(part_sizes({0: 9_977, 1: 20}, 0.2).values()) == 2000
    assert part_sizes({}, 0.2) == {}


def test_class_counts_are_exact(spark):
    assert counts(assign_exact_split(rows(spark, 370, 9630))) == {
        ("test", 0): 1926, ("test", 1): 74, ("validation", 0): 1926, ("validation", 1): 74,
        ("train", 0): 5778, ("train", 1): 222,
    }


def test_same_rows_as_a_full_ranking(spark):
    got = {r.transaction_id: r.split for r in assign_exact_split(rows(spark, 50, 350), seed=7).collect()}
    for members in (range(50), range(50, 400)):
        ranked = sorted(map(str, members), key=lambda k: hashlib.md5(f"7:{k}".encode()).hexdigest())
        fifth = len(ranked) // 5
        want = ["test"] * fifth + ["validation"] * fifth + ["train"] * (len(ranked) - 2 * fifth)
        assert [got[k] for k in ranked] == want


def test_partitions_and_copies_do_not_matter(spark):
    base = rows(spark, 100, 900)
    assert assign_exact_split(base).exceptAll(assign_exact_split(base.repartition(5))).count() == 0
    copies = base.union(base.filter("transaction_id = '3'").crossJoin(spark.range(500)).select("transaction_id", "is_fraud"))
    split = assign_exact_split(copies)
    assert split.filter("transaction_id = '3'").select("split").distinct().count() == 1
    assert split.count() == 1500


def test_tiny_inputs(spark):
    assert counts(assign_exact_split(rows(spark, 1, 0))) == {("test", 1): 1}
    assert counts(assign_exact_split(rows(spark, 0, 0))) == {}
    everything = counts(assign_exact_split(rows(spark, 10, 10), test_share=0.5, validation_share=0.5))
    assert everything == {("test", 0): 5, ("test", 1): 5, ("validation", 0): 5, ("validation", 1): 5}


def test_assignment_is_a_projection(spark):
    plan = assign_exact_split(rows(spark, 10, 90))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_folds_have_equal_class_counts(spark):
    folded = assign_exact_folds(rows(spark, 20, 100), folds=3)
    got = {(r.fold, r.is_fraud): r["count"] for r in folded.groupBy("fold", "is_fraud").count().collect()}
    assert got == {(0, 1): 7, (1, 1): 7, (2, 1): 6, (0, 0): 34, (1, 0): 33, (2, 0): 33}
    other = assign_exact_folds(rows(spark, 20, 100), folds=3, seed=1)
    assert folded.exceptAll(other).count() > 0


def test_rows_without_id_are_placed(spark):
    nameless = rows(spark, 40, 160).withColumn("merchant", F.col("transaction_id")).withColumn("transaction_id", F.lit(None).cast("string"))
    assert counts(assign_exact_split(nameless)) == counts(assign_exact_split(rows(spark, 40, 160)))
    assert assign_exact_folds(nameless).filter("fold IS NULL").count() == 0


def test_other_labels_are_refused(spark):
    with pytest.raises(ValueError):
        assign_exact_split(rows(spark, 5, 5).withColumn("is_fraud", F.lit(7)))
