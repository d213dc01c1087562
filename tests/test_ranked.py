"""Ranked metrics against brute force, with ties and the degenerate cases."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from txguard.operators import ranked
from txguard.operators.prefix import running_sums


def scored(spark, pairs):
    return spark.createDataFrame(list(pairs), "p double, is_fraud int")


def table(spark, pairs):
    return ranked.ranked_cumulative(scored(spark, pairs))


def brute(pairs):
    """Definitions written out over all pairs of rows."""
    positives = sum(y for _, y in pairs)
    negatives = len(pairs) - positives
    points = []
    for t in sorted({p for p, _ in pairs}):
        tp = sum(y for p, y in pairs if p >= t)
        pp = sum(1 for p, _ in pairs if p >= t)
        points.append((t, tp / pp, tp / positives if positives else 1.0, tp, pp))
    steps = [*[(r, q) for _, q, r, _, _ in points], (0.0, 1.0)]
    average_precision = sum((r1 - r2) * q1 for (r1, q1), (r2, _) in zip(steps, steps[1:])) if positives else 0.0
    auc = None
    if positives and negatives:
        wins = sum(
            1.0 if a > b else 0.5 if a == b else 0.0 for a, y in pairs if y == 1 for b, z in pairs if z == 0
        )
        auc = wins / (positives * negatives)
    f1 = [2 * q * r / (q + r + 1e-12) for _, q, r, _, _ in points]
    threshold = points[f1.index(max(f1))][0] if points else 0.5
    return points, average_precision, auc, threshold


def random_pairs(seed, n, levels):
    source = random.Random(seed)
    return [(source.randrange(levels) / levels, int(source.random() < 0.3)) for _ in range(n)]


CASES = {
    "ties": random_pairs(1, 200, 17),
    "distinct": [(i / 211, int(i * 7 % 11 < 4)) for i in range(211)],
    "all_tied": [(0.4, 1), (0.4, 0), (0.4, 0)],
    "all_positive": [(0.1, 1), (0.9, 1)],
    "all_negative": [(0.1, 0), (0.9, 0)],
    "perfect": [(0.9, 1), (0.8, 1), (0.2, 0), (0.1, 0)],
    "reversed": [(0.9, 0), (0.8, 0), (0.2, 1), (0.1, 1)],
    "equal_best": [(0.9, 1), (0.5, 0), (0.5, 1), (0.4, 0), (0.3, 1), (0.2, 0)],
}


@pytest.mark.parametrize("name", CASES)
def test_against_brute_force(spark, name):
    pairs = CASES[name]
    points, average_precision, auc, threshold = brute(pairs)
    rows = table(spark, pairs)
    curve = [tuple(r) for r in ranked.pr_curve(rows).orderBy(F.col("threshold").asc_nulls_last()).collect()]
    assert curve[-1] == (None, 1.0, 0.0, 0, 0)
    assert len(curve) - 1 == len(points)
    for got, want in zip(curve, points):
        assert got == pytest.approx(want)
    assert ranked.average_precision(rows).first()[0] == pytest.approx(average_precision)
    got_auc = ranked.roc_auc(rows).first()[0]
    assert got_auc is None if auc is None else got_auc == pytest.approx(auc)
    assert ranked.best_threshold(rows).first().threshold == threshold


def test_no_scores(spark):
    rows = table(spark, [])
    assert ranked.best_threshold(rows).first().threshold == 0.5
    assert ranked.average_precision(rows).first()[0] == 0.0
    assert ranked.roc_auc(rows).first()[0] is None
    assert ranked.evaluation_summary(rows, 0.5).first().f1 == 0.0


def test_roc_points(spark):
    rows = ranked.roc_curve(table(spark, CASES["perfect"])).orderBy(F.col("threshold").desc_nulls_first()).collect()
    assert [(r.fpr, r.tpr) for r in rows] == [(0.0, 0.0), (0.0, 0.5), (0.0, 1.0), (0.5, 1.0), (1.0, 1.0)]


def test_missing_scores_rank_last(spark):
    rows = table(spark, [(None, 1), (float("nan"), 0), (0.5, 1)]).orderBy("pp").collect()
    assert [(r.score, r.tp, r.pp) for r in rows] == [(0.5, 1, 1), (None, 2, 3)]
    assert ranked.best_threshold(table(spark, [(None, 1), (0.5, 0)])).first().threshold == 0.5


def test_summary_agrees_with_row_wise_counts(spark):
    pairs = CASES["ties"]
    threshold = 0.5
    row = ranked.evaluation_summary(table(spark, pairs), threshold).first()
    tp = sum(y for p, y in pairs if p >= threshold)
    pp = sum(1 for p, _ in pairs if p >= threshold)
    positives = sum(y for _, y in pairs)
    assert row.precision == pytest.approx(tp / pp)
    assert row.recall == pytest.approx(tp / positives)
    assert row.f1 == pytest.approx(2 * tp / (pp + positives))
    assert row.predicted_fraud_rate == pytest.approx(pp / len(pairs))
    assert list(row.asDict()) == ["roc_auc", "auc_pr", "precision", "recall", "f1", "threshold", "predicted_fraud_rate"]


def test_groups_are_ranked_on_their_own(spark):
    rows = scored(spark, CASES["ties"]).withColumn("part", F.lit("a"))
    rows = rows.union(scored(spark, CASES["distinct"]).withColumn("part", F.lit("b")))
    both = ranked.ranked_cumulative(rows, by=["part"])
    for part, name in (("a", "ties"), ("b", "distinct")):
        alone = table(spark, CASES[name])
        mine = both.filter(F.col("part") == part).select(*alone.columns)
        assert mine.exceptAll(alone).isEmpty() and alone.exceptAll(mine).isEmpty()


def test_running_sums_equal_a_plain_window(spark):
    rows = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("k"), (F.col("id") % 7).alias("v")).dropDuplicates(["k"])
    ours = running_sums(rows, [F.col("k").desc()], {"s": "v"}, totals={"t": "v"})
    everything = Window.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, 0)
    plain = rows.select("k", "v", F.sum("v").over(everything).alias("s"), F.sum("v").over(Window.partitionBy()).alias("t"))
    assert sorted(map(tuple, ours.select("k", "v", "s", "t").collect())) == sorted(map(tuple, plain.collect()))


def test_no_window_over_the_whole_ranked_table(spark):
    plan = table(spark, CASES["distinct"])._jdf.queryExecution().executedPlan().toString()
    big = [line for line in plan.splitlines() if "Window [" in line and "_range" in line and "score" in line]
    assert big and all("[_range" in line.split("Window")[1] for line in big)
