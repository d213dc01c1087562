import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from txguard.operators import boosting
from txguard.operators.boosting import Point, bins_of, chosen_features, fit, sampled

POINTS = [
    Point(4, 3, 0.3),
    Point(5, 2, 0.5, subsample=0.7, colsample_bytree=0.5, reg_alpha=0.5, reg_lambda=2.0),
    Point(3, 4, 0.1, min_child_weight=5.0, gamma=0.3, reg_lambda=0.0),
]


@pytest.fixture(scope="module")
def data():
    draw = np.random.default_rng(1)
    x = np.column_stack([draw.normal(size=400), draw.integers(0, 5, 400), draw.random(400) < 0.1, draw.exponential(size=400)]).astype(float)
    y = ((x[:, 0] > 0.3) & (x[:, 3] > 0.5) | (draw.random(400) < 0.1)).astype(int)
    return x, y, np.where(y == 1, 3.0, 1.0), draw.integers(0, 2, 400)


@pytest.fixture(scope="module")
def binned(spark, data):
    x, y, weight, fold = data
    rows = [(row.tolist(), int(label), float(w), int(f)) for row, label, w, f in zip(x, y, weight, fold)]
    frame = spark.createDataFrame(rows, "x array<double>, is_fraud int, weight double, fold int").repartition(3)
    return boosting.bin_rows(frame.withColumn("features", array_to_vector("x")), max_bins=16)


def brute(rows, bins, label, weight, fold, point, left_out, seed):
    """Log odds of all rows by plain loops over nodes, features and bins."""
    used = fold != left_out if left_out is not None else np.ones(len(bins), bool)
    margins = np.zeros(len(bins))

    def moved(g):
        return np.sign(g) * max(abs(g) - point.reg_alpha, 0)

    def brings(g, h):
        return moved(g) ** 2 / (h + point.reg_lambda)

    for number in range(point.n_estimators):
        p = 1 / (1 + np.exp(-margins))
        g, h = weight * (p - label), weight * p * (1 - p)
        drawn = used & sampled(rows, point.subsample, seed, number)
        features = chosen_features(bins.shape[1], point.colsample_bytree, seed, number)

        def grow(members, depth):
            mine = members & drawn
            gs, hs = g[mine].sum(), h[mine].sum()
            best = None
            for feature in features if depth < point.max_depth else []:
                for cut in np.unique(bins[mine, feature])[:-1]:
                    left = mine & (bins[:, feature] <= cut)
                    gl, hl = g[left].sum(), h[left].sum()
                    if min(hl, hs - hl) < point.min_child_weight:
                        continue
                    gain = round(brings(gl, hl) + brings(gs - gl, hs - hl) - brings(gs, hs), boosting.GAIN_DIGITS)
                    if gain > point.gamma and (best is None or gain > best[0]):
                        best = gain, feature, cut
            if best is None:
                margins[members] += -point.learning_rate * moved(gs) / (hs + point.reg_lambda) if hs + point.reg_lambda else 0
                return
            left = bins[:, best[1]] <= best[2]
            grow(members & left, depth + 1)
            grow(members & ~left, depth + 1)

        grow(np.ones(len(bins), bool), 0)
    return margins


@pytest.mark.parametrize("saved_every", [2, 16])
def test_against_brute_force(spark, binned, monkeypatch, saved_every):
    monkeypatch.setattr(boosting, "SAVED_EVERY", saved_every)
    tasks = [(point, fold) for point in POINTS for fold in (None, 1)]
    models = fit(binned, tasks, seed=3)
    rows = binned.rows.collect()
    bins = np.array([list(row.bins) for row in rows])
    label, weight, fold, row = (np.array([r[name] for r in rows]) for name in ("is_fraud", "weight", "fold", "row"))
    for model, (point, left_out) in zip(models, tasks):
        got = sum(tree.margins(bins) for tree in model.trees)
        want = brute(row, bins, label, weight, fold, point, left_out, 3)
        assert len(model.trees) == point.n_estimators
        assert np.allclose(got, want, atol=1e-9)
        assert any(tree.depth > 0 for tree in model.trees)


def test_scores_of_new_rows(spark, data, binned):
    (model,) = fit(binned, [(POINTS[0], None)])
    x, y, *_ = data
    frame = spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(x)] + [(1000, None), (1001, [float("nan")] * 4)], "k long, x array<double>")
    found = {row.k: row.p for row in frame.select("k", model.score(F.col("x")).alias("p")).collect()}
    assert found[1000] is None and 0 < found[1001] < 1
    scores = np.array([found[k] for k in range(len(x))])
    assert scores[y == 1].mean() > scores[y == 0].mean() + 0.2


def test_search_ranks_points_and_refits(spark, binned):
    found = boosting.search(binned, [Point(1, 1, 0.1), Point(6, 3, 0.3)], 2)
    ranking = found.ranking()
    assert [rank for rank, *_ in ranking] == [1, 2] and "max_depth=3" in ranking[0][1]
    assert len(found.best.trees) == 6 and all(0 < s <= 1 for scores in found.scores for s in scores)


def test_cuts_keep_rare_values_and_bounds(spark):
    frame = spark.createDataFrame([([float(k), float(k == 7), 3.0],) for k in range(1000)], "x array<double>")
    cuts = boosting.quantile_cuts(frame, "x")
    assert cuts[0][0] == 0 and cuts[0][-1] == 999 and len(cuts[0]) <= boosting.MAX_BINS
    assert cuts[1].tolist() == [0, 1] and cuts[2].tolist() == [3]
    import pyarrow as pa

    assert bins_of(pa.array([[-5.0, 1.0, 3.0], [1e9, 0.0, 4.0]]), cuts).tolist() == [[0, 1, 0], [len(cuts[0]), 0, 1]]
    with pytest.raises(ValueError):
        boosting.quantile_cuts(frame.filter("false"), "x")


def test_samples_are_shares_and_repeat():
    rows = np.arange(20_000)
    one = sampled(rows, 0.7, 1, 4)
    assert abs(one.mean() - 0.7) < 0.02 and (one == sampled(rows, 0.7, 1, 4)).all() and (one != sampled(rows, 0.7, 1, 5)).any()
    assert sampled(rows, 1.0, 1, 4).all()
    assert len(chosen_features(20, 0.7, 0, 1)) == 14 and len(chosen_features(3, 0.01, 0, 1)) == 1
