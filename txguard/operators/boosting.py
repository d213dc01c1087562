"""Second-order boosted trees: binned rows, gradient and hessian sums by node, feature and bin, regularised gains.

Features are binned once, by quantiles. A level of a tree is one pass over the binned rows: every task
sums gradients and hessians in numpy, Spark adds the tasks up and finds the best split of every node
with a window over the bins, and the driver gets one row for each node. All points and folds of a
search grow their trees in the same passes, over the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txguard.operators.ranked import average_precision, ranked_cumulative
from txguard.schema import LABEL
from txguard.session import cut_lineage, materialise, spread

MAX_BINS = 64
MAX_FEATURES = 1024
# Trees after which the margins of the rows are written; in between they are added up from the new trees.
SAVED_EVERY = 16
# Rows that are summed up at once in a task.
AT_ONCE = 50_000
# Gains that agree so far are equal; the first feature and the lowest bin then win.
GAIN_DIGITS = 8


@dataclass(frozen=True)
class Point:
    """Parameters of one model, by the names of the search lists."""

    n_estimators: int = 200
    max_depth: int = 3
    learning_rate: float = 0.1
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    min_child_weight: float = 1.0
    gamma: float = 0.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0


class Tree:
    """A binary tree by places: the children of place k are 2k + 1 and 2k + 2. Bins up to ``cut`` go left."""

    def __init__(self, depth: int):
        size = 2 ** (depth + 1) - 1
        self.feature = np.full(size, -1, np.int32)
        self.cut = np.zeros(size, np.int32)
        self.value = np.zeros(size)
        self.depth = 0

    def places(self, bins: np.ndarray) -> np.ndarray:
        """Where the rows end, in the tree as far as it has grown."""
        at = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        for _ in range(self.depth):
            feature = self.feature[at]
            right = bins[rows, np.maximum(feature, 0)] > self.cut[at]
            at = np.where(feature >= 0, 2 * at + 1 + right, at)
        return at

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.places(bins)]


@dataclass
class Booster:
    """A model: where the bins of every feature end, and the trees, whose values sum up to the log odds."""

    point: Point
    cuts: list[np.ndarray]
    trees: list[Tree] = field(default_factory=list)

    def score(self, features: Column) -> Column:
        """Probability of label 1 from an array of feature values; null for a null array."""
        shared = self

        @F.arrow_udf("double")
        def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                out = np.full(len(batch), np.nan)
                there = np.flatnonzero(batch.is_valid().to_numpy(zero_copy_only=False))
                if len(there):
                    bins = bins_of(batch.drop_null(), shared.cuts)
                    out[there] = 1 / (1 + np.exp(-sum((tree.margins(bins) for tree in shared.trees), np.zeros(len(bins)))))
                yield pa.array(out, mask=np.isnan(out))

        return scored(features)


def threshold_l1(gradient: Column, alpha: Column) -> Column:
    """The gradient sum moved towards zero by ``alpha``."""
    return F.signum(gradient) * F.greatest(F.abs(gradient) - alpha, F.lit(0.0))


def split_gains(histogram: DataFrame, by: Sequence[str], alpha: Column, lambda_: Column, least: Column) -> DataFrame:
    """Per ``by``, ``feature`` and ``bin``: gradient and hessian sums ``gl``, ``hl`` up to the bin and ``gr``, ``hr`` beyond, and the gain.

    ``histogram`` has gradient ``g`` and hessian ``h`` by ``feature`` and ``bin``. The gain of a split is
    how much more its two sides bring than the node as a whole, where a side brings the square of its
    gradient sum, moved towards zero by ``alpha``, over its hessian sum plus ``lambda_``. Splits with a
    side whose hessian sum is below ``least``, or that has no rows, are left out.
    """
    feature = Window.partitionBy(*by, "feature")
    upto = feature.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    beyond = feature.orderBy("bin").rowsBetween(1, Window.unboundedFollowing)
    sides = histogram.select(
        *histogram.columns,
        F.sum("g").over(upto).alias("gl"),
        F.sum("h").over(upto).alias("hl"),
        F.sum("g").over(beyond).alias("gr"),
        F.sum("h").over(beyond).alias("hr"),
    )

    def brings(g: Column, h: Column) -> Column:
        return threshold_l1(g, alpha) ** 2 / (h + lambda_)

    gl, hl, gr, hr = (F.col(name) for name in ("gl", "hl", "gr", "hr"))
    gain = brings(gl, hl) + brings(gr, hr) - brings(gl + gr, hl + hr)
    return sides.filter((hl >= least) & (hr >= least) & (hr > 0)).select(*histogram.columns, "gl", "hl", "gr", "hr", gain.alias("gain"))


def best_splits(gains: DataFrame, by: Sequence[str], gamma: Column) -> DataFrame:
    """The split with the highest gain for every ``by``, if that is above ``gamma``; the first feature and bin of equal ones."""
    rank = F.struct(F.round("gain", GAIN_DIGITS).alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "gl", "hl", "gr", "hr")
    best = gains.filter(F.round("gain", GAIN_DIGITS) > F.greatest(gamma, F.lit(0.0))).groupBy(*by).agg(F.max(rank).alias("s"))
    return best.select(*by, (-F.col("s.f")).alias("feature"), (-F.col("s.b")).alias("bin"), "s.gain", "s.gl", "s.hl", "s.gr", "s.hr")


def quantile_cuts(rows: DataFrame, features_col: str, max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Upper ends of the bins of every feature: its distinct quantiles, the least and the greatest value among them."""
    width = rows.select(F.size(features_col).alias("n")).first()
    if width is None or width.n <= 0:
        raise ValueError("there are no rows with features")
    if width.n > MAX_FEATURES:
        raise ValueError(f"more than {MAX_FEATURES} features")
    shares = [k / (max_bins - 1) for k in range(max_bins)]
    found = rows.agg(*[F.percentile_approx(F.col(features_col)[k], shares, 100 * max_bins).alias(f"f{k}") for k in range(width.n)]).first()
    return [np.unique(np.array(values if values is not None else [0.0], float)) for values in found]


def bins_of(features: pa.Array, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin numbers by row and feature. A missing value comes behind all others."""
    values = np.asarray(features.flatten().to_numpy(zero_copy_only=False), float).reshape(-1, len(cuts))
    out = np.empty(values.shape, np.uint8)
    for k, ends in enumerate(cuts):
        out[:, k] = np.searchsorted(ends, values[:, k], "left")
    return out


@dataclass
class Binned:
    """Binned rows (``bins``, label, ``weight``, ``fold``, ``row``), shared by all models, and where the bins end."""

    rows: DataFrame
    cuts: list[np.ndarray]
    with_features: DataFrame


def bin_rows(train: DataFrame, features_col: str = "features", max_bins: int = MAX_BINS) -> Binned:
    """Rows with ``features`` (a vector), label, ``weight`` and ``fold``, binned and written once."""
    flat = train.select(vector_to_array(features_col).alias("x"), F.col(LABEL).cast("int").alias(LABEL), F.col("weight").cast("double").alias("weight"), F.col("fold").cast("int").alias("fold"))
    cuts = quantile_cuts(flat, "x", max_bins)

    @F.arrow_udf("binary")
    def binned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([row.tobytes() for row in bins_of(batch, cuts)], pa.binary())

    numbered = spread(flat).withColumn("row", F.monotonically_increasing_id())
    table = materialise(numbered.select(binned("x").alias("bins"), LABEL, "weight", "fold", "row", "x"), "binned")
    return Binned(table.drop("x"), cuts, table.select("row", "x"))


def log_odds(binned: Binned, models: Sequence[Booster]) -> DataFrame:
    """``row`` and the log odds of every model, from the bins."""
    trees = [model.trees for model in models]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bins = _bins(batch)
                sums = [sum((tree.margins(bins) for tree in own), np.zeros(len(bins))) for own in trees]
                columns = [batch.column("row"), pa.array(np.column_stack(sums).tolist(), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, ["row", "log_odds"])

    return binned.rows.mapInArrow(add, "row long, log_odds array<double>")


def sampled(rows: np.ndarray, share: float, seed: int, tree: int) -> np.ndarray:
    """Which rows a tree is grown from: a hash of row, seed and tree, so a pass that runs again draws the same."""
    if share >= 1:
        return np.ones(len(rows), bool)
    with np.errstate(over="ignore"):
        x = rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 1_000_003 + tree * 7919 + 1) % 2**63)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return x / 2.0**64 < share


def chosen_features(count: int, share: float, seed: int, tree: int) -> np.ndarray:
    """The features that a tree may split by."""
    taken = max(1, round(count * share))
    return np.sort(np.random.default_rng([seed, tree]).choice(count, taken, replace=False))


def fit(binned: Binned, tasks: Sequence[tuple[Point, int | None]], seed: int = 0) -> list[Booster]:
    """One model for each pair of a point and the fold that is left out of its training (none: all rows).

    Models grow side by side: level by level, one pass over the rows for all of them. The log odds
    start at 0. A model whose trees are all grown drops out of the passes.
    """
    spark = binned.rows.sparkSession
    models = [Booster(point, binned.cuts) for point, _ in tasks]
    params = spark.createDataFrame(
        [(k, *(float(getattr(point, name)) for name in ("reg_alpha", "reg_lambda", "min_child_weight", "gamma"))) for k, (point, _) in enumerate(tasks)],
        "model int, reg_alpha double, reg_lambda double, min_child_weight double, gamma double",
    )
    params = F.broadcast(params)  # a row for each model
    state = materialise(_with_margins(binned.rows, [[] for _ in tasks]), "margins")
    width = len(binned.cuts)
    saved = 0
    for number in range(max((point.n_estimators for point, _ in tasks), default=0)):
        growing = [k for k, (point, _) in enumerate(tasks) if number < point.n_estimators]
        for k in growing:
            models[k].trees.append(Tree(tasks[k][0].max_depth))
        open_places = {k: [0] for k in growing}
        while any(open_places.values()):
            jobs = [
                (k, tasks[k][1], tasks[k][0].subsample, places, chosen_features(width, tasks[k][0].colsample_bytree, seed, number))
                for k, places in open_places.items()
                if places
            ]
            pending = [model.trees[saved:] if k in growing else [] for k, model in enumerate(models)]
            sums = cut_lineage(_histogram(state, jobs, pending, seed, number)).join(params, "model")
            by = ["model", "place"]
            gains = split_gains(sums, by, F.col("reg_alpha"), F.col("reg_lambda"), F.col("min_child_weight"))
            best = best_splits(gains.filter(F.round("gain", GAIN_DIGITS) > F.col("gamma")), by, F.lit(0.0))
            # only the first pass of a tree needs the sums of a whole node; later ones come with the splits
            whole = _totals(sums) if any(places == [0] for places in open_places.values()) else None
            open_places = _grow(models, tasks, jobs, best.collect(), whole)
        if number + 1 - saved == SAVED_EVERY:
            state = materialise(_with_margins(state, [model.trees[saved:] for model in models]), "margins")
            saved = number + 1
    return models


def _totals(sums: DataFrame) -> dict[tuple[int, int], tuple[float, float]]:
    """Gradient and hessian sums of every node: those of its first feature."""
    first = Window.partitionBy("model", "place")
    one = sums.withColumn("_first", F.min("feature").over(first)).filter("feature = _first")
    return {(r.model, r.place): (r.g, r.h) for r in one.groupBy("model", "place").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()}


def _weight(point: Point, g: float, h: float) -> float:
    """Value of a leaf."""
    moved = np.sign(g) * max(abs(g) - point.reg_alpha, 0.0)
    return float(-point.learning_rate * moved / (h + point.reg_lambda)) if h + point.reg_lambda > 0 else 0.0


def _grow(models, tasks, jobs, splits, whole) -> dict[int, list[int]]:
    """Puts the splits into the trees and returns the places to look at next, by model."""
    if whole is not None:
        for (k, place), (g, h) in whole.items():
            if place == 0:
                models[k].trees[-1].value[0] = _weight(tasks[k][0], g, h)
    fresh: dict[int, list[int]] = {k: [] for k, *_ in jobs}
    for split in splits:
        point, tree, at = tasks[split.model][0], models[split.model].trees[-1], split.place
        tree.feature[at], tree.cut[at] = split.feature, split.bin
        children = 2 * at + 1, 2 * at + 2
        for child, g, h in ((children[0], split.gl, split.hl), (children[1], split.gr, split.hr)):
            tree.value[child] = _weight(point, g, h)
        depth = (at + 1).bit_length()
        tree.depth = max(tree.depth, depth)
        if depth < point.max_depth:
            fresh[split.model].extend(children)
    return fresh


def _matrix(column: pa.Array, kind, width: int) -> np.ndarray:
    """Rows of numbers kept as bytes."""
    return np.frombuffer(b"".join(value.as_py() for value in column), kind).reshape(len(column), width)


def _with_margins(rows: DataFrame, trees: list[list[Tree]]) -> DataFrame:
    """Rows with ``margins``, the sums of each model's trees so far, moved on by ``trees``."""
    started = "margins" in rows.columns
    names = ["bins", LABEL, "weight", "fold", "row"]

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = _bins(batch)
            margins = _matrix(batch.column("margins"), np.float64, len(trees)).copy() if started else np.zeros((batch.num_rows, len(trees)))
            for k, own in enumerate(trees):
                for tree in own:
                    margins[:, k] += tree.margins(bins)
            column = pa.array([row.tobytes() for row in margins], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in names), column], [*names, "margins"])

    return rows.mapInArrow(move, f"bins binary, {LABEL} int, weight double, fold int, row long, margins binary")


def _bins(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("bins")
    return _matrix(column, np.uint8, len(column[0].as_py()))


def _histogram(state: DataFrame, jobs: list[tuple], pending: list[list[Tree]], seed: int, number: int) -> DataFrame:
    """``g`` and ``h`` by ``model``, ``place``, ``feature`` and ``bin`` over the rows each model is trained on."""
    models = len(pending)
    depth = MAX_BINS + 2  # bins of a feature, one for missing values among them

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            kept.append(batch)
            if sum(b.num_rows for b in kept) >= AT_ONCE:
                yield pa.Table.from_batches(kept).combine_chunks()
                kept = []
        if kept:
            yield pa.Table.from_batches(kept).combine_chunks()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {k: np.zeros((2, len(places) * len(features) * depth)) for k, _, _, places, features in jobs}
        for table in together(batches):
            if not table.num_rows:
                continue
            part = table.to_batches()[0]
            bins = _bins(part)
            margins = _matrix(part.column("margins"), np.float64, models)
            label, weight = part.column(LABEL).to_numpy(), part.column("weight").to_numpy()
            fold, row = part.column("fold").to_numpy(zero_copy_only=False), part.column("row").to_numpy()
            for k, left_out, share, places, features in jobs:
                use = sampled(row, share, seed, number)
                if left_out is not None:
                    use &= fold != left_out
                own = bins[use]
                if not len(own):
                    continue
                margin = margins[use, k] + sum((tree.margins(own) for tree in pending[k][:-1]), np.zeros(len(own)))
                p = 1 / (1 + np.exp(-margin))
                g, h = weight[use] * (p - label[use]), weight[use] * p * (1 - p)
                order = np.full(2 ** (int(max(places)) + 2).bit_length(), -1)
                order[places] = np.arange(len(places))
                node = order[pending[k][-1].places(own)]
                there = node >= 0
                cell = (node[there, None] * len(features) + np.arange(len(features))) * depth + own[there][:, features]
                for kind, value in enumerate((g[there], h[there])):
                    sums[k][kind] += np.bincount(cell.ravel(), np.repeat(value, len(features)), sums[k].shape[1])
        for k, _, _, places, features in jobs:
            cells = np.flatnonzero(sums[k][1])
            at, bin_ = np.divmod(cells, depth)
            node, feature = np.divmod(at, len(features))
            columns = [
                np.full(len(cells), k, np.int32),
                np.asarray(places, np.int32)[node],
                np.asarray(features, np.int32)[feature],
                bin_.astype(np.int32),
                sums[k][0][cells],
                sums[k][1][cells],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["model", "place", "feature", "bin", "g", "h"])

    found = state.mapInArrow(count, "model int, place int, feature int, bin int, g double, h double")
    return found.groupBy("model", "place", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


@dataclass
class Searched:
    """Points with their mean and deviation of the average precision over the folds, and the best one's model on all rows."""

    points: list[Point]
    scores: list[list[float]]
    best: Booster

    def ranking(self) -> list[tuple[int, str, float, float]]:
        order = sorted(range(len(self.points)), key=lambda k: -float(np.mean(self.scores[k])))
        return [
            (rank, ", ".join(f"{n}={v}" for n, v in sorted(asdict(self.points[k]).items())), float(np.mean(self.scores[k])), float(np.std(self.scores[k])))
            for rank, k in enumerate(order, start=1)
        ]


def search(binned: Binned, points: Sequence[Mapping[str, object] | Point], folds: int, seed: int = 0) -> Searched:
    """Scores every point by average precision on each fold left out, and fits the best on all rows."""
    points = [p if isinstance(p, Point) else Point(**p) for p in points]
    tasks = [(point, fold) for point in points for fold in range(folds)]
    models = fit(binned, tasks, seed)
    found = fold_precisions(binned, models, [fold for _, fold in tasks])
    scores = [[found.get(k * folds + fold, 0.0) for fold in range(folds)] for k in range(len(points))]
    best = max(range(len(points)), key=lambda k: float(np.mean(scores[k])))
    return Searched(points, scores, fit(binned, [(points[best], None)], seed)[0])


def fold_precisions(binned: Binned, models: Sequence[Booster], left_out: Sequence[int]) -> dict[int, float]:
    """Average precision of every model over the fold it was not trained on, in one pass."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, fold, label = _bins(batch), batch.column("fold").to_numpy(zero_copy_only=False), batch.column(LABEL)
            for k, model in enumerate(models):
                own = np.flatnonzero(fold == left_out[k])
                if len(own):
                    margin = sum((tree.margins(bins[own]) for tree in model.trees), np.zeros(len(own)))
                    columns = [pa.array(np.full(len(own), k, np.int32)), label.take(pa.array(own)), pa.array(1 / (1 + np.exp(-margin)))]
                    yield pa.RecordBatch.from_arrays(columns, ["model", LABEL, "p"])

    rows = binned.rows.mapInArrow(scored, f"model int, {LABEL} int, p double")
    return {r.model: r.average_precision for r in average_precision(ranked_cumulative(rows, by=["model"]), by=["model"]).collect()}
