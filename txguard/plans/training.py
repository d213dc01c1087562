"""Training plan: features, split, search, threshold, test metrics, package."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from math import prod

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard.functions.buckets import SEED
from txguard.functions.features import HIGH_RISK_MERCHANTS
from txguard.operators import boosting
from txguard.operators.balance import (
    add_weight,
    assign_fold,
    assign_split,
    require_positives,
    split_counts,
)
from txguard.operators.exact_split import assign_exact_folds, assign_exact_split
from txguard.operators.featurize import add_features
from txguard.operators.metrics import AveragePrecisionEvaluator
from txguard.operators.ranked import best_threshold, evaluation_summary, pr_curve, ranked_cumulative, roc_curve
from txguard.operators.scoring import SCORE, score_with_model
from txguard.schema import FEATURES, LABEL, NUMERIC_FEATURES
from txguard.session import TASK_BYTES, cut_lineage, dealt, materialise, shared_dir, spread

# The searched lists of Spark's own learner, which has no counterpart for L1 and L2 terms.
SEARCH_SPACE = {
    "maxIter": [200, 300, 500, 700],
    "maxDepth": [3, 4, 5, 6],
    "stepSize": [0.02, 0.05, 0.08, 0.1],
    "subsamplingRate": [0.7, 0.8, 0.9, 1.0],
    "featureSubsetStrategy": ["0.7", "0.8", "0.9", "1.0"],
    "minInstancesPerNode": [1, 3, 5, 10],
    "minInfoGain": [0.0, 0.1, 0.3, 0.5],
}

# The searched lists of the second-order booster, which has all terms.
BOOST_SPACE = {
    "n_estimators": [200, 300, 500, 700],
    "max_depth": [3, 4, 5, 6],
    "learning_rate": [0.02, 0.05, 0.08, 0.1],
    "subsample": [0.7, 0.8, 0.9, 1.0],
    "colsample_bytree": [0.7, 0.8, 0.9, 1.0],
    "min_child_weight": [1, 3, 5, 10],
    "gamma": [0, 0.1, 0.3, 0.5],
    "reg_alpha": [0, 0.01, 0.1, 0.5],
    "reg_lambda": [1, 2, 5, 10],
}

# Search effort and shares.
N_ITER = 20
FOLDS = 3
PARALLELISM = 4
TEST_SHARE = 0.20
VALIDATION_SHARE = 0.20

# The one-hot vector has one slot per location; the list of them is held by the model.
MAX_LOCATIONS = 100_000


@dataclass
class Prepared:
    """Assembled rows (features, label, weight, fold, split) and what was learned on the way."""

    table: DataFrame
    encoder: PipelineModel
    positive_weight: float
    counts: dict[tuple[str, int], int]

    @property
    def train(self) -> DataFrame:
        rows = self.table.filter(F.col("split") == "train").select("features", LABEL, "weight", "fold")
        return dealt(rows, self.size("train"), row_bytes(len(self.encoder.stages[0].labels)), TASK_BYTES)

    @property
    def held_out(self) -> DataFrame:
        return self.table.filter(F.col("split") != "train")

    def size(self, split: str) -> int:
        return self.counts.get((split, 0), 0) + self.counts.get((split, 1), 0)

    @property
    def positives(self) -> int:
        return sum(n for (_, label), n in self.counts.items() if label == 1)


@dataclass
class Trained:
    model: PipelineModel
    threshold: float
    metrics: dict[str, float]
    params: dict[str, object]
    best_params: dict[str, object]
    search: CrossValidatorModel = field(repr=False)
    ranked_test: DataFrame = field(repr=False)


def labelled_features(
    tx: DataFrame,
    seed: int = SEED,
    test_share: float = TEST_SHARE,
    validation_share: float = VALIDATION_SHARE,
    high_risk: Sequence[str] = HIGH_RISK_MERCHANTS,
    exact: bool = False,
) -> DataFrame:
    """Clean transactions to id, model inputs, label and split, in one projection.

    ``exact`` keeps the class counts of every part exact, at the price of two narrow passes.
    """
    assign = assign_exact_split if exact else assign_split
    split = assign(add_features(tx, high_risk), seed, test_share, validation_share)
    return split.select("transaction_id", *FEATURES, LABEL, "split")


def preprocessing() -> list:
    """One slot per known location, in alphabetical order; unknown or missing gives all zeros."""
    indexer = StringIndexer(
        inputCol="location", outputCol="location_index", handleInvalid="keep", stringOrderType="alphabetAsc"
    )
    # the indexer's extra slot for unknown values is the one that is dropped
    encoder = OneHotEncoder(inputCols=["location_index"], outputCols=["location_onehot"], dropLast=True)
    assembler = VectorAssembler(inputCols=["location_onehot", *NUMERIC_FEATURES], outputCol="features")
    return [indexer, encoder, assembler]


def fit_preprocessing(train: DataFrame, max_locations: int = MAX_LOCATIONS) -> PipelineModel:
    """One grouping finds the locations; ``max_locations`` bounds what the driver and the model hold of them."""
    found = train.select("location").filter("location IS NOT NULL").distinct().limit(max_locations + 1)
    found = [row.location for row in found.collect()]
    if len(found) > max_locations:
        raise ValueError(f"more than {max_locations} locations: validate the location codes before training")
    indexer, *others = preprocessing()
    known = StringIndexerModel.from_labels(sorted(found), inputCol="location", outputCol="location_index", handleInvalid="keep")
    return Pipeline(stages=[known, *others]).fit(train.limit(1)) if found else Pipeline(stages=[indexer, *others]).fit(train)


def row_bytes(locations: int) -> int:
    """Bytes that the learner keeps of a row: a whole number for every input, beside objects for bags, weights and errors."""
    return 512 + 4 * (locations + len(NUMERIC_FEATURES))


def learner_rows(train: DataFrame) -> DataFrame:
    """Labelled features, dealt out to as many tasks as the learner needs for them."""
    found = train.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("location").alias("locations")).first()
    return dealt(train, found.rows, row_bytes(found.locations), TASK_BYTES)


def classifier(seed: int = SEED, **params) -> GBTClassifier:
    return GBTClassifier(labelCol=LABEL, featuresCol="features", weightCol="weight", seed=seed, **params)


def draw_params(space: Mapping[str, Sequence], n_iter: int, seed: int) -> list[dict[str, object]]:
    """Distinct random points of the grid, the same for the same seed; all points if ``n_iter`` exceeds them."""
    size = prod(len(values) for values in space.values())
    points = []
    for number in random.Random(seed).sample(range(size), min(n_iter, size)):
        point = {}
        for name, values in space.items():
            number, choice = divmod(number, len(values))
            point[name] = values[choice]
        points.append(point)
    return points


class FoldColumnValidator(CrossValidator):
    """Cross-validation over a given fold column.

    The stock version checks the column with a row-wise Python function on every pass; here the
    column is made by ``assign_fold`` and only compared.
    """

    def _kFold(self, dataset: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
        column = F.col(self.getOrDefault(self.foldCol))
        return [(dataset.filter(column != i), dataset.filter(column == i)) for i in range(self.getNumFolds())]


def search(
    train: DataFrame,
    estimator: Estimator,
    points: Sequence[Mapping[str, object]],
    folds: int = FOLDS,
    parallelism: int = PARALLELISM,
) -> CrossValidatorModel:
    """Score every point by average precision over the folds and refit the best on all of ``train``.

    ``train`` has features, label, weight and fold. A failing fit fails the search.
    """
    maps = [{estimator.getParam(name): value for name, value in point.items()} for point in points]
    validator = FoldColumnValidator(
        estimator=estimator,
        estimatorParamMaps=maps,
        evaluator=AveragePrecisionEvaluator(),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    )
    return validator.fit(train)


def search_boosted(
    prepared: Prepared, space: Mapping[str, Sequence] = BOOST_SPACE, n_iter: int = N_ITER, folds: int = FOLDS, seed: int = SEED
) -> boosting.Searched:
    """Random search of the second-order booster over the training part, all points and folds side by side.

    ``prepared`` has to have been made with the same number of folds.
    """
    binned = boosting.bin_rows(prepared.train)
    return boosting.search(binned, draw_params(space, n_iter, seed), folds, seed)


def search_table(spark: SparkSession, found: CrossValidatorModel) -> DataFrame:
    """One row per tried point: parameters, mean and deviation of the score, rank."""
    trials = found.getEstimatorParamMaps()
    order = sorted(range(len(trials)), key=lambda i: -found.avgMetrics[i])
    rows = []
    for rank, i in enumerate(order, start=1):
        params = ", ".join(sorted(f"{param.name}={value}" for param, value in trials[i].items()))
        rows.append((rank, params, float(found.avgMetrics[i]), float(found.stdMetrics[i])))
    return spark.createDataFrame(rows, "rank int, params string, mean_score double, std_score double")


def prepare_table(
    tx: DataFrame,
    folds: int = FOLDS,
    seed: int = SEED,
    test_share: float = TEST_SHARE,
    validation_share: float = VALIDATION_SHARE,
    high_risk: Sequence[str] = HIGH_RISK_MERCHANTS,
    exact: bool = False,
    max_locations: int = MAX_LOCATIONS,
) -> Prepared:
    """Features, split, guard, weight and encoding; nothing is learned outside the training part.

    Both tables are written once, partitioned by split. Every later fit and evaluation then reads
    narrow rows of the splits it needs instead of running the source again.
    """
    labelled = materialise(
        labelled_features(tx, seed, test_share, validation_share, high_risk, exact), "labelled", ["split"]
    )
    # other labels are one group, so the driver gets a few counts whatever the label column holds
    known = labelled.withColumn(LABEL, F.when(F.col(LABEL).isin(0, 1), F.col(LABEL)))
    counts = {(row.split, row[LABEL]): row.n for row in split_counts(known).collect()}
    if not {label for _, label in counts} <= {0, 1}:
        raise ValueError("the label has values other than 0 and 1")
    require_positives(sum(n for (_, label), n in counts.items() if label == 1))

    # the weight comes from the counts at hand: negatives for each positive of the training part
    weight = counts.get(("train", 0), 0) / max(1, counts.get(("train", 1), 0))
    encoder = fit_preprocessing(labelled.filter(F.col("split") == "train"), max_locations)
    folded = assign_exact_folds(labelled, folds, seed) if exact else assign_fold(labelled, folds, seed=seed)
    assembled = encoder.transform(add_weight(spread(folded, scan=labelled), weight))
    table = materialise(assembled.select("features", LABEL, "weight", "fold", "split"), "assembled", ["split"])
    return Prepared(table, encoder, weight, counts)


def train_evaluate(
    tx: DataFrame,
    space: Mapping[str, Sequence] = SEARCH_SPACE,
    n_iter: int = N_ITER,
    folds: int = FOLDS,
    seed: int = SEED,
    parallelism: int = PARALLELISM,
    estimator: Estimator | None = None,
    **preparation,
) -> Trained:
    """Full training run over clean transactions.

    Parameters are searched on the training part, the threshold is chosen on the validation part,
    the metrics are those of the test part.
    """
    shared_dir(tx.sparkSession)  # the learner cuts long boosting lineages there
    prepared = prepare_table(tx, folds, seed, **preparation)
    points = draw_params(space, n_iter, seed)
    found = search(prepared.train, estimator or classifier(seed), points, folds, parallelism)
    best = max(range(len(points)), key=lambda i: found.avgMetrics[i])

    scores = score_with_model(prepared.held_out, found.bestModel)
    ranked = ranked_cumulative(scores, SCORE, by=["split"])
    ranked = cut_lineage(ranked)  # the scores of both parts are read several times
    threshold = best_threshold(ranked.filter(F.col("split") == "validation")).first().threshold
    test = ranked.filter(F.col("split") == "test")
    summary = evaluation_summary(test, threshold).first()

    rows = sum(prepared.counts.values())
    return Trained(
        model=PipelineModel([*prepared.encoder.stages, found.bestModel]),
        threshold=threshold,
        metrics=summary.asDict(),
        params={
            **{f"{split}_samples": prepared.size(split) for split in ("train", "validation", "test")},
            "fraud_samples": prepared.positives,
            "fraud_rate": prepared.positives / rows,
            "positive_weight": prepared.positive_weight,
        },
        best_params=points[best],
        search=found,
        ranked_test=test,
    )


def test_tables(trained: Trained) -> dict[str, DataFrame]:
    """Curves and confusion matrix of the test part, to be kept beside the model."""
    ranked = trained.ranked_test
    called = F.col("score") >= trained.threshold
    hits, calls = F.sum(F.when(called, F.col("pos"))), F.sum(F.when(called, F.col("n")))
    counts = ranked.agg(
        F.coalesce(hits, F.lit(0)).alias("tp"),
        (F.coalesce(calls, F.lit(0)) - F.coalesce(hits, F.lit(0))).alias("fp"),
        (F.coalesce(F.sum("pos"), F.lit(0)) - F.coalesce(hits, F.lit(0))).alias("fn"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )
    matrix = counts.select("tp", "fp", "fn", (F.col("total") - F.col("tp") - F.col("fp") - F.col("fn")).alias("tn"))
    return {"pr_curve": pr_curve(ranked), "roc_curve": roc_curve(ranked), "confusion_matrix": matrix}


def metrics_row(spark: SparkSession, trained: Trained) -> DataFrame:
    """The run metrics as a one-row table."""
    schema = ", ".join(f"{name} double" for name in trained.metrics)
    return spark.createDataFrame([tuple(trained.metrics.values())], schema)
