"""Metrics of 0/1 decisions, and the search score."""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.operators.ranked import average_precision, ranked_cumulative
from txguard.schema import LABEL


def _cell(actual: int, predicted: int, label: str, prediction: str):
    return F.count_if((F.col(label) == actual) & (F.col(prediction) == predicted))


def confusion_matrix(predicted: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Always four rows. Four counters in one pass, so nothing is shuffled but the counts."""
    cells = [(actual, decided) for actual in (0, 1) for decided in (0, 1)]
    counted = predicted.agg(*[_cell(a, d, label, prediction).alias(f"n{a}{d}") for a, d in cells])
    rows = [
        F.struct(F.lit(a).alias("actual"), F.lit(d).alias("predicted"), F.col(f"n{a}{d}").alias("n")) for a, d in cells
    ]
    return counted.select(F.inline(F.array(*rows)))


def threshold_metrics(predicted: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Precision, recall and F1 (0 where undefined) and the predicted fraud rate."""
    counts = predicted.agg(
        _cell(1, 1, label, prediction).alias("tp"),
        _cell(0, 1, label, prediction).alias("fp"),
        _cell(1, 0, label, prediction).alias("fn"),
        F.avg(prediction).alias("predicted_fraud_rate"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")

    def ratio(part, whole, name):
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0)).alias(name)

    return counts.select(
        ratio(tp, tp + fp, "precision"),
        ratio(tp, tp + fn, "recall"),
        ratio(2 * tp, 2 * tp + fp + fn, "f1"),
        "predicted_fraud_rate",
    )


class AveragePrecisionEvaluator(Evaluator):
    """Average precision as a step sum. The built-in area under PR interpolates and differs."""

    def __init__(self, label: str = LABEL, probability: str = "probability"):
        super().__init__()
        self._label = label
        self._probability = probability

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = dataset.select(vector_to_array(self._probability)[1].alias("p"), self._label)
        return average_precision(ranked_cumulative(scored, label=self._label)).first()[0]

    def isLargerBetter(self) -> bool:
        return True
