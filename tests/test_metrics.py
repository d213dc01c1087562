import pytest
from pyspark.ml.linalg import Vectors

from txguard.operators import metrics
from txguard.operators.ranked import average_precision, ranked_cumulative


def predicted(spark, pairs):
    return spark.createDataFrame(pairs, "is_fraud int, prediction int")


def cells(df):
    return {(row.actual, row.predicted): row.n for row in metrics.confusion_matrix(df).collect()}


def test_four_cells_always(spark):
    assert cells(predicted(spark, [(0, 0), (0, 1), (1, 1), (1, 1)])) == {(0, 0): 1, (0, 1): 1, (1, 0): 0, (1, 1): 2}
    assert cells(predicted(spark, [])) == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 0}


def test_threshold_metrics(spark):
    row = metrics.threshold_metrics(predicted(spark, [(0, 0), (0, 1), (1, 1), (1, 1), (1, 0)])).first()
    assert row.precision == pytest.approx(2 / 3) and row.recall == pytest.approx(2 / 3)
    assert row.f1 == pytest.approx(2 / 3) and row.predicted_fraud_rate == pytest.approx(0.6)


def test_undefined_metrics_are_zero(spark):
    row = metrics.threshold_metrics(predicted(spark, [(0, 0), (0, 0)])).first()
    assert (row.precision, row.recall, row.f1, row.predicted_fraud_rate) == (0.0, 0.0, 0.0, 0.0)


def test_evaluator_is_the_step_sum(spark):
    pairs = [(0.1, 0), (0.4, 1), (0.4, 0), (0.8, 1), (0.9, 0)]
    vectors = spark.createDataFrame([(Vectors.dense(1 - p, p), y) for p, y in pairs], ["probability", "is_fraud"])
    plain = spark.createDataFrame(pairs, "p double, is_fraud int")
    evaluator = metrics.AveragePrecisionEvaluator()
    assert evaluator.evaluate(vectors) == pytest.approx(average_precision(ranked_cumulative(plain)).first()[0])
    assert evaluator.isLargerBetter()
