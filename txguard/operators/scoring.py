"""Scores, decisions and outgoing messages."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import SparkFiles
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.functions.decision import decide
from txguard.operators.barrier import evaluate_once
from txguard.schema import FEATURES

SCORE = "fraud_probability"
PREDICTION = "prediction"
# A Python model above this size is not broadcast: the driver would hold it several times over.
MAX_BROADCAST_BYTES = 64_000_000


def score_with_model(features: DataFrame, model: Model, score: str = SCORE) -> DataFrame:
    """Probability of class 1 from a fitted Spark ML model. Stays in the JVM."""
    probability = vector_to_array("probability")[1]
    return evaluate_once(model.transform(features), score, probability).select(*features.columns, score)


def score_with_python(
    features: DataFrame,
    predict: Callable[[pd.DataFrame], Sequence[float]] | None = None,
    model: object | None = None,
    columns: Sequence[str] = FEATURES,
    score: str = SCORE,
) -> DataFrame:
    """Probability from a Python model, in Arrow batches.

    Give either ``predict`` (a batch of inputs to probabilities) or a ``model`` with
    ``predict_proba``, which is broadcast and may have ``MAX_BROADCAST_BYTES`` at most (larger ones go by
    :func:`score_with_file`). Marked non-deterministic so that the planner does not
    run it once for the filter and once more for the output.
    """
    if (predict is None) == (model is None):
        raise ValueError("give either predict or model")
    shared = None
    if model is not None:
        if len(pickle.dumps(model)) > MAX_BROADCAST_BYTES:
            raise ValueError(f"the model has more than {MAX_BROADCAST_BYTES} bytes: use score_with_file")
        shared = features.sparkSession.sparkContext.broadcast(model)

    def probability(batch: pd.DataFrame) -> pd.Series:
        values = shared.value.predict_proba(batch)[:, 1] if shared is not None else predict(batch)
        return pd.Series(values, dtype="float64")

    column = F.pandas_udf(probability, "double").asNondeterministic()(F.struct(*columns))
    return features.withColumn(score, column)


def score_with_file(
    features: DataFrame,
    path: str,
    load: Callable[[str], object],
    columns: Sequence[str] = FEATURES,
    score: str = SCORE,
) -> DataFrame:
    """Probability from a Python model of any size that lies in a file every executor reaches.

    Executors fetch the file themselves, and every Python worker calls ``load`` with the place of its
    copy once, however many tasks and batches it works on; the driver never opens it. ``load`` returns
    something with ``predict_proba``. Files are known by their name, so each version needs its own.
    """
    features.sparkSession.sparkContext.addFile(path)
    name = path.rstrip("/").split("/")[-1]

    def probability(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model = _loaded(name, load)
        for batch in batches:
            yield pd.Series(model.predict_proba(batch)[:, 1], dtype="float64")

    column = F.pandas_udf(probability, "double").asNondeterministic()(F.struct(*columns))
    return features.withColumn(score, column)


# The model that this worker has loaded last, by the name of its file.
_models: dict[str, object] = {}


def _loaded(name: str, load: Callable[[str], object]) -> object:
    if name not in _models:
        _models.clear()
        _models[name] = load(SparkFiles.get(name))
    return _models[name]


def apply_threshold(scored: DataFrame, threshold: float, score: str = SCORE) -> DataFrame:
    return scored.withColumn(PREDICTION, decide(F.col(score), threshold))


def fraud_only(predicted: DataFrame) -> DataFrame:
    return predicted.filter(F.col(PREDICTION) == 1)


def to_messages(df: DataFrame, exclude: Sequence[str] = (), key: str = "transaction_id") -> DataFrame:
    """Key and JSON value of every column not excluded; missing values are left out of the JSON."""
    body = [name for name in df.columns if name not in exclude]
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*body)).alias("value"))
