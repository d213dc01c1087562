"""Messages to scored transactions; the same plan for batch and stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame

from txguard.functions.features import HIGH_RISK_MERCHANTS
from txguard.operators.decode import coerce_types, decode_json
from txguard.operators.featurize import add_features
from txguard.operators.quality import clean
from txguard.operators.scoring import apply_threshold, fraud_only, score_with_model, to_messages

Scorer = Callable[[DataFrame], DataFrame]


def model_scorer(model: Model) -> Scorer:
    return lambda features: score_with_model(features, model)


def messages_to_features(
    messages: DataFrame,
    label_required: bool = False,
    high_risk: Sequence[str] = HIGH_RISK_MERCHANTS,
    counted: bool = False,
) -> DataFrame:
    """Decode, coerce, keep usable rows, add features. Scoring does not ask for a label.

    ``counted`` counts all and the unusable messages on the way (see ``streaming.sinks.ProgressLog``).
    """
    typed = coerce_types(decode_json(messages))
    return add_features(clean(typed, label_required, counted), high_risk)


def score_messages(
    messages: DataFrame,
    scorer: Scorer,
    threshold: float,
    high_risk: Sequence[str] = HIGH_RISK_MERCHANTS,
    counted: bool = False,
) -> DataFrame:
    """Every usable transaction with features, score and decision."""
    features = messages_to_features(messages, high_risk=high_risk, counted=counted)
    return apply_threshold(scorer(features), threshold)


def alerts(scored: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Outgoing messages of the transactions decided as fraud."""
    return to_messages(fraud_only(scored), exclude)
