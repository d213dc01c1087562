"""Toxicity by a logistic classifier that is kept from reacting to mentions of groups.

Features are the words of a text and their beginnings. Besides the labelled texts the fit sees
counterfactuals: in sentences that mention a group, the mention is swapped for another one. A
penalty on the squared change of the score under a swap makes the weights of group terms alike and
small, so that a neutral mention is not taken for an insult.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard.llm.documents import per_value
from txguard.llm.labelled import labelled_sample

# Terms that name groups of people, by kind. A term is swapped for others of its line.
IDENTITY_TERMS = [
    ["women", "men", "girls", "boys"],
    ["woman", "man", "girl", "boy"],
    ["christians", "muslims", "jews", "hindus", "buddhists", "atheists"],
    ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist"],
    ["gay", "lesbian", "straight", "bisexual", "transgender", "queer"],
    ["african", "asian", "european", "american", "arab", "latino"],
    ["immigrants", "refugees", "foreigners", "natives", "citizens"],
    ["blind", "deaf", "disabled", "elderly"],
    ["frauen", "männer", "mädchen", "jungen"],
    ["christen", "muslime", "juden", "hindus", "buddhisten"],
    ["einwanderer", "flüchtlinge", "ausländer"],
    ["femmes", "hommes", "filles", "garçons"],
    ["chrétiens", "musulmans", "juifs", "hindous", "bouddhistes"],
    ["immigrés", "réfugiés", "étrangers"],
    ["mujeres", "hombres", "chicas", "chicos"],
    ["cristianos", "musulmanes", "judíos", "hindúes", "budistas"],
    ["inmigrantes", "refugiados", "extranjeros"],
]
SWAPS = {
    term.encode(): [other.encode() for other in line if other != term] for line in IDENTITY_TERMS for term in line
}

BEGINNINGS = (4, 5, 6)  # bytes of a word that make a feature of their own
LONGEST = 40  # bytes; longer words are known by their beginnings only
FEATURES = 4096  # features of a model at most
LEAST_TEXTS = 4  # toxic texts in the sample that a feature must occur in
LEAST_RATIO = 4.0  # times a feature must be more frequent among toxic texts
PENALTY = 1.0  # of the mean squared change of the score under a swap
DECAY = 1e-4
STEPS = 400
THRESHOLD = 0.3
KEPT_WORDS = 100_000  # words of a worker whose features are kept; when full, the table fills anew

# ASCII characters other than letters part words; bytes from 0x80 belong to letters and signs of other scripts.
_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_SENTENCE = re.compile(rb"[.!?\n]+")


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_LETTERS).split()


def features_of(word: bytes) -> list[bytes]:
    """The word between marks, and its beginnings."""
    own = [b"^" + word + b"$"] if len(word) <= LONGEST else []
    return own + [b"^" + word[:size] for size in BEGINNINGS if len(word) > size]


def swapped(text: str) -> list[set[bytes]]:
    """Words of the text with the group terms of its sentences swapped: once for each of two other terms."""
    sentences = [s.translate(_LETTERS).split() for s in _SENTENCE.split(text.lower().encode())]
    if not any(word in SWAPS for sentence in sentences for word in sentence):
        return []
    return [
        {SWAPS[word][turn % len(SWAPS[word])] if word in SWAPS else word for sentence in sentences for word in sentence}
        for turn in (0, 1)
    ]


@dataclass
class Model:
    weights: dict[bytes, float]
    bias: float

    def scorer(self) -> Callable[[str], float]:
        """Score of a text: the sum over its distinct features, through the logistic function."""
        known: dict[bytes, tuple[bytes, ...]] = {}
        weights = self.weights

        def hits(word: bytes) -> tuple[bytes, ...]:
            found = known.get(word)
            if found is None:
                if len(known) > KEPT_WORDS:
                    known.clear()
                found = known[word] = tuple(f for f in features_of(word) if f in weights)
            return found

        def score(text: str) -> float:
            present = {f for word in set(words_of(text)) for f in hits(word)}
            total = self.bias + sum(sorted(map(weights.__getitem__, present)))
            return float(1 / (1 + np.exp(-np.clip(total, -60, 60))))

        return score


def select_features(sample: DataFrame) -> list[bytes]:
    """The features that tell toxic texts apart best, most telling first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("label"), strict=True):
                words = set(words_of(text.as_py()))
                seen[label.as_py()].update({f for word in words for f in features_of(word)})
        # what is never seen in a toxic text cannot be chosen, but its counts may be needed elsewhere
        features = list(seen[0].keys() | seen[1].keys())
        for start in range(0, len(features), 50_000):
            part = features[start : start + 50_000]
            columns = [part, [seen[1][f] for f in part], [seen[0][f] for f in part]]
            kinds = [pa.binary(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["feature", "toxic", "other"])

    totals = {row.label: row.n for row in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    counted = sample.select("text", "label").mapInArrow(count, "feature binary, toxic long, other long")
    summed = counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    rate = (F.col("toxic") + 0.5) / (totals.get(1, 0) + 1)
    ratio = rate / ((F.col("other") + 0.5) / (totals.get(0, 0) + 1))
    telling = summed.filter((F.col("toxic") >= LEAST_TEXTS) & (ratio >= LEAST_RATIO))
    best = telling.orderBy(F.desc(F.col("toxic") * F.log(ratio)), "feature").limit(FEATURES)
    return [bytes(row.feature) for row in best.select("feature").collect()]


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from a bounded sample of the labelled documents (see :func:`labelled_sample`).

    Without labels of both kinds the model gives every text the share of label 1, or 0 without any.
    """
    sample = labelled_sample(docs, labels, "toxic", learnable, id_col, text_col)
    features = select_features(sample)
    place = {feature: number for number, feature in enumerate(features)}

    def make():
        def present(words: Iterable[bytes]) -> list[int]:
            return sorted({place[f] for word in words for f in features_of(word) if f in place})

        return lambda text: {"own": present(set(words_of(text))), "swaps": [present(w) for w in swapped(text)]}

    kind = pa.struct([("own", pa.list_(pa.int32())), ("swaps", pa.list_(pa.list_(pa.int32())))])
    rows = sample.select("label", per_value(make, "struct<own: array<int>, swaps: array<array<int>>>", kind)("text").alias("x"))
    found = rows.select("label", "x.own", "x.swaps").collect()
    return train([row.own for row in found], [row.label for row in found], [row.swaps for row in found], features)


def train(texts: list[list[int]], labels: list[int], swaps: list[list[list[int]]], features: list[bytes], penalty: float = PENALTY) -> Model:
    """Least mean logistic loss, weight decay and swap penalty, by full gradient steps.

    The bias is then moved so that ``THRESHOLD`` stands where the sample is parted best, half-way
    between the scores on both sides.
    """
    y = np.array(labels, float)
    if not features or y.min(initial=1) == y.max(initial=0):
        share = float(y.mean()) if len(y) else 0.0
        return Model({}, _logit(share))
    own = _Rows(texts)
    pairs = [(row, swap) for row, all_swaps in enumerate(swaps) for swap in all_swaps]
    before, after = _Rows([texts[row] for row, _ in pairs]), _Rows([swap for _, swap in pairs])
    size = len(features)
    w, slow, fast = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        error = (1 / (1 + np.exp(-(own.sums(w) + w[-1]))) - y) / len(y)
        gradient = np.append(own.back(error, size) + DECAY * w[:-1], error.sum())
        if pairs:
            change = before.sums(w) - after.sums(w)
            gradient[:-1] += 2 * penalty / len(pairs) * (before.back(change, size) - after.back(change, size))
        slow = 0.9 * slow + 0.1 * gradient
        fast = 0.99 * fast + 0.01 * gradient**2
        w -= 0.1 * (slow / (1 - 0.9**step)) / (np.sqrt(fast / (1 - 0.99**step)) + 1e-8)
    cut = best_cut(own.sums(w), y)
    return Model({f: float(x) for f, x in zip(features, w, strict=False) if x}, _logit(THRESHOLD) - cut)


class _Rows:
    """Rows of present features, end to end."""

    def __init__(self, rows: list[list[int]]):
        self.count = len(rows)
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.at = np.concatenate([np.asarray(r, np.int64) for r in rows]) if rows else np.empty(0, np.int64)

    def sums(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.at], self.count)

    def back(self, values: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.at, values[self.row], size)


def best_cut(scores: np.ndarray, labels: np.ndarray) -> float:
    """The cut with the best F1 of label 1 at or above it; among equal ones the middle of the widest gap."""
    order = np.argsort(-scores, kind="stable")
    s, y = scores[order], labels[order]
    hits, taken = np.cumsum(y), np.arange(1, len(y) + 1)
    following = np.append(s[1:], s[-1] - 1.0)
    f1 = np.where(s > following, 2 * hits / (taken + y.sum()), -1.0)
    gap = np.where(f1 >= f1.max() - 1e-12, s - following, -1.0)
    best = int(np.argmax(gap))
    return float((s[best] + following[best]) / 2)


def _logit(p: float) -> float:
    return float(np.log(p / (1 - p))) if 0 < p < 1 else 60.0 if p >= 1 else -60.0


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the toxicity of every whole text, from 0 to 1. Null and empty texts count as no words;
    a word of more than ``LONGEST`` bytes counts by its beginnings only.

    A column of that name is replaced, all others stay; repeated rows get equal scores; nothing is
    shuffled. The model has at most ``FEATURES`` weights and is sent to the executors once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scorer = per_value(lambda: shared.value.scorer(), "double", pa.float64())
    return docs.withColumn(score_col, scorer(F.coalesce(F.col(text_col), F.lit(""))))


def keep_civil(docs: DataFrame, labels: DataFrame, learnable: Column, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with a score below the threshold, with all their columns."""
    model = fit(docs, labels, learnable)
    return score(docs, model, score_col="_toxicity").filter(F.col("_toxicity") < threshold).select(*docs.columns)
