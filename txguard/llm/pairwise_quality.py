"""Text quality by pairwise ranking.

A Bradley-Terry model: of a good and a bad text, the good one is preferred with the logistic
function of the difference of their scores. Scores are linear in features of a text's shape, so the
loss is logistic regression on feature differences of preference pairs: all pairs of a good and a bad
text among the labelled ones. The pairs are not formed, as their sums follow from counts of scores.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard.llm.documents import per_value, utf8
from txguard.llm.labelled import known_labels
from txguard.session import materialise

BINS = 8  # quantile bins of a feature, each with a weight of its own
STEPS = 20  # Newton's steps at most; each is three or four passes over the stored features
SMALL = 1e-7  # a step that is expected to gain less is the last
DECAY = 1e-4
THRESHOLD = 0.3
GRID = 1 << 14  # points of the grid of scores at most, which are 1/64 apart if they suffice
CELLS = 128  # cells of scores for the second derivatives
UNIT = 1 << 30  # fractions are added up in this part of one

# Groups of bytes whose share of a text is a feature.
BYTE_GROUPS = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "line": b"\n",
    "stop": b".",
    "comma": b",",
    "call": b"!?",
    "bar": b"|",
    "mark": b"#$%&*@^~+=_\\",
    "bracket": b"<>{}[]()/",
    "quote": b"\"'`:;-",
    "high": bytes(range(128, 256)),
}
_GROUPS = np.stack([np.isin(np.arange(256), list(group)) for group in BYTE_GROUPS.values()]).astype(float)
FEATURES = [*BYTE_GROUPS, "words", "word_length", "long_words", "distinct", "repeats", "top_word", "line_words", "distinct_lines", "sentence_lines", "end_marks"]
_SENTENCE_ENDS = (b".", b"!", b"?", b":")


def features(text: bytes) -> list[float]:
    """Numbers of a text's shape, over the whole text; all are 0 for an empty one."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    shares = _GROUPS @ counts / len(text)
    lines = [line for line in text.split(b"\n") if line.strip()]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    often = Counter(words)
    n = len(words)
    last = np.frombuffer(b"".join(word[-1:] for word in words), np.uint8)
    return [
        *shares.tolist(),
        float(np.log1p(n)),
        float(lengths.mean()),
        float((lengths > 24).mean()),
        len(often) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        max(often.values()) / n,
        float(np.log1p(n / len(lines))),
        len(set(lines)) / len(lines),
        sum(line.rstrip().endswith(_SENTENCE_ENDS) for line in lines) / len(lines),
        float(np.isin(last, _MARKS).mean()),
    ]


_MARKS = np.frombuffer(BYTE_GROUPS["mark"] + BYTE_GROUPS["call"] + BYTE_GROUPS["bar"], np.uint8)


@dataclass
class Model:
    edges: np.ndarray  # one row of inner bin limits for each feature
    weights: np.ndarray  # one row of bin weights for each feature
    shift: float  # added to the sum, so that the threshold stands at its quantile

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return sum(w[np.searchsorted(e, column, side="right")] for e, w, column in zip(self.edges, self.weights, rows.T, strict=True))

    def places(self, rows: np.ndarray) -> np.ndarray:
        """Per row, the places of its bins among all weights."""
        found = [np.searchsorted(e, column, side="right") for e, column in zip(self.edges, rows.T, strict=True)]
        return np.stack(found, axis=1) + np.arange(len(found)) * BINS

    def scorer(self) -> Callable[[bytes], float]:
        def score(text: bytes) -> float:
            total = float(self.raw(np.array([features(text)]))[0]) + self.shift
            return float(1 / (1 + np.exp(-np.clip(total, -60, 60))))

        return score


# Sums one array of whole numbers over all blocks of rows: features and labels of a block. Whole numbers
# add up to the same however the rows are dealt out.
Blocks = Iterator[tuple[np.ndarray, np.ndarray]]
Total = Callable[[Callable[[Blocks], np.ndarray]], np.ndarray]


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from all labelled documents: their features are stored once, and every pass over them sums in the tasks.

    Labels other than 0 and 1, null labels and null ids are left out. Of several labels for one id
    the largest counts; of several texts with one id the least. Without labels of both kinds there
    are no pairs: every text then gets the share of label 1, or 0 without any label.
    """
    return _train(_summed(shapes(docs, labels, learnable, id_col, text_col)), len(FEATURES))


def shapes(docs: DataFrame, labels: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``label`` and features ``x`` of every labelled document. Only ids, labels and features are shuffled, and the
    texts of ids that occur more than once."""
    shape = per_value(lambda: features, "array<double>", pa.list_(pa.float64()))
    texts = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_labelled"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    shaped = materialise(texts.select("_labelled", shape(utf8("text")).alias("x")), "shapes")
    again = texts.groupBy("_labelled").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_labelled")
    again = materialise(again, "repeated")
    least = texts.join(again, "_labelled", "left_semi").groupBy("_labelled").agg(F.min("text").alias("text"))
    single = shaped.join(again, "_labelled", "left_anti").unionByName(least.select("_labelled", shape(utf8("text")).alias("x")))
    known = known_labels(labels, "quality", learnable, id_col)
    return materialise(single.join(known, "_labelled").select("label", "x"), "labelled-shapes")


def _summed(rows: DataFrame) -> Total:
    def total(function: Callable[[Blocks], np.ndarray]) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks = (
                (batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1), batch.column("label").to_numpy())
                for batch in batches
                if batch.num_rows
            )
            yield pa.RecordBatch.from_arrays([pa.array([function(blocks).astype(np.int64).tobytes()], pa.binary())], ["sums"])

        own = rows.mapInArrow(run, "sums binary").rdd.map(lambda row: np.frombuffer(row.sums, np.int64))
        return own.treeReduce(np.add)

    return total


def train(x: np.ndarray, y: np.ndarray) -> Model:
    """The model of rows at hand (see :func:`_train`)."""
    return _train(lambda function: function(iter([(x, y)])), x.shape[1])


def _train(total: Total, width: int) -> Model:
    """Weights from all preference pairs, and the shift that puts the threshold at a quantile.

    The quantile is the share of bad texts: as many texts fall below the threshold. The mean loss of
    all pairs of a good and a bad text, with ``DECAY``, is made least by Newton's steps.
    """
    many_bad, many_good = (int(n) for n in total(_label_counts))
    if not many_good or not many_bad:
        share = 1.0 if many_good else 0.0
        return Model(np.zeros((width, BINS - 1)), np.zeros((width, BINS)), 60.0 if share == 1 else -60.0)
    edges = _edges(total, width, many_bad, many_good)
    w = np.zeros((width, BINS))
    at = _Pairs(total, edges, w)
    for _ in range(STEPS):
        slope, bend = at.derivatives()
        step = np.linalg.solve(bend, slope)
        if slope @ step < SMALL:
            break
        for half in range(20):
            ahead = _Pairs(total, edges, w - (step / 2**half).reshape(w.shape))
            if ahead.loss <= at.loss:
                break
        else:
            break
        w, at = ahead.weights, ahead
    model = Model(edges, w, 0.0)
    place = many_bad / (many_bad + many_good) * (many_bad + many_good - 1)
    lower, upper = int(np.floor(place)), int(np.ceil(place))
    found = _ordered(total, lambda x, y: [model.raw(x)], [[lower, upper]])[0]
    model.shift = float(np.log(THRESHOLD / (1 - THRESHOLD))) - (found[lower] + found[upper]) / 2
    return model


def _label_counts(blocks: Blocks) -> np.ndarray:
    return sum((np.bincount(y, minlength=2) for _, y in blocks), np.zeros(2, np.int64))


def _edges(total: Total, width: int, many_bad: int, many_good: int) -> np.ndarray:
    """Inner bin limits, one row for each feature: from both kinds alike, else the rare kind has no say in them."""
    share = np.linspace(0, 1, BINS // 2 + 1)[1:-1]
    places = [(many_good - 1) * share, (many_bad - 1) * share, (many_good + many_bad - 1) * np.array([0.5])]
    ranks = [sorted({int(f(p)) for p in own for f in (np.floor, np.ceil)}) for own in places for _ in range(width)]
    found = _ordered(total, lambda x, y: [c for side in (x[y == 1], x[y == 0], x) for c in side.T], ranks)
    edges = np.empty((width, BINS - 1))
    for feature in range(width):
        own = []
        for side, wanted in enumerate(places):
            values = found[side * width + feature]
            for place in wanted:
                low, high = values[int(np.floor(place))], values[int(np.ceil(place))]
                own.append(low + (high - low) * (place - np.floor(place)))
        edges[feature] = sorted(own)
    return edges


def _ordered(total: Total, columns: Callable[[np.ndarray, np.ndarray], list[np.ndarray]], ranks: list[list[int]]) -> list[dict[int, float]]:
    """Per column of numbers, those at the given ranks of its order, from 0.

    A number is found byte by byte: each pass counts the next byte of the numbers that begin like it.
    """
    sought = [{rank: (0, rank) for rank in own} for own in ranks]  # bytes so far, rank among what begins so
    for level in range(8):
        down = np.uint64(56 - 8 * level)
        begun = [sorted({start for start, _ in own.values()}) for own in sought]
        starts = [np.array(own, np.uint64) for own in begun]

        def count(blocks: Blocks, down=down, starts=starts, first=level == 0) -> np.ndarray:
            counts = [np.zeros((len(own), 256), np.int64) for own in starts]
            for x, y in blocks:
                for numbers, own, into in zip(columns(x, y), starts, counts, strict=True):
                    left = _sortable(numbers) >> down
                    byte = (left & np.uint64(255)).astype(np.int64)
                    head = np.zeros_like(left) if first else left >> np.uint64(8)
                    for k, start in enumerate(own):
                        into[k] += np.bincount(byte[head == start], minlength=256)
            return np.concatenate([into.ravel() for into in counts])

        counts = total(count)
        offset = 0
        for own, heads in zip(sought, begun, strict=True):
            for rank, (start, left) in own.items():
                k = offset + 256 * heads.index(start)
                upto = np.cumsum(counts[k : k + 256])
                byte = int(np.searchsorted(upto, left, side="right"))
                own[rank] = (start << 8 | byte, left - int(upto[byte - 1] if byte else 0))
            offset += 256 * len(heads)
    return [{rank: _number(start) for rank, (start, _) in own.items()} for own in sought]


_SIGN = np.uint64(1 << 63)


def _sortable(numbers: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the numbers."""
    bits = np.ascontiguousarray(numbers, np.float64).view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def _number(sortable: int) -> float:
    bits = np.array([sortable], np.uint64)
    return float(np.where(bits & _SIGN, bits ^ _SIGN, ~bits).view(np.float64)[0])


class _Pairs:
    """Loss over all pairs of a good and a bad text under ``weights``, and its derivatives.

    A pair's loss depends on the difference of two scores only, so one pass counts the texts of each
    kind at the points of a fine grid of scores, a text between two points in shares at both. What a
    text adds to the derivatives then is a function of its own score.
    """

    def __init__(self, total: Total, edges: np.ndarray, weights: np.ndarray):
        self.total, self.edges, self.weights = total, edges, weights
        low, high = weights.min(axis=1).sum(), weights.max(axis=1).sum()
        self.low, self.step = low, max(1 / 64, (high - low) / GRID)
        points = int((high - low) / self.step) + 3
        self.far = np.arange(1 - points, points) * self.step
        model, step = Model(edges, weights, 0.0), self.step

        def count(blocks: Blocks) -> np.ndarray:
            above, below = np.zeros((2, 2, points), np.int64)
            for x, y in blocks:
                point = (model.raw(x) - low) / step
                lower = np.clip(point.astype(np.int64), 0, points - 2)
                share = np.rint(np.clip(point - lower, 0, 1) * UNIT)
                for kind in (0, 1):
                    own = y == kind
                    above[kind] += np.bincount(lower[own] + 1, share[own], points).astype(np.int64)
                    below[kind] += np.bincount(lower[own], minlength=points)
            return np.concatenate([above.ravel(), below.ravel()])

        # texts by the point below, and shares of them that count at the point above it instead
        above, self.below = total(count).reshape(2, 2, points)
        above = above / UNIT
        self.bad, self.good = self.below + above - np.roll(above, -1, axis=1)
        loss = self._from(self.bad, np.logaddexp(0, -self.far))
        self.loss = float(self.good @ loss / (self.good.sum() * self.bad.sum()) + DECAY / 2 * (weights**2).sum())

    @staticmethod
    def _from(counts: np.ndarray, kernel: np.ndarray) -> np.ndarray:
        """Per point, the sum over all counted ones of the kernel of the difference to them."""
        size = 2 ** int(np.ceil(np.log2(len(counts) + len(kernel))))
        whole = np.fft.irfft(np.fft.rfft(counts, size) * np.fft.rfft(kernel, size), size)
        return whole[len(counts) - 1 : 2 * len(counts) - 1]

    def derivatives(self) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and second derivatives by the weights; the latter take scores by ``CELLS`` cells, which keeps them positive."""
        points, low, step, weights = len(self.good), self.low, self.step, self.weights
        many = np.array([self.bad.sum(), self.good.sum()])
        wrongly = 1 / (1 + np.exp(np.clip(self.far, -700, 700)))
        # share of the other kind that is on the wrong side of a score, for bad texts and for good ones
        wrong = np.stack([self._from(self.good, wrongly[::-1]) / many[1], self._from(self.bad, wrongly) / many[0]])
        cells = min(CELLS, points)
        of_point = np.arange(points) * cells // points
        middle = np.bincount(of_point, np.arange(points) * step) / np.bincount(of_point)
        apart = np.exp(-np.abs(middle[:, None] - middle[None, :]))
        curve = apart / (1 + apart) ** 2
        in_cell = np.stack([np.bincount(of_point, own, cells) for own in self.below])
        bent = np.stack([curve @ in_cell[1] / many[1], curve @ in_cell[0] / many[0]])
        model, (width, bins) = Model(self.edges, weights, 0.0), weights.shape
        size = width * bins

        def add(blocks: Blocks) -> np.ndarray:
            slopes = np.zeros((2, size), np.int64)
            bends = np.zeros((2, size, size), np.int64)
            held = np.zeros((2, cells, size), np.int64)
            for x, y in blocks:
                at = model.places(x)
                point = (model.raw(x) - low) / step
                below = np.clip(point.astype(np.int64), 0, points - 2)
                share, cell = np.clip(point - below, 0, 1), of_point[below]
                for kind in (0, 1):
                    own = y == kind
                    pull = wrong[kind, below[own]] * (1 - share[own]) + wrong[kind, below[own] + 1] * share[own]
                    present = np.zeros((len(pull), size))
                    present[np.arange(len(pull))[:, None], at[own]] = 1
                    slopes[kind] += (np.rint(pull * UNIT) @ present).astype(np.int64)
                    bends[kind] += (present.T @ (np.rint(bent[kind, cell[own]] * UNIT)[:, None] * present)).astype(np.int64)
                    np.add.at(held[kind], (cell[own][:, None], at[own]), 1)
            return np.concatenate([slopes.ravel(), bends.ravel(), held.ravel()])

        slopes, bends, held = np.split(self.total(add), [2 * size, 2 * size + 2 * size**2])
        of_bad, of_good = slopes.reshape(2, size) / UNIT / many[:, None]
        slope = of_bad - of_good + DECAY * weights.ravel()
        own_bend = (bends.reshape(2, size, size) / UNIT / many[:, None, None]).sum(axis=0)
        bad, good = held.reshape(2, cells, size) / many[:, None, None]
        both = good.T @ curve @ bad
        return slope, own_bend - both - both.T + DECAY * np.eye(size)


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the quality of every whole text, from 0 to 1; null counts as empty.

    Empty texts get the score of their features, which are all 0. A column of that name is
    replaced, all others stay; repeated rows get equal scores; nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.withColumn(score_col, per_value(lambda: shared.value.scorer(), "double", pa.float64())(utf8(text_col)))
