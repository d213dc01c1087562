"""Phrase collocations from a weighted de Bruijn graph of words.

Nodes are four words, an edge is five: it leads from its first four words to its last four, and its
weight is how often the five stand in a row. Every word of a text starts one gram, the longest within
its piece, so each place is counted once; the shorter grams at the ends of pieces are corrections. What
shorter phrases occur follows from the flow through the nodes: a phrase of k words is as frequent as
all grams of one word more that begin with it, and the pieces that end with it, together.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txguard.llm.documents import utf8
from txguard.session import cut_lineage

LONGEST = 5
LEAST = 100
TOP = 2000
# Most words, and pairs of words, that a task is told to be frequent; with more, nothing is left out beforehand.
WORDS_TOLD = 500_000
PAIRS_TOLD = 4_000_000
_BITS = 20  # enough for the number of a word told
# Grams that a task hands on at once.
HANDED = 200_000
# Words counted in a task before the counts are handed on.
COUNTED = 500_000
# Places whose pairs of words are counted in a task before the counts are handed on.
PAIRS_COUNTED = 2_000_000

# Lower-cases A-Z, ends a piece at the bytes of [.,;:!?\x0A-\x0D], and parts words at space and tab.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_BYTES = bytes(c + 32 if 65 <= c <= 90 else 10 if c in _ENDS else 32 if c == 9 else c for c in range(256))

GRAM = [f"w{k}" for k in range(1, LONGEST + 1)]


def pieces_of(text: bytes) -> list[list[bytes]]:
    """Words of each piece of a text."""
    # the bytes left that split() parts at are spaces only
    return [words for words in map(bytes.split, text.translate(_BYTES).split(b"\n")) if words]


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), utf8(text_col).alias("text"))


def word_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang``, ``word`` and its occurrences ``f``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def told() -> pa.RecordBatch:
            langs = [lang for lang, own in counts.items() for _ in own]
            words = [word for own in counts.values() for word in own]
            times = [n for own in counts.values() for n in own.values()]
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.binary()), pa.array(times, pa.int64())], ["lang", "word", "f"])

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                own = counts.setdefault(lang.as_py(), Counter())
                for words in pieces_of(text.as_py()):
                    own.update(words)
                if sum(map(len, counts.values())) > COUNTED:
                    yield told()
        yield told()

    counted = _texts(docs, text_col, lang_col).mapInArrow(count, "lang string, word binary, f long")
    return counted.groupBy("lang", F.col("word").cast("string").alias("word")).agg(F.sum("f").alias("f"))


class _Codes(dict):
    def __missing__(self, word: bytes) -> int:
        return 0


class Vocabulary:
    """Numbers for the frequent words, where they are few enough to be told to every task.

    Other words cannot be in a frequent phrase, so they end a gram like the end of a piece. Where the
    frequent words are too many, all words take part, under their own text.
    """

    def __init__(self, words: DataFrame, least: int):
        spark = words.sparkSession
        frequent = words.filter(F.col("f") >= least)
        self.numbered = frequent.count() <= WORDS_TOLD
        # the most frequent words get the smallest numbers, which take least room in files
        found = frequent.collect() if self.numbered else []
        rows = [(lang, word) for _, lang, word in sorted((-row.f, row.lang, row.word) for row in found)]
        self.shared = spark.sparkContext.broadcast(rows)
        self.kind = "int" if self.numbered else "string"

    def codes(self) -> dict[str, dict[bytes, int]]:
        """Numbers by language and word; 0 for words to leave out."""
        codes: dict[str, dict[bytes, int]] = defaultdict(_Codes)
        for number, (lang, word) in enumerate(self.shared.value, start=1):
            codes[lang][word.encode()] = number
        return codes

    def spelled(self, codes: Column) -> Column:
        """Language and words of an array of codes."""
        if not self.numbered:
            part = F.transform(codes, lambda c: F.substring_index(c, ":", 1).cast("int"))
            rest = F.transform(codes, lambda c: F.regexp_replace(c, r"\A\d+:", ""))
            lang = F.substring(rest[0], F.lit(1), part[0])
            return F.struct(lang.alias("lang"), F.transform(rest, lambda r: F.substring(r, part[0] + 1, F.char_length(r))).alias("words"))
        shared = self.shared

        @F.arrow_udf("struct<lang: string, words: array<string>>")
        def spell(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            words = shared.value
            kind = pa.struct([("lang", pa.string()), ("words", pa.list_(pa.string()))])
            for batch in batches:
                found = ([words[c - 1] for c in value.as_py()] for value in batch)
                yield pa.array([{"lang": own[0][0], "words": [word for _, word in own]} for own in found], kind)

        return spell(codes)


def grams(docs: DataFrame, vocabulary: Vocabulary, pairs=None, length: int = LONGEST, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The longest gram of at most ``length`` words from every word of a piece, as columns ``w1`` to ``w{length}``.

    Columns past the end of a gram are null; grams of one word are left out, as the words are counted
    already. A gram also ends before a word that is not in the vocabulary, and within a pair that is
    not in ``pairs``, a broadcast sorted array of pairs as one number.
    """
    names = GRAM[:length]

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = vocabulary.codes()
        known = None if pairs is None else pairs.value
        for batch in batches:
            parts = array("q")
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                code = codes[lang.as_py()].__getitem__
                for words in pieces_of(text.as_py()):
                    parts.extend(map(code, words))
                    parts.append(0)
            found = _runs(np.frombuffer(parts, np.int64), known, length)
            for start in range(0, found.num_rows, HANDED):
                yield found.slice(start, HANDED)

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                before = f"{len(lang.as_py())}:{lang.as_py()}"
                for words in pieces_of(text.as_py()):
                    own = [before + word.decode() for word in words] + [None] * length
                    for k, column in enumerate(columns):
                        column.extend(own[k : k + len(words) - 1])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names)

    schema = ", ".join(f"{name} {vocabulary.kind}" for name in names)
    return _texts(docs, text_col, lang_col).mapInArrow(numbered if vocabulary.numbered else spelled, schema)


def _runs(codes: np.ndarray, pairs: np.ndarray | None, length: int) -> pa.RecordBatch:
    """Grams of codes in a row; a zero ends one."""
    linked = (codes[:-1] > 0) & (codes[1:] > 0)
    if pairs is not None:
        at = np.flatnonzero(linked)
        both = (codes[at] << 32) | codes[at + 1]
        place = np.minimum(np.searchsorted(pairs, both), max(len(pairs) - 1, 0))
        linked[at] = pairs[place] == both if len(pairs) else False
    starts = np.flatnonzero(linked)
    padded = np.concatenate([codes, np.zeros(length, np.int64)])
    going = np.concatenate([linked, np.zeros(length, bool)])
    columns = [pa.array(codes[starts].astype(np.int32))]
    on = np.ones(len(starts), bool)
    for k in range(1, length):
        on = on & going[starts + k - 1]
        columns.append(pa.array(padded[starts + k].astype(np.int32), mask=~on))
    return pa.RecordBatch.from_arrays(columns, GRAM[:length])


def packed_pairs(codes: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Bucket, and counted pairs in it as bytes: sorted, as steps from one to the next, before the counts."""
    at = np.flatnonzero((codes[:-1] > 0) & (codes[1:] > 0))
    first, second = codes[at], codes[at + 1]
    # the second word's last bits come next to the first word, as both make the bucket
    keys = first << _BITS | (second & 15) << (_BITS - 4) | second >> 4
    keys, counts = np.unique(keys, return_counts=True)
    mixed = (keys >> (_BITS - 4)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    buckets = (mixed >> np.uint64(52)).astype(np.int64)
    order = np.argsort(buckets, kind="stable")
    keys, counts, buckets = keys[order], counts[order], buckets[order]
    for part in np.split(np.arange(len(keys)), np.flatnonzero(np.diff(buckets)) + 1):
        if len(part):
            own = np.stack([np.diff(keys[part], prepend=0), counts[part]])
            # equal bytes of the numbers side by side, most of which are zero
            yield int(buckets[part[0]]), zlib.compress(own.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked_pairs(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Pairs as ``w1 << 32 | w2`` and their counts."""
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1)
    steps, counts = np.ascontiguousarray(planes.T).view(np.int64).reshape(2, -1)
    keys = np.cumsum(steps)
    low = keys & (2**_BITS - 1)
    second = (low & (2 ** (_BITS - 4) - 1)) << 4 | low >> (_BITS - 4)
    return keys >> _BITS << 32 | second, counts


def pair_counts(docs: DataFrame, vocabulary: Vocabulary, least: int, text_col: str, lang_col: str) -> DataFrame:
    """``pair``, two numbered words as ``w1 << 32 | w2``, and its occurrences ``f``, at least ``least``.

    Tasks count first and pack their counts for the way; then the counts of one bucket after the other are added up.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = vocabulary.codes()
        parts = array("q")

        def told() -> pa.RecordBatch:
            found = list(packed_pairs(np.array(parts, np.int64)))
            del parts[:]
            columns = [pa.array([bucket for bucket, _ in found], pa.int32()), pa.array([packed for _, packed in found], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["bucket", "packed"])

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                code = codes[lang.as_py()].__getitem__
                for words in pieces_of(text.as_py()):
                    parts.extend(map(code, words))
                    parts.append(0)
                if len(parts) > PAIRS_COUNTED:
                    yield told()
        yield told()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, size, room = None, [], 0, PAIRS_COUNTED

        def added() -> tuple[np.ndarray, np.ndarray]:
            pairs, place = np.unique(np.concatenate([own for own, _ in held]), return_inverse=True)
            sums = np.zeros(len(pairs), np.int64)
            np.add.at(sums, place, np.concatenate([counts for _, counts in held]))
            return pairs, sums

        def told() -> pa.RecordBatch:
            pairs, sums = added()
            often = sums >= least
            return pa.RecordBatch.from_arrays([pa.array(pairs[often]), pa.array(sums[often])], ["pair", "f"])

        for batch in batches:
            for bucket, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if bucket != last and held:
                    yield told()
                    held, size, room = [], 0, PAIRS_COUNTED
                last = bucket
                held.append(unpacked_pairs(packed.as_py()))
                size += len(held[-1][0])
                if size > room:
                    held = [added()]
                    size = len(held[0][0])
                    room = max(PAIRS_COUNTED, 2 * size)
        if held:
            yield told()

    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = _texts(docs, text_col, lang_col).mapInArrow(count, "bucket int, packed binary")
    return packed.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(merge, "pair long, f long")


def frequent_pairs(docs: DataFrame, vocabulary: Vocabulary, least: int, text_col: str, lang_col: str):
    """The pairs of words that are frequent, as a broadcast sorted array; nothing where they are too many to be told."""
    if not vocabulary.numbered:
        return None
    frequent = cut_lineage(pair_counts(docs, vocabulary, least, text_col, lang_col).select("pair"))
    if frequent.count() > PAIRS_TOLD:
        return None
    table = frequent.toArrow().column("pair").to_numpy()
    return docs.sparkSession.sparkContext.broadcast(np.sort(table))


def weighed(found: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Distinct grams and how often they occur, ``f``. Numbers, which fit ``_BITS`` bits, are packed for the way."""
    if not vocabulary.numbered:
        return found.groupBy(*GRAM).agg(F.count(F.lit(1)).alias("f"))

    def packed(names: list[str]) -> Column:
        parts = (F.shiftleft(F.coalesce(F.col(name).cast("long"), F.lit(0)), _BITS * k) for k, name in enumerate(names))
        return reduce(lambda a, b: a + b, parts)

    def part(column: str, k: int) -> Column:
        code = F.shiftright(column, _BITS * k).bitwiseAND(2**_BITS - 1)
        return F.when(code > 0, code.cast("int"))

    counted = found.groupBy(packed(GRAM[:3]).alias("a"), packed(GRAM[3:]).alias("b")).agg(F.count(F.lit(1)).alias("f"))
    return counted.select(*[part("a" if k < 3 else "b", k % 3).alias(name) for k, name in enumerate(GRAM)], "f")


def flows(counted: DataFrame, least: int) -> dict[int, DataFrame]:
    """Frequent grams of 2 to ``LONGEST`` words, from the longest grams and their weights ``f``.

    ``counted`` has an edge for each five words and the shorter grams that pieces end with. The flow
    into a gram's beginnings is summed length by length; a sum is partial in every task first, so a
    gram that very many others begin with is not a burden on one of them.
    """
    found = {}
    level = counted.filter(F.col(GRAM[-1]).isNotNull())
    for k in range(LONGEST, 1, -1):
        if k < LONGEST:
            ends = counted.filter(F.col(GRAM[k - 1]).isNotNull() & F.col(GRAM[k]).isNull())
            level = level.select(*GRAM[:k], "f").union(ends.select(*GRAM[:k], "f")).groupBy(*GRAM[:k]).agg(F.sum("f").alias("f"))
            level = cut_lineage(level)
        found[k] = cut_lineage(level.filter(F.col("f") >= least).select(*GRAM[:k], "f"))
    return found


def compacted(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges along nodes that they alone enter and leave, joined into paths: ``codes`` and their weight ``f``.

    A node that one edge brings its whole flow and one takes its whole flow has no other edges and no
    piece begins or ends there, so all edges of a path weigh the same. Every edge learns the first
    edge of its path by doubling its step, so the rounds grow with the logarithm of the longest path.
    A piece ends, so no path returns to its beginning.
    """
    own, node = GRAM, GRAM[:-1]
    flow = nodes.withColumnRenamed("f", "through")
    edges = cut_lineage(edges).withColumn("edge", F.monotonically_increasing_id())
    into = edges.select("edge", *[F.col(own[k + 1]).alias(node[k]) for k in range(LONGEST - 1)], "f")
    entering = into.join(flow, node).filter("f = through").select(*node, F.col("edge").alias("previous"))
    leaving = edges.select("edge", *node, "f").join(flow, node).filter("f = through").select(*node, "edge")
    steps = leaving.join(entering, node).select("edge", F.col("previous").alias("first"), F.lit(1).alias("steps"))
    steps = cut_lineage(edges.select("edge").join(steps, "edge", "left").select("edge", F.coalesce("first", "edge").alias("first"), F.coalesce("steps", F.lit(0)).alias("steps")))
    while True:
        ahead = steps.filter("steps > 0").select(F.col("edge").alias("first"), F.col("first").alias("further"), F.col("steps").alias("more"))
        moved = steps.join(ahead, "first", "left")
        if moved.filter("further IS NOT NULL").isEmpty():
            break
        steps = cut_lineage(
            moved.select("edge", F.coalesce("further", "first").alias("first"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"))
        )
    told = edges.join(steps, "edge")
    head = F.array(*own)
    ordered = F.array_sort(F.collect_list(F.struct("steps", F.col(own[-1]).alias("last"))))
    paths = told.groupBy("first").agg(ordered.alias("rest"), F.max(F.when(F.col("steps") == 0, F.struct(head.alias("codes"), F.col("f")))).alias("head"))
    rest = F.transform(F.slice("rest", F.lit(2), F.size("rest")), lambda x: x["last"])
    return paths.select(F.concat("head.codes", rest).alias("codes"), F.col("head.f").alias("f"))


def phrases(
    docs: DataFrame, words: DataFrame, least: int = LEAST, text_col: str = "text", lang_col: str = "lang"
) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases and the compacted paths of the graph; ``words`` are the :func:`word_counts`.

    The first has ``lang``, ``phrase`` (joined by spaces), ``k`` (its words), its occurrences ``f``,
    and ``inner``, true for the phrases that paths pass through on the way; the second
    ``lang``, ``words`` and ``f``.
    """
    vocabulary = Vocabulary(words, least)
    pairs = frequent_pairs(docs, vocabulary, least, text_col, lang_col)
    counted = weighed(grams(docs, vocabulary, pairs, LONGEST, text_col, lang_col), vocabulary)
    found = flows(cut_lineage(counted), least)
    paths = cut_lineage(compacted(found[LONGEST], found[LONGEST - 1]))

    def windows(k: int, first: int, past: Column) -> DataFrame:
        """Every ``k`` words of the paths from place ``first``, to ``past`` places before the end."""
        places = F.sequence(F.lit(first), past)
        taken = paths.filter(past >= first).select("codes", "f", F.explode(places).alias("place"))
        return taken.select(F.slice("codes", F.col("place"), F.lit(k)).alias("codes"), "f")

    # five words come from the paths, and so do the four words of nodes inside them
    inside = windows(LONGEST - 1, 2, F.size("codes") - LONGEST + 1).withColumn("inner", F.lit(True))
    edges = windows(LONGEST, 1, F.size("codes") - LONGEST + 1).withColumn("inner", F.lit(False))
    shorter = [found[k].select(F.array(*GRAM[:k]).alias("codes"), "f", F.lit(False).alias("inner")) for k in range(2, LONGEST - 1)]
    nodes = found[LONGEST - 1].select(F.array(*GRAM[: LONGEST - 1]).alias("codes"), "f", F.lit(False).alias("inner"))
    ends = nodes.join(inside.select("codes"), "codes", "left_anti")
    table = edges.unionByName(inside).unionByName(ends)
    for part in shorter:
        table = table.unionByName(part)
    spelled = table.select(vocabulary.spelled(F.col("codes")).alias("s"), "f", "inner").select(
        "s.lang", F.array_join("s.words", " ").alias("phrase"), F.size("s.words").alias("k"), "f", "inner"
    )
    single = words.filter(F.col("f") >= least).select("lang", F.col("word").alias("phrase"), F.lit(1).alias("k"), "f", F.lit(False).alias("inner"))
    told = paths.select(vocabulary.spelled(F.col("codes")).alias("s"), "f").select("s.lang", "s.words", "f")
    return cut_lineage(spelled.unionByName(single)), told


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The best phrases of two to five words of every language, by how much more often they stand together than apart.

    Returns ``lang`` (``und`` where null), ``rank``, ``phrase``, ``a`` (its occurrences), ``l`` and
    ``r`` (those of its two parts at the cut with the lowest score, the earliest of equal ones), ``n``
    (words of the language) and ``score``, ``floor(1000 * a * n / (l * r))``. Only phrases with ``least``
    occurrences count, and none that always stands within one longer such phrase.

    Null and empty texts have no words. Words are lower-cased in A-Z only; everything but space, tab
    and the ends of pieces belongs to a word. Repeated rows count each. An empty table gives no rows.
    """
    counts = cut_lineage(word_counts(docs, text_col, lang_col))
    found, _ = phrases(docs, counts, least, text_col, lang_col)
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    words = F.split("phrase", " ")

    def part(first: Column | int, length: Column) -> Column:
        return F.array_join(F.slice(words, F.lit(first) if isinstance(first, int) else first, length), " ")

    # a phrase within a longer one that is as frequent is so within one that is a word longer
    longer = found.filter("k > 2")
    around = longer.select("lang", F.explode(F.array(part(1, F.col("k") - 1), part(2, F.col("k") - 1))).alias("phrase"), "f")
    around = around.groupBy("lang", "phrase").agg(F.max("f").alias("longest"))
    # what a path passes through stands within its edges
    open_ = found.filter("k > 1 AND NOT inner").join(around, ["lang", "phrase"], "left").filter("longest IS NULL OR longest < f")
    cut = open_.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"), "k")
    cut = cut.select("lang", "phrase", "a", "cut", part(1, F.col("cut")).alias("_left"), part(F.col("cut") + 1, F.col("k")).alias("_right"))
    sizes = found.select("lang", "phrase", "f")
    cut = cut.join(sizes.select("lang", F.col("phrase").alias("_left"), F.col("f").alias("l")), ["lang", "_left"])
    cut = cut.join(sizes.select("lang", F.col("phrase").alias("_right"), F.col("f").alias("r")), ["lang", "_right"])
    cut = cut.join(totals, "lang")

    # products of up to 38 digits; the quotient is at most 1000 * n / a
    product = "1000 * cast(a as decimal(17, 0)) * cast(n as decimal(17, 0))"
    score = F.expr(f"({product}) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))")
    scored = cut.withColumn("score", score)
    least_cut = F.min(F.struct("score", "cut", "l", "r")).alias("at")
    best = scored.groupBy("lang", "phrase", "a", "n").agg(least_cut)
    best = best.select("lang", "phrase", "a", "n", F.col("at.score").alias("score"), F.col("at.l").alias("l"), F.col("at.r").alias("r"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
