"""Benchmark passages in documents, found by Wu-Manber multi-pattern search over words.

All windows of one length are searched together. A shift table tells for a block of two words how
far the search may jump; a block that ends a window leads to the hashed bucket of windows with that
suffix, and a direct comparison confirms an occurrence. Words are numbered first, so a window is a
few numbers, compared and hashed as their bytes.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txguard.llm.documents import per_value, utf8
from txguard.session import cut_lineage, materialise

WINDOW_WORDS = 10
BLOCK = 2
# Benchmark text that is searched for in one pass, unless one item has more; a larger benchmark takes several
# passes, one after the other. A worker holds about 40 bytes for each byte of it.
PASS_BYTES = 2_000_000

# Lower-cases A-Z and turns every byte that is not of a word into a space. Bytes from 0x80 belong to
# characters above ASCII, which are all word characters.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return text.translate(WORD_BYTES).split()


class _Numbers(dict):
    """Numbers of words from 1; 0 for words that no window has."""

    def __missing__(self, word: bytes) -> int:
        return 0


class Searcher:
    """Windows of one length, as bytes of word numbers, with their shift table; a window's value names its items."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(BLOCK, length)
        self.default = length - self.block + 1
        self.shift: dict[int, int] = {}
        # hashed by the whole window, which its suffix is part of: a bucket has one window, however many share a suffix
        self.windows: dict[bytes, int | tuple[int, ...]] = {}

    def add(self, numbers: array, item: int) -> None:
        """All windows of an item, which has at least ``length`` words."""
        raw, size, length, block = numbers.tobytes(), numbers.itemsize, self.length, self.block
        last = len(numbers) - length
        for start in range(last + 1):
            window = raw[size * start : size * (start + length)]
            known = self.windows.get(window)
            if known is None:
                self.windows[window] = item
            elif isinstance(known, int):
                if known != item:
                    self.windows[window] = (known, item)
            elif item not in known:
                self.windows[window] = (*known, item)
        # every block of a window lets the search go on to the window's end; a block that ends a window stops it
        for end in range(block, len(numbers) + 1):
            key = self._key(numbers, end)
            self.shift[key] = min(self.shift.get(key, self.default), max(0, length - end))

    def _key(self, numbers: array, end: int) -> int:
        return numbers[end - 1] if self.block == 1 else numbers[end - 2] << 32 | numbers[end - 1]

    def search(self, numbers: array) -> Iterator[tuple[int, int | tuple[int, ...]]]:
        """Start and items of every occurrence, by start."""
        length, default, shift, windows, single = self.length, self.default, self.shift, self.windows, self.block == 1
        raw, width = numbers.tobytes(), numbers.itemsize
        end, size = length, len(numbers)
        while end <= size:
            jump = shift.get(numbers[end - 1] if single else numbers[end - 2] << 32 | numbers[end - 1], default)
            if jump:
                end += jump
                continue
            items = windows.get(raw[width * (end - length) : width * end])
            if items is not None:
                yield end - length, items
            end += 1


class Tables:
    """What one pass searches for: word numbers, and a searcher for each window length among its items."""

    def __init__(self, items: Iterable[tuple[int | None, bytes]]):
        self.numbers = _Numbers()
        self.ids: list[int | None] = []
        by_length: dict[int, Searcher] = {}
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            length = min(WINDOW_WORDS, len(words))
            coded = array("I", (self.numbers.setdefault(word, len(self.numbers) + 1) for word in words))
            by_length.setdefault(length, Searcher(length)).add(coded, len(self.ids))
            self.ids.append(item)
        self.searchers = [by_length[length] for length in sorted(by_length)]


def scan(text: bytes, tables: Tables) -> dict:
    """Word count, merged spans of hit words as flat start and end numbers, and items found."""
    numbers = array("I", map(tables.numbers.__getitem__, words_of(text)))
    spans: list[tuple[int, int]] = []
    found: set = set()
    for table in tables.searchers:
        for start, items in table.search(numbers):
            spans.append((start, start + table.length))
            found.update((items,) if isinstance(items, int) else items)
    return {
        "n_words": len(numbers),
        "spans": [{"first": a, "past": b} for a, b in merged(spans)],
        "items": sorted({tables.ids[k] for k in found} - {None}),
    }


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, past in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(past, out[-1][1]))
        else:
            out.append((start, past))
    return out


SCAN_TYPE = "n_words long, spans array<struct<first: int, past: int>>, items array<long>"
SCAN_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))),
        ("items", pa.list_(pa.int64())),
    ]
)


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    found_col: str = "found",
) -> DataFrame:
    """``docs`` with ``found_col``: word count, spans of hit words (``past`` exclusive), ids of items found.

    A window is ten consecutive words of an item; an item of fewer words, but not none, is one
    window. A null or empty text has no words and no hits; null and empty items have no windows.
    Items without an id are searched for and their words hit, but no id is listed. Repeated items
    count once, repeated documents each get their row. An empty benchmark finds nothing. A column
    already called ``found_col`` is replaced; all other columns stay.

    The benchmark is read in passes of about ``PASS_BYTES``; the driver and every worker hold the
    tables of one pass at a time. With one pass documents are not shuffled. With more, the rows are
    numbered and written once, and what a pass finds is written before the next begins; only rows
    with hits are joined back.
    """
    items = _passes(benchmark.select(F.col(item_col).alias("_item"), utf8(item_text_col).alias("_text")))
    last = items.agg(F.max("_pass")).first()[0] or 0
    if not last:
        return docs.withColumn(found_col, _scanned(docs, items)[0](utf8(text_col)))
    kept = [column for column in docs.columns if column != found_col]
    own = docs.select(*kept, utf8(text_col).alias("_searched"))
    rows = materialise(own.withColumn("_row", F.monotonically_increasing_id()), "searched")
    hits = None
    for number in range(last + 1):
        column, tables = _scanned(docs, items.filter(F.col("_pass") == number))
        found = rows.select("_row", column("_searched").alias("f")).filter("size(f.spans) > 0").select("_row", "f.spans", "f.items")
        part = materialise(found, "passages")
        tables.unpersist()
        hits = part if hits is None else hits.union(part)
    nothing = Tables([])
    counted = per_value(lambda: lambda text: scan(text, nothing)["n_words"], "long", pa.int64())
    span = "array<struct<first: int, past: int>>"
    together = hits.groupBy("_row").agg(
        join_spans(F.flatten(F.collect_list("spans"))).alias("_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("_items"),
    )
    joined = rows.withColumn("_words", counted("_searched")).join(together, "_row", "left")
    found = F.struct(
        F.col("_words").alias("n_words"),
        F.coalesce("_spans", F.array().cast(span)).alias("spans"),
        F.coalesce("_items", F.array().cast("array<long>")).alias("items"),
    )
    return joined.select(*kept, found.alias(found_col))


def _passes(items: DataFrame) -> DataFrame:
    """The items with text, each with the number of its pass: their bytes summed up in order of a hash, in units of a pass.

    The order is that of hash buckets of about a tenth of a pass, so no task sorts the whole benchmark.
    """
    sized = items.filter(F.octet_length("_text") > 0).distinct()
    total = sized.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    buckets = max(1, -(-10 * total // PASS_BYTES))
    if total <= PASS_BYTES:
        return sized.withColumn("_pass", F.lit(0))
    dealt = cut_lineage(sized.withColumn("_bucket", F.pmod(F.xxhash64("_item", "_text"), F.lit(buckets))))
    sums = dealt.groupBy("_bucket").agg(F.sum(F.octet_length("_text")).alias("_bytes"))
    # a row for each tenth of a pass
    through = F.sum("_bytes").over(Window.orderBy("_bucket")) - F.col("_bytes")
    numbers = sums.select("_bucket", F.floor(through / PASS_BYTES).cast("int").alias("_pass"))
    return dealt.join(numbers, "_bucket").drop("_bucket")


def _scanned(docs: DataFrame, items: DataFrame) -> tuple:
    """The column function of one pass, and its broadcast tables."""
    tables = Tables((row[0], bytes(row[1])) for row in items.select("_item", "_text").toLocalIterator())
    shared: Broadcast = docs.sparkSession.sparkContext.broadcast(tables)

    def make():
        return lambda text, own=shared.value: scan(text, own)

    return per_value(make, f"struct<{SCAN_TYPE}>", SCAN_ARROW), shared


def join_spans(spans):
    """Overlapping or touching spans of an array of structs made one."""
    span = "struct<first: int, past: int>"
    empty = F.array().cast(f"array<{span}>")

    def step(done, x):
        last = F.element_at(done, -1)
        longer = F.struct(last["first"].alias("first"), F.greatest(last["past"], x["past"]).alias("past"))
        touching = (F.size(done) > 0) & (x["first"] <= F.try_element_at(done, F.lit(-1))["past"])
        return F.when(touching, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(
            F.concat(done, F.array(x))
        )

    return F.aggregate(F.array_sort(spans), empty, step)


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents in which no window of the benchmark occurs, with all their columns."""
    found = find_passages(docs, benchmark, text_col, found_col="_found")
    return found.filter(F.size("_found.spans") == 0).select(*docs.columns)
