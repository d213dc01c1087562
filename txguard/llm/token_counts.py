"""Token counts of a byte-level BPE vocabulary without its tokens.

Per pre-token the symbols are a linked list and the adjacent pairs a heap by merge rank. The lowest
pair is merged until none is left; the count is the number of symbols less the number of merges.
"""

from __future__ import annotations

import heapq
import json
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from txguard.llm.documents import per_value
from txguard.llm.pre_tokens import BYTE_LEVEL_PATTERN, Kept, byte_characters, splitter

# Characters of pre-tokens of a worker whose counts are kept (see Kept); twice as many at most.
KEPT_CHARS = 6_000_000


@dataclass
class Merges:
    """What counting needs of a vocabulary file. Symbols are numbers, the first 256 of them the bytes."""

    rank: dict[int, int]  # by left symbol times 2**32 plus right symbol
    made: list[int]  # symbol that the merge of a rank makes
    special: list[str]  # strings that are one token wherever they stand


def read_merges(content: bytes) -> Merges:
    """Merges of a ``tokenizers`` file with byte-level BPE and no normaliser; others are refused."""
    file = json.loads(content)
    split, model = file["pre_tokenizer"] or {}, file["model"]
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    if not plain or file["normalizer"] or model["type"] != "BPE" or model.get("ignore_merges"):
        raise ValueError("not a plain byte-level BPE file")
    symbol = {letter: byte for byte, letter in enumerate(byte_characters())}
    rank: dict[int, int] = {}
    made = []
    for number, merge in enumerate(model["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        made.append(symbol.setdefault(left + right, len(symbol)))
        rank[symbol[left] << 32 | symbol[right]] = number
    return Merges(rank, made, [token["content"] for token in file["added_tokens"]])


def count_symbols(raw: bytes, merges: Merges) -> int:
    """Symbols left after all merges; among pairs of equal rank the leftmost is merged first."""
    size = len(raw)
    if size < 2:
        return size
    rank, made = merges.rank, merges.made
    symbol = list(raw)
    after = list(range(1, size + 1))  # ``size`` ends the list
    before = list(range(-1, size - 1))
    heap = []
    for at in range(size - 1):
        r = rank.get(symbol[at] << 32 | symbol[at + 1])
        if r is not None:
            heap.append(r * size + at)
    heapq.heapify(heap)
    merged = 0
    while heap:
        r, at = divmod(heapq.heappop(heap), size)
        right = after[at]
        # an entry is out of date if its left symbol is gone or either symbol has changed
        if symbol[at] < 0 or right == size or rank.get(symbol[at] << 32 | symbol[right]) != r:
            continue
        merged += 1
        symbol[at] = made[r]
        symbol[right] = -1
        following = after[at] = after[right]
        if following < size:
            before[following] = at
            new = rank.get(symbol[at] << 32 | symbol[following])
            if new is not None:
                heapq.heappush(heap, new * size + at)
        left = before[at]
        if left >= 0:
            new = rank.get(symbol[left] << 32 | symbol[at])
            if new is not None:
                heapq.heappush(heap, new * size + left)
    return size - merged


class Counter:
    """Counts of whole texts; remembers the counts of pre-tokens."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.split = splitter(BYTE_LEVEL_PATTERN)
        ordered = sorted(merges.special, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, ordered))) if ordered else None
        self.kept = Kept(KEPT_CHARS)

    def count(self, text: str) -> int:
        if self.special is None or self.special.search(text) is None:
            return self.plain(text)
        # the library splits off such strings first, and the texts between them one by one
        parts = self.special.split(text)
        return sum(map(self.plain, parts)) + len(parts) - 1

    def plain(self, text: str) -> int:
        parts = self.split(text)
        new = self.kept.missing(parts)
        kept = self.kept.newer
        for part in new:
            kept[part] = count_symbols(part.encode(), self.merges)
        return sum(map(kept.__getitem__, parts))


_counters: dict[int, Counter] = {}


def _counter(key: int, merges: Merges) -> Counter:
    """One counter for each worker process, so that later tasks find its pre-tokens."""
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter(merges)
    return _counters[key]


def token_counter(spark: SparkSession, path: str):
    """Column function: tokens of a whole text by the vocabulary file, without tokens added around it.

    Special strings of the file are one token each where they occur in a text. Null and empty texts
    have none. The file is read here and its merges are sent to the executors once; rows are not
    shuffled, so repeated rows and other columns stay as they are.
    """
    with open(path, "rb") as file:
        content = file.read()
    key = hash(content)
    shared = spark.sparkContext.broadcast(read_merges(content))
    counted = per_value(lambda: _counter(key, shared.value).count, "long", pa.int64())

    def count(text: Column) -> Column:
        return counted(F.coalesce(text, F.lit("")))

    return count
