"""Byte-level BPE: texts to token ids and back.

The vocabulary is written as a sentencepiece BPE model: one piece for each token, its bytes mapped
to printable characters, scored by its negative rank, with no normalisation. sentencepiece then
merges the best-scored adjacent pair first, which is the merge order of the ranks. Decoding maps
ids back to their bytes.
"""

from __future__ import annotations

import base64
import struct
import sys
from array import array

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard.llm.documents import per_value
from txguard.llm.pre_tokens import Kept, byte_characters, splitter

# Characters of pre-tokens of a worker whose ids are kept (see Kept); twice as many at most.
KEPT_CHARS = 4_000_000

def read_ranks(content: bytes) -> list[bytes]:
    """Tokens of a ``.tiktoken`` file by rank. Ranks must be gapless from 0."""
    tokens: dict[int, bytes] = {}
    for line in content.splitlines():
        if line:
            token, rank = line.split()
            tokens[int(rank)] = base64.b64decode(token)
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError("ranks are not gapless from 0")
    return [tokens[rank] for rank in range(len(tokens))]


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece model whose ids are the ranks; the unknown piece, which bytes never need, comes last.

    Field numbers are those of the published ``sentencepiece_model.proto``.
    """
    letters = byte_characters()
    pieces = []
    for rank, token in enumerate(tokens):
        piece = "".join(map(letters.__getitem__, token)).encode()
        score = _varint(2 << 3 | 5) + struct.pack("<f", -float(rank))
        pieces.append(_bytes(1, _bytes(1, piece) + score))
    pieces.append(_bytes(1, _bytes(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _number(3, 2)))
    trainer = _number(3, 2) + _number(4, len(tokens) + 1)  # BPE
    normaliser = _bytes(1, b"identity") + _bytes(2, b"") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _bytes(2, trainer) + _bytes(3, normaliser)


class Encoder:
    """Ids of whole texts; remembers the ids of pre-tokens."""

    def __init__(self, tokens: list[bytes], model: bytes, pattern: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.letters = byte_characters()
        self.whole = {token: rank for rank, token in enumerate(tokens)}
        self.split = splitter(pattern)
        self.kept = Kept(KEPT_CHARS)  # ids as 32-bit numbers end to end

    def learn(self, new: list[str]) -> None:
        """Ids of pre-tokens not seen before. One that is a token by itself needs no merging."""
        mapped = []
        to_merge = []
        for part in new:
            raw = part.encode()
            rank = self.whole.get(raw)
            if rank is None:
                to_merge.append(part)
                mapped.append("".join(map(self.letters.__getitem__, raw)))
            else:
                self.kept.newer[part] = rank.to_bytes(4, sys.byteorder)
        for part, ids in zip(to_merge, self.processor.encode(mapped, num_threads=1), strict=True):
            self.kept.newer[part] = array("i", ids).tobytes()

    def encode(self, text: str) -> np.ndarray:
        parts = self.split(text)
        if new := self.kept.missing(parts):
            self.learn(new)
        return np.frombuffer(b"".join(map(self.kept.newer.__getitem__, parts)), np.int32)


_encoders: dict[tuple[int, str], Encoder] = {}


def _encoder(tokens: list[bytes], model: bytes, pattern: str) -> Encoder:
    """One encoder for each worker process, so that later tasks find its pre-tokens."""
    key = (hash(model), pattern)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(tokens, model, pattern)
    return _encoders[key]


class Codec:
    """Column functions for one vocabulary file, which is read here and sent to the executors."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as file:
            tokens = read_ranks(file.read())
        self.shared = spark.sparkContext.broadcast((tokens, serialise(tokens)))
        self.pattern = pattern

    def encode(self, text: Column) -> Column:
        """Token ids of a text without special tokens; null and empty texts have none."""
        shared, pattern = self.shared, self.pattern

        def make():
            encoder = _encoder(*shared.value, pattern)
            return encoder.encode

        return per_value(make, "array<int>", pa.list_(pa.int32()))(F.coalesce(text, F.lit("")))

    def decode(self, ids: Column) -> Column:
        """Bytes of token ids. Ids outside the vocabulary raise an error; null ids decode to nothing."""
        shared = self.shared

        def make():
            token = shared.value[0].__getitem__
            return lambda value: b"".join(map(token, () if value is None else value.tolist()))

        return per_value(make, "binary", pa.binary())(ids)

    def round_trip(self, text: Column) -> Column:
        """Struct of ``token_ids`` and ``decoded``, the bytes that those ids stand for, by one worker for each task."""
        shared, pattern = self.shared, self.pattern

        def make():
            encoder = _encoder(*shared.value, pattern)
            token = shared.value[0].__getitem__

            def code(value: str) -> dict:
                ids = encoder.encode(value)
                return {"token_ids": ids, "decoded": b"".join(map(token, ids.tolist()))}

            return code

        kind = pa.struct([("token_ids", pa.list_(pa.int32())), ("decoded", pa.binary())])
        return per_value(make, "struct<token_ids: array<int>, decoded: binary>", kind)(F.coalesce(text, F.lit("")))


def encode(docs: DataFrame, codec: Codec, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of every whole text. A column of that name is replaced, all others stay.

    Rows keep their place: nothing is shuffled, and repeated rows get equal ids.
    """
    return docs.withColumn(ids_col, codec.encode(F.col(text_col)))


def decode(docs: DataFrame, codec: Codec, ids_col: str = "token_ids", bytes_col: str = "decoded") -> DataFrame:
    """``docs`` with the bytes that the ids stand for."""
    return docs.withColumn(bytes_col, codec.decode(F.col(ids_col)))


def encode_and_decode(docs: DataFrame, codec: Codec, text_col: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` and the bytes ``decoded`` from them; columns of these names are replaced."""
    coded = docs.withColumn("_coded", codec.round_trip(F.col(text_col)))
    return coded.withColumns({"token_ids": F.col("_coded.token_ids"), "decoded": F.col("_coded.decoded")}).drop("_coded")
