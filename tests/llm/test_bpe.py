from hashlib import sha256

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from txguard.llm import bpe_codec, token_counts
from txguard.llm.documents import table
from txguard.llm.pre_tokens import Kept
from txguard.llm.queries import registry

ODD = ["", "  ", " \n a\x1c\x1d b\x85\xa0c", "日本語 一二三 ⅷ ²", "it's I'LL we've", "a" * 3000, "_a_ __", "\x00\x01", "😀 👩‍👩‍👧", " ª º ǅ ʰ", "é ño  ​x", "a <|endoftext|> b<|endoftext|>"]
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as file:
        tokens = bpe_codec.read_ranks(file.read())
    ranks = {token: rank for rank, token in enumerate(tokens)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def coded(spark, frame):
    codec = bpe_codec.Codec(spark, RANKS, public_tokenizers.PATTERN)
    return bpe_codec.decode(bpe_codec.encode(frame, codec), codec)


def test_odd_texts(spark, reference):
    frame = spark.createDataFrame([(text,) for text in [*ODD, None]], "text string")
    for row in coded(spark, frame).collect():
        assert row.token_ids == reference.encode_ordinary(row.text or "")
        assert bytes(row.decoded).decode() == (row.text or "")


def test_codec_query(spark, medium, reference):
    texts = {r.doc_id: r.text for r in table(spark, medium, "documents").collect()}
    for row in registry()["op2_bpe_codec"](spark, medium).collect():
        ids = reference.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == sha256(texts[row.doc_id].encode()).hexdigest()


def test_counts_query(spark, medium):
    library = Tokenizer.from_file(FILE)
    texts = {r.doc_id: r.text for r in table(spark, medium, "documents").collect()}
    rows = registry()["op7_heap_token_counts"](spark, medium).collect()
    wanted = library.encode_batch([texts[row.doc_id] for row in rows], add_special_tokens=False)
    for row, encoding in zip(rows, wanted, strict=True):
        assert (row.n_tokens, row.n_bytes) == (len(encoding.ids), len(texts[row.doc_id].encode()))
        assert row.over_limit == (row.n_tokens > 512)


def test_odd_counts(spark):
    library = Tokenizer.from_file(FILE)
    count = token_counts.token_counter(spark, FILE)
    frame = spark.createDataFrame([(text,) for text in [*ODD, None]], "text string")
    for row in frame.select("text", count(F.col("text")).alias("n")).collect():
        assert row.n == len(library.encode(row.text or "", add_special_tokens=False).ids)


def test_awkward_rows(spark, awkward, nothing):
    rows = coded(spark, awkward).collect()
    assert len(rows) == awkward.count()
    assert all(bytes(row.decoded).decode() == (row.text or "") for row in rows)
    assert coded(spark, nothing).count() == 0
    count = token_counts.token_counter(spark, FILE)
    assert awkward.select(count(F.col("text"))).count() == len(rows)
    assert nothing.select(count(F.col("text"))).count() == 0


def test_other_files_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file, pytest.raises(ValueError):
        token_counts.read_merges(file.read())
    with pytest.raises(ValueError):
        bpe_codec.read_ranks(b"YQ== 0\nYg== 2\n")


def test_frequent_pre_tokens_are_kept():
    kept = Kept(3 * (Kept.OVERHEAD + 1))  # three letters
    for part in "abcdefgh":
        for new in kept.missing(["often", part]):
            kept.newer[new] = new
        assert kept.missing(["often"]) == []
        assert len(kept.newer) + len(kept.older) <= 2 * 3 + 3


def test_long_unbroken_texts_make_room():
    kept = Kept(10_000)
    for k in range(500):
        for part in kept.missing([f"{k}" + "x" * 5000, "often"]):
            kept.newer[part] = k
        assert sum(map(len, kept.newer)) + sum(map(len, kept.older)) <= 2 * (10_000 + 5_100)
    assert kept.newer["often"] == 0
