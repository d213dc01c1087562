import random
import re
from collections import Counter

import numpy as np
import pytest

from txguard.llm import collocations as c


def grams_of(rows):
    found, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(x.lower() if x.isascii() else x for x in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    found.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    return found, totals


def brute(rows, least, top):
    out = []
    found, totals = grams_of(rows)
    for lang, counts in found.items():
        n = totals[lang]
        kept = {g: f for g, f in counts.items() if len(g) > 1 and f >= least}
        best = []
        for g, a in kept.items():
            if any(len(h) > len(g) and f >= a and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1)) for h, f in kept.items()):
                continue
            score, _, l, r = min((1000 * a * n // (counts[g[:k]] * counts[g[k:]]), k, counts[g[:k]], counts[g[k:]]) for k in range(1, len(g)))
            best.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[:top], start=1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def made(draw):
    words = ["a", "b", "c", "dé", "日本", "The", "x-y", "1\x1c"]
    passage = " ".join(draw.choice(words) + str(k) for k in range(40))
    rows = []
    for k in range(120):
        text = "".join(draw.choice(words) + draw.choice([" ", " ", "  ", "\t", " ", ". ", ",", "\n"]) for _ in range(draw.randrange(60)))
        rows.append((draw.choice(["en", "en", "de", None]), text + draw.choice(["", "", passage, passage.upper(), passage[30:] + " tail " + passage])))
    return rows + [("en", None), (None, ""), ("fr", " \t\n"), ("en", "of of of of of of of of of of of of"), rows[0], rows[0]]


@pytest.mark.parametrize(("least", "words", "pairs"), [(3, 10**6, 10**6), (9, 10**6, 0), (4, 0, 0), (1, 10**6, 10**6)])
def test_against_brute_force(spark, monkeypatch, least, words, pairs):
    monkeypatch.setattr(c, "WORDS_TOLD", words)
    monkeypatch.setattr(c, "PAIRS_TOLD", pairs)
    monkeypatch.setattr(c, "COUNTED", 10)
    monkeypatch.setattr(c, "HANDED", 7)
    rows = made(random.Random(least))
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    found = c.collocations(frame, least, 25)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(row) for row in found.collect()) == brute(rows, least, 25)


def test_all_frequent_phrases_and_paths(spark):
    rows = made(random.Random(8))
    frame = spark.createDataFrame(rows, "lang string, text string")
    found, paths = c.phrases(frame, c.word_counts(frame), 4)
    counts, _ = grams_of(rows)
    want = {(lang, " ".join(g), f) for lang, own in counts.items() for g, f in own.items() if f >= 4}
    got = [(row.lang, row.phrase, row.f) for row in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    # every frequent edge is on one path, and a passage of forty words that always stands whole is one path
    edges = Counter()
    for row in paths.collect():
        for i in range(len(row.words) - 4):
            edges[(row.lang, " ".join(row.words[i : i + 5]), row.f)] += 1
    assert set(edges) == {x for x in want if x[1].count(" ") == 4} and set(edges.values()) == {1}
    assert max(len(row.words) for row in paths.collect()) > 10


def test_long_repeated_passage_is_one_path(spark):
    text = " ".join(f"w{k}" for k in range(3000))
    frame = spark.createDataFrame([("en", text)] * 4, "lang string, text string")
    _, paths = c.phrases(frame, c.word_counts(frame), 4)
    (row,) = paths.collect()
    assert " ".join(row.words) == text and row.f == 4


def test_awkward_rows_and_empty_tables(spark, awkward, nothing):
    rows = [(row.lang, row.text) for row in awkward.select("lang", "text").collect()]
    assert sorted(tuple(row) for row in c.collocations(awkward, 30).collect()) == brute(rows, 30, 2000)
    assert c.collocations(nothing).collect() == []


def test_products_beyond_64_bits(spark):
    row = spark.range(1).selectExpr(
        "(1000 * cast(90000000000001 as decimal(17, 0)) * cast(99999999999999 as decimal(17, 0)))"
        " div (cast(90000000000007 as decimal(18, 0)) * cast(90000000000009 as decimal(18, 0))) AS s"
    ).first()
    assert row.s == 1000 * 90000000000001 * 99999999999999 // (90000000000007 * 90000000000009)


def test_packed_pairs_hold_their_counts():
    codes = np.random.default_rng(2).integers(0, 40, 5000) * 13_007
    expected = Counter((int(a) << 32 | int(b)) for a, b in zip(codes, codes[1:], strict=False) if a and b)
    found = Counter()
    for _, packed in c.packed_pairs(codes):
        pairs, counts = c.unpacked_pairs(packed)
        found.update(dict(zip(pairs.tolist(), counts.tolist(), strict=True)))
    assert found == expected
