from collections import defaultdict

import numpy as np
import pytest

from txguard.llm import near_dup
from txguard.llm.components import connected
from txguard.llm.near_dup import compare, drop_near_duplicates, near_duplicates
from txguard.llm.shingles import shingle_set


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """Every pair compared."""
    sets = defaultdict(list)
    for doc, text in rows:
        sets[shingles(text)].append(doc)
    nodes = sorted((min(d for d in docs if d is not None), own) for own, docs in sets.items() if own and set(docs) != {None})
    root = {doc: doc for doc, _ in nodes}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, one) in enumerate(nodes):
        for b, other in nodes[k + 1 :]:
            common = len(one & other)
            if 100 * common >= 75 * (len(one) + len(other) - common):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    out = []
    for own, docs in sets.items():
        named = [d for d in docs if d is not None]
        for doc in docs:
            component = top(min(named)) if own and named else doc
            out.append((doc, len(own), component, doc == component))
    return sorted(out, key=str)


def found(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_corpus(spark, corpus):
    frame = spark.createDataFrame(corpus, "doc_id long, text string").repartition(3)
    assert found(near_duplicates(frame)) == brute(corpus)


@pytest.mark.parametrize("few", [0, near_dup.FEW])
def test_group_around_a_text_that_links_it(spark, monkeypatch, few):
    monkeypatch.setattr(near_dup, "FEW", few)
    # copies with edits of their own: alike through the base only, some of them not linked to it
    base = [f"w{k}" for k in range(120)]
    draw = np.random.default_rng(2)
    rows = [(500, " ".join(base))]
    for doc in range(90):
        words = list(base)
        for place in draw.choice(120, int(draw.integers(1, 7)), replace=False):
            words[place] = f"x{doc}n{place}"
        rows.append((doc, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(near_duplicates(frame)) == brute(rows)


def test_chain_of_revisions(spark):
    # each text near the next, ends unlike: leaders that give way to others stay compared with their lists
    rows = []
    for chain in (1, 2):
        words = [f"s{chain}w{k}" for k in range(16 * 200 + 124)]
        rows += [(1000 * chain + k, " ".join(words[16 * k : 16 * k + 124])) for k in range(201)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(near_duplicates(frame)) == brute(rows)


def test_groups_that_share_lists_but_no_link(spark, monkeypatch):
    # near copies of two texts that have much in common, but less than the threshold: no list is turned into its pairs
    draw = np.random.default_rng(5)
    common = [f"c{k}" for k in range(320)]
    rows = []
    for group in (1, 2):
        for k in range(2000):
            words = [f"g{group}w{j}" for j in range(100)]
            # one group has more texts around it, so the other does not lead the lists they share
            for place in draw.choice(100, group, replace=False):
                words[place] = f"x{group}n{k}p{place}"
            rows.append((10_000 * group + k, " ".join(common + words)))
    pairs = []

    def counted(plain):
        def count(members, sets):
            pairs.append(members.count())
            return plain(members, sets)

        return count

    for name in ("compared", "confirmed"):
        monkeypatch.setattr(near_dup, name, counted(getattr(near_dup, name)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(row.doc_id // 10_000, row.component_id) for row in got} == {(1, 10_000), (2, 20_000)}
    assert sum(pairs) <= 10 * len(rows)


def test_family_just_below_the_threshold(spark, monkeypatch):
    # every two share most of a text and nearly all that sets them apart from a leader, but few are linked: those
    # that are not must not be put together pair by pair
    draw = np.random.default_rng(7)
    rows = []
    for doc in range(300):
        words = [f"w{k}" for k in range(400)]
        for place in draw.choice(80, 9, replace=False):
            words[5 * place + 2] = f"x{doc}n{place}"
        rows.append((doc, " ".join(words)))
        if doc % 30 == 0:
            rows.append((1000 + doc, " ".join([f"y{doc}", *words[1:]])))
    pairs = []

    def counted(plain):
        def count(members, sets):
            pairs.append(members.count())
            return plain(members, sets)

        return count

    for name in ("compared", "confirmed"):
        monkeypatch.setattr(near_dup, name, counted(getattr(near_dup, name)))
    assert found(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    assert sum(pairs) <= 50 * len(rows)


@pytest.mark.parametrize("turned", [False, True])
def test_repeated_ids(spark, turned):
    a = " ".join(f"a{k}" for k in range(60))
    b = " ".join(f"b{k}" for k in range(60))
    rows = [("1", a), ("1", b), ("2", a + " more"), ("3", b + " other"), ("0", b + " last"), ("1", a)]
    frame = spark.createDataFrame(rows[::-1] if turned else rows, "doc_id string, text string").coalesce(1)
    got = sorted((row.doc_id, row.component_id, row.kept) for row in near_duplicates(frame).collect())
    assert got == [("0", "0", True), ("1", "0", False), ("1", "1", True), ("1", "1", True), ("2", "1", False), ("3", "0", False)]
    assert sorted(row.doc_id for row in drop_near_duplicates(frame).collect()) == ["0", "1", "1", "1"]


def test_awkward_rows(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    assert found(near_duplicates(awkward)) == brute(rows)


def test_kept_documents(awkward, nothing):
    kept = drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    assert sorted({r.doc_id for r in kept.collect()} - {None}) == [1, 4, 5, 6, 7, 9, 10]
    assert near_duplicates(nothing).count() == 0 and drop_near_duplicates(nothing).count() == 0


def test_bound_on_common_differences():
    # the numbers of a comparison decide links with the leader and between two sets exactly
    draw = np.random.default_rng(1)
    for _ in range(300):
        pool = draw.choice(200, 60, replace=False)
        leader, a, b = (np.unique(draw.choice(pool, draw.integers(5, 50))) for _ in range(3))
        x, y = compare(a, leader), compare(b, leader)
        common = len(np.intersect1d(a, leader))
        assert x["linked"] == (4 * common >= 3 * (len(a) + len(leader) - common))
        pair = len(np.intersect1d(a, b))
        linked = 4 * pair >= 3 * (len(a) + len(b) - pair)
        if linked and not (x["linked"] and y["linked"]) and len(a) and not np.array_equal(a, b):
            assert set(x["prefix"]) & set(y["prefix"])


def test_shingles_are_whole_texts():
    assert len(shingle_set(b"", 5)) == 0 and len(shingle_set(b"one two", 5)) == 1
    assert len(shingle_set(b" ".join(b"%d" % k for k in range(9000)), 5)) == 8996
    assert set(shingle_set(b"a b", 5)) != set(shingle_set(b"b a", 5))


@pytest.mark.parametrize("links", [[], [(1, 1)], [(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 60)] + [(100, 101), (101, 100)]])
def test_components(spark, links):
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in connected(frame, "a", "b").collect()}
    nodes = {x for pair in links if pair[0] != pair[1] for x in pair}
    assert got == {x: 100 if x >= 100 else min(nodes) for x in nodes}
