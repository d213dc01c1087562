import hashlib
import random
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from txguard.llm.merkle import leaf_hash, lowered, manifest
from txguard.llm.queries import registry

FAN = 16


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def climb(nodes):
    """The last node, and per node the pairs of what stands before and behind it on the way up."""
    where = list(range(len(nodes)))
    ways = [[] for _ in nodes]
    while len(nodes) > 1:
        for way, k in zip(ways, where):
            first = k // FAN * FAN
            way.append(("".join(nodes[first:k]), "".join(nodes[k + 1 : first + FAN])))
        nodes = [sha("".join(nodes[k : k + FAN])) for k in range(0, len(nodes), FAN)]
        where = [k // FAN for k in where]
    return nodes[0], ways


def brute(rows):
    """Sorted result rows for (id, source, leaf, check)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    inner = {}
    for source, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        inner[source] = climb([r[2] for r in own])
    root, upper = climb([inner[source][0] for source in order])
    out = []
    for source, above in zip(order, upper):
        subroot, ways = inner[source]
        for (id_, _, leaf, check), way in zip(groups[source], ways):
            node = leaf if check is None else check
            for a, b in way + above:
                node = sha(a + node + b)
            out.append((id_, source, leaf, subroot, root, sha("".join(a + b for a, b in way + above)), node, node == root))
    return sorted(out, key=str)


def made(sizes, draw):
    rows = []
    for source, n in sizes.items():
        for k in range(n):
            leaf = sha(f"{source} {k}")
            rows.append((draw.randrange(10**15), source, leaf, draw.choice([None, None, leaf, sha("other")])))
    return rows


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 1},
        {"a": 16},
        {"a": 17, None: 3, "ä": 1, "": 2},
        {"hot": 5000, "b": 256, "c": 257, "d": 1, None: 300},
        {f"s{k}": 1 + k % 3 for k in range(300)},
    ],
)
def test_against_brute_force(spark, sizes):
    rows = made(sizes, random.Random(len(sizes)))
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "id long, source string, leaf string, check string").repartition(7)
    found = manifest(frame, "id", "source", check_col="check")
    assert found.columns == ["id", "source", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    # a folded leaf of equal rows may stand in any of their places
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows)


def test_repeated_and_idless_rows(spark):
    rows = [(None, "a", sha("x"), None)] * 3 + [(5, "a", sha("y"), None)] * 40 + [(5, "a", sha("z"), sha("q"))] + [(None, None, sha("x"), None)]
    found = manifest(spark.createDataFrame(rows, "id long, source string, leaf string, check string"), "id", "source", check_col="check")
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows)


def test_proof_is_kept_on_demand_and_names_may_clash(spark):
    rows = made({"a": 40, "b": 2}, random.Random(0))
    frame = spark.createDataFrame(rows, "id long, source string, leaf string, check string")
    wide = frame.selectExpr("*", *[f"'x' AS {n}" for n in ("key", "at", "block", "root", "proof", "n", "subroot")])
    for row in manifest(wide, "id", "source", keep_proof=True).collect():
        assert row.proof_sha256 == sha(row.proof) and row.verified


def test_empty_table(spark):
    frame = spark.createDataFrame([], "id long, source string, leaf string")
    assert manifest(frame, "id", "source").collect() == []


def test_leaves_of_awkward_rows(spark, awkward):
    def told(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    leaf = leaf_hash(F.col("doc_id"), F.col("source"), F.col("text"))
    for row in awkward.select("doc_id", "source", "text", leaf.alias("h"), lowered(F.col("text")).alias("low")).collect():
        assert row.h == sha(told(row.doc_id) + told(row.source) + told(row.text))
        assert row.low is None or row.low == "".join(c.lower() if c.isascii() else c for c in row.text)


def test_query_against_brute_force(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet").collect()

    def told(*values):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    rows = []
    for d in docs:
        low = None if d.text is None else "".join(c.lower() if c.isascii() else c for c in d.text)
        check = told(d.doc_id, d.source, d.lang, d.n_chars, low) if crc32(str(d.doc_id).encode()) % 5 == 0 else None
        rows.append((d.doc_id, d.source, told(d.doc_id, d.source, d.lang, d.n_chars, d.text), check))
    want = sorted([r[:1] + r[2:] for r in brute(rows)], key=str)
    got = [tuple(r) for r in registry()["op11_cogrouped_merkle"](spark, medium).collect()]
    assert sorted(got, key=str) == want
    assert {r[-1] for r in got} == {True, False}
