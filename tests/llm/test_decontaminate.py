import pytest

from txguard.llm import decontaminate
from txguard.llm.decontaminate import clean_documents, find_passages, words_of

ITEMS = [
    (1, "Zero one two three four five six seven eight nine ten eleven"),
    (2, "three four five six seven eight nine ten eleven twelve"),
    (2, "three four five six seven eight nine ten eleven twelve"),
    (3, "short ITEM"),
    (4, ""),
    (5, None),
    (None, "an item that has no id but words enough to be a window of ten"),
    (6, "naïve"),
]


def brute(text, items):
    words = words_of((text or "").encode())
    hit, found = set(), set()
    for item, content in items:
        own = words_of((content or "").encode())
        length = min(10, len(own))
        windows = {tuple(own[k : k + length]) for k in range(len(own) - length + 1)} if own else set()
        for k in range(len(words) - length + 1 if length else 0):
            if tuple(words[k : k + length]) in windows:
                hit.update(range(k, k + length))
                found.add(item)
    return len(words), hit, sorted(x for x in found if x is not None)


TEXTS = [
    "ZERO, one-two three four five six seven eight nine!",
    "x zero one two three four five six seven eight nine ten eleven twelve y",
    "zero one two three four five six seven eight",
    "a Short item and a short-item",
    "NAïVE naïve",
    "this is an item that has no id but words enough to be a window of ten",
    "",
    None,
    "nine " * 500 + "three four five six seven eight nine ten eleven twelve",
]


@pytest.mark.parametrize("pass_bytes", [decontaminate.PASS_BYTES, 40])
def test_against_brute_force(spark, monkeypatch, pass_bytes):
    monkeypatch.setattr(decontaminate, "PASS_BYTES", pass_bytes)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for row in find_passages(docs, items).collect():
        n, hit, found = brute(row.text, ITEMS)
        assert row.found.n_words == n and list(row.found["items"]) == found
        assert {k for span in row.found.spans for k in range(span.first, span.past)} == hit


def test_awkward_rows(spark, awkward, nothing):
    items = spark.createDataFrame([(1, "one two"), (2, None)], "item_id long, text string")
    clean = clean_documents(awkward, items)
    assert clean.columns == awkward.columns
    assert clean.count() == awkward.count() - 1
    assert clean_documents(nothing, items).count() == 0
    assert clean_documents(awkward, items.filter("false")).count() == awkward.count()


def test_query(spark, medium):
    from hashlib import sha256

    from txguard.llm.documents import table
    from txguard.llm.queries import registry

    items = [tuple(r) for r in table(spark, medium, "benchmark").collect()]
    texts = {r.doc_id: r.text for r in table(spark, medium, "documents").collect()}
    rows = registry()["op9_wu_manber"](spark, medium).collect()
    assert len(rows) == len(texts)
    hits = [row for row in rows if row.contaminated]
    assert hits
    for row in hits + rows[:20]:
        n, hit, found = brute(texts[row.doc_id], items)
        ids = ",".join(sorted(map(str, found)))
        assert (row.n_words, row.n_hit, row.n_items, row.items_sha256) == (n, len(hit), len(found), sha256(ids.encode()).hexdigest())


def test_windows_that_share_a_suffix(spark):
    # very many windows end in the same two words: one look-up decides each, however many there are
    items = [(k, " ".join(f"u{k}x{j}" for j in range(8)) + " of the") for k in range(20_000)]
    tables = decontaminate.Tables((k, text.encode()) for k, text in items)
    (searcher,) = tables.searchers
    assert len(searcher.windows) == 20_000
    text = "of the " * 5000 + items[77][1]
    found = decontaminate.scan(text.encode(), tables)
    assert found["items"] == [77] and found["spans"] == [{"first": 10_000, "past": 10_010}]


def test_passes_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PASS_BYTES", 3000)
    items = spark.createDataFrame([(k, " ".join(f"w{k}v{j}" for j in range(12))) for k in range(300)], "_item long, _text string")
    parts = decontaminate._passes(items.selectExpr("_item", "cast(_text as binary) as _text"))
    sizes = {row["_pass"]: row.n for row in parts.groupBy("_pass").agg({"_text": "count"}).withColumnRenamed("count(_text)", "n").collect()}
    whole = sum(len(t) for _, t in items.collect())
    assert sum(sizes.values()) == 300 and len(sizes) >= whole // 3000
    assert max(sizes.values()) * whole / 300 < 2 * 3000
