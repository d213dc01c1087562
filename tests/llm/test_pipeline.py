from collections import defaultdict

import corpus_pipeline
from txguard.llm.documents import table
from txguard.llm.labelled import held_out
from txguard.llm.queries import oracles, registry

from .test_content_sort import brute as brute_copies
from .test_decontaminate import brute as brute_passages
from .test_near_dup import brute as brute_near


def test_every_stage_against_brute_force(spark, medium):
    docs = table(spark, medium, "documents")
    columns = docs.columns
    counts = defaultdict(int)
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        after = stage(spark, docs, medium)
        if name == "encoding":
            rows = after.collect()
            assert {r.doc_id for r in rows} == set(before) and all(r.round_trip for r in rows)
            continue
        assert after.columns == columns
        after = after.cache()
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        assert after.count() == len(ids)
        counts[name] = len(before) - len(ids)
        if name == "exact_dedup":
            assert ids == {row[0] for row in brute_copies(before.items()) if row[3]}
        elif name == "near_dedup":
            assert ids == {row[0] for row in brute_near(before.items()) if row[3]}
        elif name == "decontamination":
            items = [tuple(r) for r in table(spark, medium, "benchmark").collect()]
            assert ids == {doc for doc, text in before.items() if not brute_passages(text, items)[1]}
        else:
            labels = {r.doc_id: r.toxic for r in table(spark, medium, "labels").filter(held_out("doc_id", 4, 2)).collect()}
            clean = [doc for doc, toxic in labels.items() if not toxic]
            assert sum(doc in ids for doc in clean) >= 0.97 * len(clean)
        docs = after
    assert all(counts[name] for name, _ in corpus_pipeline.STAGES[:-1])


def test_run_is_the_stages_in_order(spark, small):
    docs = table(spark, small, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
    assert sorted(docs.collect()) == sorted(corpus_pipeline.run(spark, small).collect())


def test_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry())
    assert numbers == sorted(set(numbers)) and numbers[:10] == list(range(1, 11))
    assert set(oracles()) <= set(registry())
    assert corpus_pipeline.ORACLE_SQL is None
