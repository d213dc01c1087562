from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from txguard.llm import labelled, pairwise_quality, toxicity
from txguard.llm.documents import table
from txguard.llm.queries import registry


def auc(scores, labels):
    order = np.argsort(np.argsort(scores, kind="stable"), kind="stable") + 1
    scores = np.asarray(scores)
    ranks = np.array([order[scores == s].mean() for s in scores])
    positive = np.asarray(labels) == 1
    n = positive.sum()
    return (ranks[positive].sum() - n * (n + 1) / 2) / (n * (len(labels) - n))


@pytest.mark.parametrize(
    ("name", "label", "divisor", "part", "least"), [("op3_counterfactual_toxicity", "toxic", 4, 2, 0.9), ("op8_pairwise_quality", "quality", 5, 0, 0.97)]
)
def test_query_on_held_out_labels(spark, name, label, divisor, part, least):
    directory = "/root/testdata/sf0.1" if label == "toxic" else "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in registry()[name](spark, directory).collect()}
    assert len(rows) == table(spark, directory, "documents").count()
    for doc, row in rows.items():
        assert row.held_out == (crc32(str(doc).encode()) % divisor == part)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.3)
    labels = [r for r in table(spark, directory, "labels").collect() if rows[r.doc_id].held_out]
    assert auc([rows[r.doc_id].score for r in labels], [r[label] for r in labels]) > least


def test_held_out_labels_are_not_learned_from(spark, medium):
    docs, labels = table(spark, medium, "documents"), table(spark, medium, "labels")
    out = labelled.held_out("doc_id", 4, 2)
    turned = labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, labels, ~out) == toxicity.fit(docs, turned, ~out)


def test_swaps_keep_group_terms_from_counting(spark):
    # toxic texts mention one group, others another: without the penalty the mention is learned
    rows = [(k, f"the women are an idiot{'' if k % 2 else ' moron'} number {k}", 1) for k in range(60)]
    rows += [(100 + k, f"the men walk in the garden number {k}", 0) for k in range(60)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    score = model.scorer()
    assert score("they are an idiot") >= 0.3 > score("the women walk in the garden")
    texts = [t for _, t, _ in rows]
    features = sorted({f for t in texts for w in toxicity.words_of(t) for f in toxicity.features_of(w)})
    place = {f: k for k, f in enumerate(features)}

    def coded(words):
        return sorted({place[f] for w in words for f in toxicity.features_of(w) if f in place})

    own = [coded(toxicity.words_of(t)) for t in texts]
    swaps = [[coded(w) for w in toxicity.swapped(t)] for t in texts]
    labels = [y for *_, y in rows]

    def change(penalty):
        m = toxicity.train(own, labels, swaps, features, penalty)
        weight = lambda word: sum(m.weights.get(f, 0.0) for f in toxicity.features_of(word))
        return abs(weight(b"women") - weight(b"men"))

    assert change(toxicity.PENALTY) < 0.2 * change(0.0)


def test_swapped_terms():
    assert toxicity.swapped("No group here.") == []
    first, second = toxicity.swapped("Women sing. The sun shines.")
    assert b"women" not in first | second and {b"sing", b"sun"} <= first


def test_bradley_terry_order():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(400, len(pairwise_quality.FEATURES)))
    y = (x[:, 0] + 0.1 * draw.normal(size=400) > -0.5).astype(int)
    model = pairwise_quality.train(x, y)
    raw = model.raw(x)
    assert auc(raw, y) > 0.97
    # as many texts fall below the threshold as were labelled bad
    below = (raw + model.shift < np.log(0.3 / 0.7)).sum()
    assert abs(below - (y == 0).sum()) <= 2


@pytest.mark.parametrize("module", [toxicity, pairwise_quality])
def test_awkward_rows_and_labels(spark, awkward, nothing, module):
    name = "toxic" if module is toxicity else "quality"
    odd = [(1, 1), (2, 0), (2, 1), (3, None), (None, 1), (7, 0), (7, 0), (999, 1), (10, 5)]
    labels = spark.createDataFrame(odd, f"doc_id long, {name} int")
    for own in (labels, labels.filter(f"{name} = 1"), labels.filter("false")):
        model = module.fit(awkward, own, F.lit(True))
        rows = module.score(awkward, model).collect()
        assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
        assert module.score(nothing, model).count() == 0
    assert module.fit(nothing, labels, F.lit(True)) is not None


def test_sample_is_bounded(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'t' AS text")
    labels = spark.range(3000).selectExpr("id AS doc_id", "1 AS toxic")
    assert 300 < labelled.labelled_sample(docs, labels, "toxic", F.lit(True), rows=500).count() < 700


def test_all_labelled_texts_count(spark):
    # more rows than the sample of the toxicity classifier has; the texts all differ in their features
    rows = spark.range(45_000).selectExpr("id AS doc_id", "crc32(cast(id AS string)) AS h")
    docs = rows.selectExpr("doc_id", "concat_ws(' ', cast(h AS string), repeat('ab ', int(h % 61)), repeat('c. ', int(h % 53)), hex(h)) AS text")
    labels = rows.selectExpr("doc_id", "int(h % 61 + h % 7 < 20) AS quality")
    odd = spark.createDataFrame([(0, "another text of the id"), (None, "no id")], "doc_id long, text string")
    docs, labels = docs.unionByName(odd), labels.unionByName(labels.limit(10))
    assert pairwise_quality.shapes(docs, labels, F.lit(True)).count() == 45_000
    model = pairwise_quality.fit(docs, labels, F.lit(True))
    scores = pairwise_quality.score(rows.join(docs, "doc_id").filter("text <> 'another text of the id'"), model)
    scores = sorted(row.score for row in scores.select("score").collect())
    # the threshold parts off as many texts as are labelled bad, of all of them
    bad = labels.distinct().filter("quality = 0").count()
    assert len(scores) == 45_000 and scores[bad - 1] <= 0.3 + 1e-9 and scores[bad] >= 0.3 - 1e-9
    again = pairwise_quality.fit(docs.repartition(5), labels, F.lit(True))
    assert np.array_equal(model.edges, again.edges) and np.array_equal(model.weights, again.weights) and model.shift == again.shift


def test_sums_over_all_pairs():
    draw = np.random.default_rng(5)
    x, y = draw.normal(size=(300, 3)), draw.integers(0, 2, 300)

    def total(function):
        return function(iter([(x[:100], y[:100]), (x[100:], y[100:])]))

    found = pairwise_quality._ordered(total, lambda x, y: [x[:, 0], x[y == 1][:, 1]], [[0, 150, 299], [7]])
    assert found == [{k: np.sort(x[:, 0])[k] for k in (0, 150, 299)}, {7: np.sort(x[y == 1][:, 1])[7]}]
    edges = pairwise_quality._edges(total, 3, (y == 0).sum(), (y == 1).sum())
    weights = draw.normal(size=(3, pairwise_quality.BINS))
    pairs, model = pairwise_quality._Pairs(total, edges, weights), pairwise_quality.Model(edges, weights, 0.0)
    raw, size = model.raw(x), weights.size
    present = np.zeros((300, size))
    present[np.arange(300)[:, None], model.places(x)] = 1
    apart = raw[y == 1][:, None] - raw[y == 0][None, :]
    assert abs(pairs.loss - np.logaddexp(0, -apart).mean() - pairwise_quality.DECAY / 2 * (weights**2).sum()) < 1e-4
    wrong = 1 / (1 + np.exp(apart)) / apart.size
    slope = wrong.sum(axis=0) @ present[y == 0] - wrong.sum(axis=1) @ present[y == 1] + pairwise_quality.DECAY * weights.ravel()
    assert np.abs(pairs.derivatives()[0] - slope).max() < 1e-5
