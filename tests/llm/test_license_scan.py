import re

from txguard.llm.license_scan import PHRASES, TEMPLATES, document_frequencies, index_words, scan
from txguard.llm.queries import registry

TEXTS = [
    "Released under the MIT License. Also UNDER the mit   license!",
    "Licensed under the Apache License, Version 2.0 (the License)",
    "CC BY-NC 4.0 cc by nc cc_by.nc",
    "This work is licensed under the GNU General Public License, version 3.",
    "GNU General Public License without a version",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "Permission is hereby granted, at a charge, to any person obtaining a copy of this software and associated documentation files",
    "general public license version 3",
    "the license of the mit under",
    "",
    None,
    "ünder the MİT license",
    ("filler " * 9000) + "under the mit license",
]


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def base(text):
    own, places = words(text), []
    for label, phrase in PHRASES.items():
        parts = phrase.split()
        places += [(k, label) for k in range(len(own)) if own[k : k + len(parts)] == parts]
    return len(own), sorted(places)


def test_phrases_and_templates(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    rows = scan(frame, document_frequencies(frame)).orderBy("doc_id").collect()
    for row in rows:
        n, places = base(row.text)
        assert row.licenses.n_words == n
        assert sorted((p.first, p.label) for p in row.licenses.places) == places
        assert list(row.licenses.base_labels) == sorted({label for _, label in places})
        assert set(row.licenses.base_labels) <= set(row.licenses.labels)
        assert (row.licenses.score == 1.0) if places else 0 <= row.licenses.score <= 1
    labels = [list(row.licenses.labels) for row in rows]
    assert labels[3] == ["gpl-3"] and labels[4] == [] and labels[5] == ["mit"]
    assert labels[6] == []  # the key phrase is missing
    assert labels[7] == []  # words enough for a look-up, but the key phrase is cut


def test_every_template_of_a_text_with_many_licence_words(spark):
    # stray words and other licences before it do not keep a template from being looked up
    stray = "affero noncommercial sharealike unencumbered mozilla dedication universal lesser cc0 "
    rows = [(k, stray + template + " end") for k, (_, template, _) in enumerate(TEMPLATES)]
    rows.append((len(rows), " and ".join(template for _, template, _ in TEMPLATES)))
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    frequencies = {word: 1 if word in stray.split() else 100 for word in index_words()}, 1000
    found = [row.licenses for row in scan(frame, frequencies).orderBy("doc_id").collect()]
    for (label, _, _), its in zip(TEMPLATES, found, strict=False):
        assert label in its.labels and its.score > 0.999
    assert set(found[-1].labels) == {label for label, _, _ in TEMPLATES}


def test_query_against_brute_force(spark, medium):
    from txguard.llm.documents import table

    texts = {r.doc_id: r.text for r in table(spark, medium, "documents").collect()}
    query = registry()["op4_positional_license_scan"](spark, medium)
    plan = query._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    rows = query.collect()
    assert len(rows) == len(texts) and any(row.n_base for row in rows)
    for row in rows:
        n, places = base(texts[row.doc_id])
        starts = [k for k, _ in places]
        assert (row.n_words, row.n_base) == (n, len(places))
        assert (row.first_word, row.last_word) == (min(starts, default=None), max(starts, default=None))
        assert row.base_labels == ",".join(sorted({label for _, label in places}))


def test_awkward_rows(awkward, nothing):
    found = scan(awkward, document_frequencies(awkward))
    assert found.count() == awkward.count()
    assert scan(nothing, document_frequencies(nothing)).count() == 0
