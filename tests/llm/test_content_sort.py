import re
from collections import defaultdict
from hashlib import sha256

import pytest

from txguard.llm.content_sort import drop_duplicates, mark_duplicates


def brute(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc is None, doc or 0, doc))
    out = []
    for text, members in groups.items():
        members.sort()
        for place, member in enumerate(members):
            out.append((member[3], members[0][3], len(members), place == 0, sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def found(frame):
    return sorted(map(tuple, frame.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_awkward_rows(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    assert found(mark_duplicates(awkward)) == brute(rows)


@pytest.mark.parametrize("partitions", [1, 5])
def test_hot_groups_are_merged(spark, corpus, partitions):
    # a third of all rows are one text in several spellings, far above the limit of a run
    rows = corpus + [(1000 + k, " a b" * (k % 3) + "hot text") for k in range(150)] + [(77_777, "hot text")] * 40
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    assert found(mark_duplicates(frame)) == brute(rows)


def test_empty_table(nothing):
    assert mark_duplicates(nothing).count() == 0
    assert drop_duplicates(nothing).count() == 0


def test_kept_rows_have_all_columns(awkward):
    kept = drop_duplicates(awkward)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.collect()]
    # 3 has more code points than its equals; white space alone is the same text as none
    assert sorted(ids, key=str) == sorted([3, 6, None, 7, 8, 9, 10], key=str)


def test_no_python_and_one_shuffle_of_texts(awkward):
    plan = mark_duplicates(awkward)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
