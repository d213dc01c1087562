import random

import pytest

LONG = " ".join(f"word{k % 977} und{k % 31}" for k in range(30_000))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls everywhere, empty and very long texts, ties, repeated rows, and columns named like results."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog again and again", "en", "a", 3),
        (2, "The quick brown fox jumps over the lazy dog again and again", "en", "b", 3),
        (2, "The quick brown fox jumps over the lazy dog again and again", "en", "b", 3),
        (3, "The  quick brown fox\tjumps over the lazy dog again and again", None, None, None),
        (4, "", "en", "a", 0),
        (5, None, None, None, None),
        (6, " \n\t ", "fr", "a", 4),
        (None, "text without an id", None, "a", 1),
        (None, None, None, None, None),
        (7, LONG, "de", "a", 1),
        (8, LONG + " more", "de", "a", 1),
        (9, "Ünïcode ßtraße 日本語 ½ ²  \x1c end", "de", "c", 1),
        (10, "one two", "en", "c", 1),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    names = ["keep_id", "score", "kept", "component_id", "n_words", "node", "leader", "label", "shard", "size", "word", "key"]
    return frame.selectExpr("*", *[f"'x' AS {name}" for name in names])


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.filter("false")


@pytest.fixture(scope="session")
def corpus():
    """Made-up texts with copies, near copies and shared passages."""
    draw = random.Random(3)
    vocabulary = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 7))) for _ in range(400)]
    shared = draw.choices(vocabulary, k=60)
    texts = []
    for _ in range(60):
        base = draw.choices(vocabulary, k=draw.randint(3, 120))
        texts.append(" ".join(base))
        if draw.random() < 0.4:
            texts.append("  ".join(base).upper())
        for _ in range(draw.choice([0, 0, 1, 3, 12])):
            near = list(base)
            for _ in range(max(1, len(near) // draw.choice([12, 20, 40]))):
                near[draw.randrange(len(near))] = draw.choice(vocabulary)
            texts.append(" ".join(near))
        if draw.random() < 0.3:
            texts.append(" ".join(base[:20] + shared + base[20:40]))
    draw.shuffle(texts)
    return list(enumerate(texts))
