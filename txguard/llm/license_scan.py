"""Licence scans with a positional index of rare words.

Templates are word sequences. Their words other than the commonest are posted with template and
position. For each template the word of its key phrases with the highest inverse document frequency
is looked up; every posting gives a place where the template may begin. There the templates' other
words are compared by relative position, and a template counts when enough of its weight is found and
its key phrases stand where they must. As the word looked up is one of a key phrase, every place where
a template counts is looked at.
"""

from __future__ import annotations

from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases that are labels by themselves.
PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}

# Label, template and the key phrases that must stand in it. Published licence wording.
TEMPLATES = [
    ("agpl-3", "gnu affero general public license version 3", ["affero general public license"]),
    ("apache-2", "licensed under the apache license version 2 0", ["apache license version 2"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ["source and binary forms"]),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ["creative commons attribution 4"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license", ["attribution noncommercial"]),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license", ["attribution sharealike"]),
    ("cc0", "cc0 1 0 universal public domain dedication", ["public domain dedication"]),
    ("gpl-2", "licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("gpl-3", "licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["with or without fee"]),
    ("lgpl-3", "licensed under the gnu lesser general public license version 3", ["lesser general public license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ["free of charge"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["public domain"]),
]

# Template words too common to be looked up.
COMMON_WORDS = ["0", "1", "2", "3", "4", "a", "and", "any", "are", "by", "copy", "for", "free", "in", "into", "is", "of", "or", "the", "this", "to", "under", "use", "v", "with", "without"]

LEAST_COVERAGE = 0.7  # share of a template's weight that must stand in place

WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """Words of a text after lower-casing A-Z; null counts as empty."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(1))


def index_words() -> list[str]:
    return sorted({word for _, template, _ in TEMPLATES for word in template.split()} - set(COMMON_WORDS))


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[dict[str, int], int]:
    """Number of texts with each index word, over all texts, and the number of texts.

    The driver gets one row for each index word that occurs.
    """
    found = F.array_intersect(words(F.col(text_col)), F.array(*map(F.lit, index_words())))
    counts = docs.select(F.explode(found).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return {row.word: row.n for row in counts.collect()}, docs.count()


def scan(
    docs: DataFrame, frequencies: tuple[dict[str, int], int], text_col: str = "text", found_col: str = "licenses"
) -> DataFrame:
    """``docs`` with ``found_col``: ``n_words``, ``places`` of phrases, ``base_labels``, ``labels``, ``score``.

    ``places`` has label and first word (from 0) of every place where a phrase stands. ``labels`` has
    the labels of phrases and of templates, ``score`` is 1 where a phrase stands, else the largest
    covered share of a template that counts, else 0. Null and empty texts have no words, no labels
    and score 0. Each row is worked on by itself, so repeated rows get equal results and nothing is
    shuffled; a column called ``found_col`` is replaced, all others stay.
    """
    rare = _rarity(frequencies)
    listed = docs.withColumn("_words", words(F.col(text_col)))
    known = F.array(*map(F.lit, sorted(rare)))
    # one array for the row's licence words; most rows have none and skip everything behind it
    listed = listed.withColumn("_present", F.array_intersect("_words", known))
    any_phrase_word = F.arrays_overlap("_words", F.array(*[F.lit(p.split()[_anchor(p)]) for p in PHRASES.values()]))
    places = F.when(any_phrase_word, F.concat(*[_places(label, phrase) for label, phrase in PHRASES.items()]))
    listed = listed.withColumn("_places", F.coalesce(places, F.array().cast("array<struct<label:string,first:int>>")))
    listed = listed.withColumn("_starts", F.when(F.size("_present") > 0, _starts(rare)).otherwise(F.array().cast("array<bigint>")))
    listed = listed.withColumn("_matches", _matches(rare))
    base = F.array_sort(F.array_distinct(F.transform("_places", lambda p: p["label"])))
    result = F.struct(
        F.size("_words").cast("long").alias("n_words"),
        F.col("_places").alias("places"),
        base.alias("base_labels"),
        F.array_sort(F.array_union(base, F.transform("_matches", lambda m: m["label"]))).alias("labels"),
        F.when(F.size("_places") > 0, 1.0)
        .otherwise(F.coalesce(F.array_max(F.transform("_matches", lambda m: m["coverage"])), F.lit(0.0)))
        .alias("score"),
    )
    return listed.withColumn(found_col, result).drop("_words", "_present", "_places", "_starts", "_matches")


def _rarity(frequencies: tuple[dict[str, int], int]) -> dict[str, float]:
    counts, total = frequencies
    return {word: log((total + 1) / (counts.get(word, 0) + 1)) + 0.01 for word in index_words()}


def _anchor(phrase: str) -> int:
    """Place of the word of a phrase that is looked for first: its first index word."""
    parts = phrase.split()
    return max(range(len(parts)), key=lambda k: (parts[k] not in COMMON_WORDS, -k))


def _stands(sequence: list[str], start: Column) -> Column:
    """Whether the words stand one after another from ``start``, counted from 0."""
    return reduce(lambda a, b: a & b, (F.get("_words", start + k).eqNullSafe(word) for k, word in enumerate(sequence)))


def _places(label: str, phrase: str) -> Column:
    parts = phrase.split()
    at = _anchor(phrase)
    starts = F.filter(
        F.transform("_words", lambda w, i: F.when((w == parts[at]) & _stands(parts, i - at), i - at)), lambda i: i.isNotNull()
    )
    return F.transform(starts, lambda i: F.struct(F.lit(label).alias("label"), i.cast("int").alias("first")))


def _starts(rare: dict[str, float]) -> Column:
    """Distinct places where a template may begin, as template number times 2**32 plus place plus 2**31.

    Each template is posted under the rarest word of its key phrases; a posting at position q for a
    word at place i gives the place i - q, which may lie before the text when its beginning is cut off.
    """
    postings: dict[str, list[int]] = {}
    for number, (_, template, phrases) in enumerate(TEMPLATES):
        parts = template.split()
        inside = [_position(parts, p.split()) + k for p in phrases for k in range(len(p.split()))]
        position = max((k for k in inside if parts[k] in rare), key=lambda k: (rare[parts[k]], -k))
        postings.setdefault(parts[position], []).append((number << 32) + (1 << 31) - position)
    words_with_place = F.filter(
        F.transform("_words", lambda w, i: F.struct(w.alias("w"), i.cast("long").alias("i"))),
        lambda x: F.array_contains(F.array(*map(F.lit, postings)), x["w"]),
    )
    table = F.create_map(*[x for word, codes in postings.items() for x in (F.lit(word), F.array(*[F.lit(c).cast("long") for c in codes]))])
    codes = F.transform(words_with_place, lambda x: F.transform(F.element_at(table, x["w"]), lambda code: code + x["i"]))
    return F.array_distinct(F.flatten(codes))


def _matches(rare: dict[str, float]) -> Column:
    """Label and coverage of the templates that count at one of the places."""
    found = [_match(number, *entry, rare) for number, entry in enumerate(TEMPLATES)]
    return F.filter(F.array(*found), lambda m: m.isNotNull() & (m["coverage"] >= LEAST_COVERAGE))


def _match(number: int, label: str, template: str, phrases: list[str], rare: dict[str, float]) -> Column:
    """Label of a template and its best coverage at a place where its key phrases stand; null without one."""
    parts = template.split()
    weights = [rare.get(word, 0.01) for word in parts]

    def start(code: Column) -> Column:
        return F.pmod(code, F.lit(1 << 32)) - (1 << 31)

    def verified(code: Column) -> Column:
        checks = [_stands(p.split(), (start(code) + _position(parts, p.split())).cast("int")) for p in phrases]
        return reduce(lambda a, b: a & b, checks)

    def coverage(code: Column) -> Column:
        hits = [
            F.when(F.get("_words", (start(code) + k).cast("int")) == word, F.lit(weight)).otherwise(0.0)
            for k, (word, weight) in enumerate(zip(parts, weights, strict=True))
        ]
        return reduce(lambda a, b: a + b, hits) / sum(weights)

    own = F.filter("_starts", lambda code: F.shiftright(code, 32) == number)
    best = F.array_max(F.transform(F.filter(own, verified), coverage))
    return F.when(F.size("_starts") > 0, F.struct(F.lit(label).alias("label"), best.alias("coverage")))


def _position(parts: list[str], phrase: list[str]) -> int:
    return next(k for k in range(len(parts)) if parts[k : k + len(phrase)] == phrase)
