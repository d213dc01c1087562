"""Main text of web pages by a recurrent block labeller."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.llm.block_labeller import Labeller
from txguard.llm.html_leaves import INLINE, PARTING, Leaf, leaves

SAMPLE_PAGES = 200  # pages the labeller is trained on at most, chosen by a hash of the page
VARIANTS = 8  # varied forms of each of them that are added
NEUTRAL = 0.3  # share of the varied forms whose containers have lost their names
SEED = 5

# Names of tags, classes and ids that the training labels go by.
ASIDE_NAMES = {
    "menu": ["nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "toc", "tabs", "pagination", "pager"],
    "header": ["header", "masthead", "banner", "topbar", "branding"],
    "footer": ["footer", "bottom", "colophon", "copyright", "legal"],
    "sidebar": ["aside", "sidebar", "widget", "related", "recommended", "trending", "popular"],
    "notice": ["notice", "cookie", "cookies", "consent", "gdpr", "alert", "popup", "modal", "overlay", "toast"],
    "advert": ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion"],
    "form": ["form", "search", "login", "signup", "subscribe", "subscription", "newsletter", "share", "social", "button"],
    "comments": ["comment", "comments", "respond", "reply", "replies", "disqus", "discussion"],
}
MAIN_NAMES = ["article", "main", "content", "post", "entry", "story", "articlebody"]
# Tags that blocks of the main text may stand in.
MAIN_TAGS = [("p",), ("h2",), ("h3",), ("ul", "li"), ("ol", "li"), ("blockquote", "p"), ("table", "tr", "td"), ("pre",), ("section", "p"), ("div",)]

# Sentences that such parts of pages are made of, for the varied forms.
ASIDE_TEXTS = {
    "menu": ["Home", "About us", "Contact", "News", "Archive", "Startseite", "Accueil", "Inicio"],
    "header": ["The Daily Page", "Search", "Sign in", "Today's edition"],
    "footer": ["© All rights reserved.", "Privacy policy", "Terms of use", "Impressum"],
    "sidebar": ["Most read this week", "Related stories", "You may also like", "Read more"],
    "notice": ["We use cookies to improve this site. Accept all", "Please enable JavaScript to go on.", "Your subscription has expired."],
    "advert": ["Sponsored: buy now and save", "Advertisement", "Special offer, only today!"],
    "form": ["Subscribe to our newsletter", "Enter your e-mail address", "Log in to continue", "Share this on"],
    "comments": ["Great article, thanks for sharing!", "I don't agree with this at all.", "3 comments", "Reply"],
}
# Tags that name a part of a page by themselves.
PART_TAGS = ["article", "aside", "dialog", "figure", "footer", "form", "header", "hgroup", "main", "menu", "nav", "search", "section"]
_PLAIN_TAGS = (PARTING | INLINE) - set(PART_TAGS)
_ASIDE = {name: kind for kind, names in ASIDE_NAMES.items() for name in names}
_MAIN = set(MAIN_NAMES)


def weak_labels(page: list[Leaf]) -> np.ndarray:
    """Training labels from the names above a block: main text is in the main part, or anywhere on a
    page without one, and never under a name of :data:`ASIDE_NAMES` (but for headings' headers inside it)."""
    has_main = any(_MAIN & set(leaf.path) for leaf in page)
    out = []
    for leaf in page:
        main = [k for k, part in enumerate(leaf.path) if part in _MAIN]
        aside = [k for k, part in enumerate(leaf.path) if part in _ASIDE and not (part == "header" and main and k > main[0])]
        out.append(not aside and (bool(main) or not has_main))
    return np.array(out, float)


def varied(page: list[Leaf], labels: np.ndarray, others: list[str], draw: np.random.Generator) -> tuple[list[Leaf], np.ndarray]:
    """The page in another build: parts renamed, and further parts put around and into the main text.

    Some builds are neutral: containers are plain ones and their names mean nothing, so that texts,
    shapes and the rest of the page have to tell.
    """
    main_name = str(draw.choice(MAIN_NAMES))
    neutral = draw.random() < NEUTRAL
    keep_tag = not neutral and draw.random() < 0.3
    renamed: dict[str, str] = {}

    def rename(part: str) -> str:
        if neutral:
            if part in _PLAIN_TAGS:
                return part
            if part not in renamed:
                renamed[part] = "div" if part in PART_TAGS else f"c{draw.integers(0, 1000)}"
            return renamed[part]
        if keep_tag or part not in _MAIN and part not in _ASIDE:
            return part
        if part in _MAIN:
            return main_name
        if part not in renamed:
            renamed[part] = str(draw.choice(ASIDE_NAMES[_ASIDE[part]]))
        return renamed[part]

    def rebuilt(leaf: Leaf, label: float) -> Leaf:
        path = tuple(map(rename, leaf.path))
        if label and draw.random() < 0.04:  # paragraphs of a word
            return Leaf(path, leaf.text.split()[0].strip(".,;:!?") + ".", 0)
        if not label or draw.random() < 0.7:
            return Leaf(path, leaf.text, leaf.linked)
        tag = MAIN_TAGS[draw.integers(len(MAIN_TAGS))]
        words = leaf.text.split()
        text = " ".join(words[: draw.integers(1, 8)]) if draw.random() < 0.4 else leaf.text
        return Leaf((*path[:-1], *tag), text, 0)

    out = [(rebuilt(leaf, label), label) for leaf, label in zip(page, labels, strict=True)]
    main = next((leaf.path[:-1] for leaf, label in zip(page, labels, strict=True) if label), ("html", "body"))
    main = tuple(map(rename, main))
    for kind in draw.permutation(list(ASIDE_NAMES))[: draw.integers(1, 6)]:
        name = str(draw.choice(ASIDE_NAMES[kind]))
        inside = kind in ("comments", "advert", "form", "sidebar", "notice", "menu") and draw.random() < 0.5
        base = main if inside else ("html", "body", "main") if draw.random() < 0.3 else ("html", "body")
        tag = () if name in ("nav", "header", "footer", "aside", "form") else (str(draw.choice(["div", "section", "ul"])),)
        blocks = []
        for _ in range(int(draw.integers(1, 7))):
            text = str(draw.choice(others)) if others and draw.random() < 0.5 else str(draw.choice(ASIDE_TEXTS[kind]))
            leaf_tag = str(draw.choice(["p", "li", "div", "h2", "h3"]))
            blocks.append((Leaf(tuple(map(rename, (*base, *tag, name, leaf_tag))) if neutral else (*base, *tag, name, leaf_tag), text, len(text) if draw.random() < 0.3 else 0), 0.0))
        at = len(out) if kind in ("comments", "footer") else int(draw.integers(0, len(out) + 1))
        out[at:at] = blocks
    return [leaf for leaf, _ in out], np.array([label for _, label in out])


def train(pages: list[str]) -> Labeller:
    """A labeller from the labelled blocks of some pages and of varied forms of them."""
    draw = np.random.default_rng(SEED)
    parsed = [page for page in map(leaves, pages) if page]
    others = [leaf.text for page in parsed for leaf in page if 20 < len(leaf.text) < 400][:5000]
    seen, labels = [], []
    for page in parsed:
        own = weak_labels(page)
        seen.append(page)
        labels.append(own)
        for _ in range(VARIANTS):
            other, its = varied(page, own, others, draw)
            seen.append(other)
            labels.append(its)
    return Labeller().fit(seen, labels)


def sample_pages(pages: DataFrame, html_col: str) -> list[str]:
    """A bounded number of distinct pages, the same for every layout of the table.

    The hashes are made distinct first, so copies take one place; only the chosen pages are shuffled whole.
    """
    found = pages.filter(F.length(html_col) > 0).select(F.col(html_col).alias("html"), F.xxhash64(html_col).alias("order"))
    chosen = found.select("order").distinct().orderBy("order").limit(SAMPLE_PAGES)
    distinct = found.join(F.broadcast(chosen), "order", "left_semi").dropDuplicates(["order", "html"])
    return [row.html for row in distinct.orderBy("order", "html").limit(SAMPLE_PAGES).collect()]


def extract(pages: DataFrame, labeller: Labeller, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with the main text of every whole page: its blocks joined by line feeds.

    Null and empty pages and pages without main text have an empty text. A column called
    ``text_col`` is replaced, all others stay; repeated rows get equal texts; nothing is shuffled.
    """
    shared = pages.sparkSession.sparkContext.broadcast(labeller.w)

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Labeller(shared.value)
        for batch in batches:
            parsed = [leaves(value.as_py()) for value in batch]
            out = [
                "\n".join(leaf.text for leaf, p in zip(page, scores, strict=True) if p >= 0.5)
                for page, scores in zip(parsed, own.label(parsed), strict=True)
            ]
            yield pa.array(out, pa.string())

    return pages.withColumn(text_col, texts(F.coalesce(F.col(html_col), F.lit(""))))


def main_text(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """:func:`extract` with a labeller trained on a bounded sample of the same pages."""
    return extract(pages, train(sample_pages(pages, html_col)), html_col, text_col)
