import html
import re

import numpy as np
import pytest

from txguard.llm import main_text
from txguard.llm.block_labeller import Labeller
from txguard.llm.documents import table
from txguard.llm.html_leaves import leaves

RARE = """<html><head><title>x</title></head><body><header><h1>Site</h1></header><nav><a href=/>Home</a></nav>
<aside class="sidebar"><p>Read the most popular story of this week right here.</p></aside>
<div class="cookie-notice">We use cookies on this site.</div><main><article><h1>Title &amp; more</h1>
<p>First   paragraph
 of the text, which is long enough.</p><p>Second<br>line &lt;b&gt; here.</p><div class="ad">Buy this now</div>
<ul><li>one thing</li><li>another</li></ul></article><section id="comments"><h2>Comments</h2>
<p>I liked this article very much, it is about things.</p></section><form><label>E-mail</label><input></form></main>
<footer>Imprint</footer></body>"""
RARE_TEXT = "Title & more\nFirst paragraph of the text, which is long enough.\nSecond line <b> here.\none thing\nanother"


def article(page):
    """Text of the article element, by plain cutting: the pages of the tables have one each."""
    inside = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", part)).split()) for part in re.split(r"</?(?:p|h1)>", inside))
    return "\n".join(block for block in blocks if block)


@pytest.fixture(scope="module")
def labeller(spark, medium):
    return main_text.train(main_text.sample_pages(table(spark, medium, "pages"), "html"))


def test_pages_of_the_table(spark, medium, labeller):
    rows = main_text.extract(table(spark, medium, "pages"), labeller).collect()
    assert len(rows) == table(spark, medium, "pages").count()
    assert sum(row.text != article(row.html) for row in rows) == 0


def test_other_builds_of_a_page(spark, labeller):
    other = RARE.replace("<main><article>", '<div class="post-content">').replace("</article>", "</div>").replace("</main>", "")
    rows = main_text.extract(spark.createDataFrame([(RARE,), (other,)], "html string"), labeller).collect()
    assert [row.text for row in rows] == [RARE_TEXT, RARE_TEXT]


def test_awkward_pages(spark, labeller):
    pages = [None, "", "  ", "plain text", "<p", "<p>a<p>b &am &amp c", "<script>x</script>", "<!-- <p>no</p> -->", "<div>" * 3000 + "deep", "<p>" + "long " * 40_000, 'a <b title="x>y">c</b> < d']
    frame = spark.createDataFrame([(k, p, "x", "y") for k, p in enumerate(pages)], "page_id long, html string, text string, n_chars string")
    rows = main_text.extract(frame.union(frame), labeller).collect()
    assert len(rows) == 2 * len(pages)
    by_id = {row.page_id: row.text for row in rows}
    assert by_id[0] == by_id[1] == by_id[2] == by_id[6] == by_id[7] == ""
    assert main_text.main_text(frame.filter("false")).count() == 0


def test_leaves():
    page = "<div id=main>a<p>b <i>c</i>d<p>e<ul><li>f<li>g</ul>h&nbsp;i</div>tail"
    found = [(leaf.path, leaf.text) for leaf in leaves(page)]
    assert [text for _, text in found] == ["a", "b cd", "e", "f", "g", "h i", "tail"]
    assert found[1][0] == ("div", "main", "p") and found[4][0] == ("div", "main", "ul", "li") and found[6][0] == ()
    hidden = leaves("<p>x<script>if (a<b) '</p>'</script>y<style>p{}</style><!-- z --></p>")
    assert [leaf.text for leaf in hidden] == ["xy"]


def test_gradient():
    """The backward pass agrees with differences of the loss."""
    page = leaves(RARE)
    label = np.array([k % 2 for k in range(len(page))], float)
    short, short_label = page[:3], label[:3]
    model = Labeller()
    from txguard.llm.block_labeller import _sigmoid, encode

    coded = [encode(page), encode(short)]

    def loss():
        scores, kept = model._run(coded)
        p = np.clip(_sigmoid(scores), 1e-12, 1 - 1e-12)
        y = np.zeros_like(scores)
        y[:, 0], y[:3, 1] = label, short_label
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * kept["mask"][:, :, 0]).sum() / kept["mask"].sum()

    gradient = model._gradient(coded, [label, short_label])
    draw = np.random.default_rng(0)
    for name, values in model.w.items():
        flat = values.reshape(-1)
        used = np.flatnonzero(gradient[name].reshape(-1))
        for at in draw.choice(used, min(6, len(used)), replace=False):
            flat[at] += 1e-5
            up = loss()
            flat[at] -= 2e-5
            down = loss()
            flat[at] += 1e-5
            assert np.isclose((up - down) / 2e-5, gradient[name].reshape(-1)[at], rtol=1e-3, atol=1e-8), name


@pytest.mark.parametrize(
    "page, texts",
    [
        ('<p>a <svg class="i"/> b</p><p>c</p>', ["a b", "c"]),
        ('<p>a <svg class="i > j"/> b</p><p>c <svg><text>no</text></svg>d</p>', ["a b", "c d"]),
        ("<p>a</p><video-player></video-player><audio-clip><p>b</p>", ["a", "b"]),
        ("<p>a <video src=x> b</p><object><p>c</p>", ["a b", "c"]),
        ("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p><p>c <math/> d</p>", ["so x=2 holds", "c d"]),
        ("<p>a</p><video>no</video><script>no</script><p>b</p><style>no", ["a", "b"]),
    ],
)
def test_text_behind_embedded_elements(page, texts):
    assert [leaf.text for leaf in leaves(page)] == texts


def test_sample_counts_distinct_pages(spark):
    # more copies of each page than the sample has places
    rows = [(f"<p>page {k}</p>",) for k in range(300) for _ in range(250 if k < 40 else 1)]
    frame = spark.createDataFrame(rows, "html string").repartition(5)
    sample = main_text.sample_pages(frame, "html")
    assert len(sample) == len(set(sample)) == main_text.SAMPLE_PAGES


@pytest.mark.parametrize(
    "page, texts",
    [
        ("<p data-x=don't>Hello one</p><p>Middle text</p><p data-y=won't>Bye</p>", ["Hello one", "Middle text", "Bye"]),
        ("<a href=x'>link</a> more <b title=\"a>b\">c</b> d'", ["link more c d'"]),
        ("<p a= 'x>y' b=\"q'>z\">t</p><p a='unclosed>u</p><p>v</p>", ["t", "u", "v"]),
        ("q <foo> c <my-tag class=side>in</my-tag> z<p>x", ["q c in z", "x"]),
        ("<my-menu><p>a</p></my-menu><p>b</p>", ["a", "b"]),
        ("<p>x<select><option>a<p>rest", ["x"]),
    ],
)
def test_tags_as_browsers_read_them(page, texts):
    assert [leaf.text for leaf in leaves(page)] == texts


def test_names_of_custom_elements_are_in_the_path():
    assert leaves("<my-menu class=Top><p>a</p></my-menu><p>b</p>")[0].path == ("my-menu", "top", "p")


def neutral(page, draw):
    """The page with plain containers and names that mean nothing, none of them seen in training."""
    names = {}
    page = re.sub(r"<(/?)(nav|header|footer|aside|main|article|section)\b", r"<\1div", page)
    return re.sub(r'(class|id|role)="[^"]*"', lambda m: f'class="{names.setdefault(m[0], "k" + str(draw.integers(10**6)))}"', page)


def test_unseen_pages_without_names(spark, labeller, medium):
    seen = {row.html for row in table(spark, medium, "pages").collect()}
    unseen = [row.html for row in table(spark, medium.replace("0.01", "0.1"), "pages").collect() if row.html not in seen][:400]
    draw = np.random.default_rng(4)
    frame = spark.createDataFrame([(k, neutral(page, draw)) for k, page in enumerate(unseen)], "k int, html string").repartition(8)
    rows = main_text.extract(frame, labeller).collect()
    assert sum(row.text == article(unseen[row.k]) for row in rows) >= 0.95 * len(unseen)


def test_inference_is_the_forward_pass(labeller):
    from txguard.llm import block_labeller

    pages = [block_labeller.encode(leaves(RARE)), block_labeller.encode(leaves(RARE)[:4])]
    whole, _ = labeller._run(pages)
    fed, block_labeller.FED = block_labeller.FED, 3
    assert np.allclose(labeller._scores(pages), whole)
    block_labeller.FED = fed


def test_very_long_page_in_bounded_memory(labeller):
    import tracemalloc

    page = leaves("<p>some text here." * 100_000)
    tracemalloc.start()
    (scores,) = labeller.label([page])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(scores) == 100_000 and peak < 200e6
