"""Marginals against all labellings, held-out pages against their article, and layouts the given pages do not show."""

import html
import itertools
import math
import re

import pytest

from voxsift.llm import html_extract as h
from voxsift.llm.html_tree import features, parse

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def given_pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


@pytest.fixture(scope="module")
def model(given_pages):
    return h.trained(given_pages, 100)


def plain(source):
    inner = re.search(r"(?s)<article[^>]*>(.*?)(?:</article>|<footer|\Z)", source)[1]
    blocks = re.split(r"</?(?:p|h1|h2|div|ul|li)\b[^>]*>", inner)
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " " , b)).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


def test_marginals_are_exact():
    page = parse("<body><nav><ul><li><a>x</a></li></ul></nav><article><p>One, two.</p><div class=comments>y</div></article></body>")
    model = h.default_model()
    scores = [sum(model.weights.get(n, 0) * v for n, v in own) for own in features(page)]
    total, ones = 0.0, [0.0] * len(scores)
    for told in itertools.product((0, 1), repeat=len(scores)):
        weight = math.exp(sum(s * y for s, y in zip(scores, told)))
        for n, node in enumerate(page.nodes[1:], 1):
            weight *= model.ties[told[node.parent]][told[n]]
        total += weight
        ones = [a + weight * y for a, y in zip(ones, told)]
    assert h.marginals(page, model) == pytest.approx([a / total for a in ones])


def test_held_out_pages(given_pages, model):
    rows = h.main_text(given_pages, model).collect()
    source = {r.page_id: r.html for r in given_pages.collect()}
    wrong = [r.page_id for r in rows if r.text != plain(source[r.page_id])]
    assert len(wrong) <= len(rows) * 0.01, wrong[:5]


LAYOUTS = {
    "<html><body><header class='site-header'><h1>Site</h1><ul class=menu><li><a href=/>Home</a></ul></header>"
    "<div id='content'><h1>Title</h1><p>First &amp; second,\n  third.<p>More text here, with <a href=x>a link</a> in it."
    "<ul><li>A point that is made.</li><li>Another point, longer.</li></ul></div>"
    "<div class=\"sidebar\"><p>Read this too, it is great.</p></div><div id=comments><p>I disagree, strongly.</p></div>"
    "<form action=x><label>Mail</label><input><button>Go</button></form><div class='cookie-notice'>We use cookies.</div>"
    "<footer><p>&copy; 2024 Somebody, somewhere.</p></footer></body></html>":
        "Title\nFirst & second, third.\nMore text here, with a link in it.\nA point that is made.\nAnother point, longer.",
    "<main><section><h2>Part</h2><p>Some text, and more.</p></section><aside><p>Not this, really.</p></aside>"
    "<section class='comments'><h3>Comments</h3><p>A long comment, with words. And more.</p></section></main><nav><p>Links, links.</p></nav>":
        "Part\nSome text, and more.",
    "<article><h1>T</h1><div class=\"ad\">Buy now, please.</div><p>Body, of it.</p><script>var x='<p>no</p>'</script>"
    "<style>p{}</style><!-- <p>no</p> --><p>End &#x41;&nbsp;&lt;b&gt;.</p></article>": "T\nBody, of it.\nEnd A <b>.",
    "<article><p>un<b>closed <i>tags</b> here.<p title='a>b'>Second, one.": "unclosed tags here.\nSecond, one.",
    '<article><p>One, of it.</p><svg-icon name="x"></svg-icon><p>Two is the text.</p></article>': "One, of it.\nTwo is the text.",
    '<article><title-bar></title-bar><style-guide></style-guide><p>One, of it.</p><template-x></template-x><p>Two is the text.</p></article>':
        "One, of it.\nTwo is the text.",
    '<article><p>One, of it.</p><svg class="i"/><p>Two <svg/>is <SVG d="a>b" />the text.</p><svg class="i"><text>no</text><path/></svg><p>Three, too.</p></article>':
        "One, of it.\nTwo is the text.\nThree, too.",
    "": "", "   ": "", "<nav>only</nav>": "", "<": "",
}


def test_other_layouts(model):
    for source, text in LAYOUTS.items():
        for m in (model, h.default_model()):
            assert "\n".join(h.extract(source, m)) == text


def test_rows(spark, model):
    rows = [(1, "u", None), (1, "u", None), (2, None, ""), (None, "u", "<article><p>Text, here.</p></article>"), (3, "u", "<article><p>" + "Long, text. " * 50000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    got = {(r.page_id, r.n_chars, r.text[:5]) for r in h.main_text(pages).collect()}
    assert got == {(1, 0, ""), (2, 0, ""), (None, 11, "Text,"), (3, 599999, "Long,")}
    assert h.main_text(pages).count() == 5 and h.main_text(pages.limit(0)).collect() == []


def text_of(body, model=None):
    return h.extract(f"<html><body><article>{body}</article></body></html>", model or h.default_model())


def test_elements_within_a_line_do_not_break_it():
    assert text_of("<p>See <x-tip class=note>this</x-tip> word, and go on.</p>") == ["See this word, and go on."]
    assert text_of("<p>One <ruby>two<rt>zwei</rt></ruby>, <output>three</output> <nobr>four</nobr> <picture><img src=x></picture>five.</p>") == [
        "One twozwei, three four five."]
    assert text_of("<p>Press <button class=b>OK <b>now</b></button>to go on, <select><option>a<option>b</select>or stay.</p>") == ["Press to go on, or stay."]
    assert text_of("<p>A line.<br>Goes on<hr>here, <x-a>with <x-b>two</x-b></x-a> of them.</p><p>Next, then.</p>") == [
        "A line. Goes on here, with two of them.", "Next, then."]


def test_blocks_in_custom_elements_belong_to_them():
    told = "<p>We tell you a story, a long one. It has an end.</p>"
    assert text_of(told + "<x-box class=sidebar><p>Read this too, it is great.</p></x-box>" + told) == ["We tell you a story, a long one. It has an end."] * 2
    assert text_of(told + "<x-box class='cookie notice'>We use cookies, many of them.</x-box><p>The story goes on, as it must.</p>") == [
        "We tell you a story, a long one. It has an end.", "The story goes on, as it must."]
    assert text_of(told + "<button><div>Share it, now.</div></button>" + told) == ["We tell you a story, a long one. It has an end."] * 2
    page = parse("<div><x-a><p>in</x-a>out</div>")
    assert [(page.nodes[n].tag, text) for n, text, _ in page.blocks] == [("p", "in"), ("div", "out")]


@pytest.mark.parametrize("source", [
    "<div>" * 50_000 + "x" + "</div>" * 50_000, "<div>" * 50_000 + "</span></x-y></b></section>" * 50_000,
    "<div>" * 50_000 + "</section>" * 50_000, "<div>" * 50_000 + "<dd>x</dd>" * 50_000, "<li><ul>" + "<div>" * 50_000 + "<li>x</li>" * 50_000,
    "<x-a>t" * 50_000 + "</x-a>" * 50_000, "<button>" * 50_000 + "</select>" * 50_000 + "<div>x", "<p><x-a>" * 50_000 + "</x-b>" * 50_000, "<ul><li>" * 50_000 + "</li>" * 50_000,
])
def test_deep_pages_take_time_in_proportion(source):
    import time

    start = time.process_time()
    page = parse(source)
    assert time.process_time() - start < 5
    assert len(page.nodes) <= 100_003
    h.extract(source, h.default_model())


def test_pages_the_fit_has_not_seen(given_pages):
    """The model is fitted to pages drawn from one half, and judged on the other half."""
    from pyspark.sql import functions as F

    half = F.pmod(F.xxhash64(F.lit("half"), "url"), F.lit(2))
    model = h.trained(given_pages.where(half == 0))
    unseen = given_pages.where(half == 1)
    source = {r.page_id: r.html for r in unseen.collect()}
    seen = {r.html for r in given_pages.where(half == 0).collect()}
    rows = [r for r in h.main_text(unseen, model).collect() if source[r.page_id] not in seen]
    wrong = [r.page_id for r in rows if r.text != plain(source[r.page_id])]
    assert len(rows) > 100 and len(wrong) <= len(rows) * 0.01, wrong[:5]


def test_labels_come_from_the_marked_article_alone():
    page = parse("<div class=menu><p>a</p></div><article class=post><p>b</p><div class=comments><p>c</p></div><aside>d</aside><h2>e</h2></article>")
    told = h.labels(page)
    assert [(node.tag, label) for node, label in zip(page.nodes, told)] == [
        ("page", 0), ("div", 0), ("p", 0), ("article", 1), ("p", 1), ("div", -1), ("p", -1), ("aside", -1), ("h2", 1)]
    assert h.labels(parse("<article>a</article><article>b</article>")) is None and h.labels(parse("<p>a")) is None
