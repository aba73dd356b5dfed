"""Main text of pages: exact marginals, and the text of the pages' articles."""

import html as H
import itertools
import random
import re
import time

import pytest

from graphcluster.llm import html_model, registry


def article(page):
    """The article's blocks by plain string work (the pages' own markup)."""
    m = re.search(r"<article>(.*?)</article>", page or "", re.S)
    if not m:
        return ""
    blocks = re.split(r"</?(?:p|h1)>", m[1])
    texts = [" ".join(H.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


@pytest.fixture(scope="module")
def model():
    return html_model.Model.train(*html_model.observe(html_model.LAYOUTS, 20))


def test_pages(spark, sf, duck):
    pages = {p: (u, h) for p, u, h in duck.sql("SELECT page_id, url, html FROM pages").fetchall()}
    rows = registry.op7_html_model(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.url == pages[r.page_id][0]
        assert r.text == article(pages[r.page_id][1])
        assert r.n_chars == len(r.text)


def test_marginals_are_exact(model):
    """Against the sum over all labellings of small trees."""
    rng = random.Random(0)
    for _ in range(20):
        page, depth = "", 0
        for _ in range(7):
            page += rng.choice(["<div class=ad>", "<p>Some words, here.", "<article>", "<a href=x>link</a>", "</div>",
                                "<ul><li>item"])
        dom = html_model.Dom(page)
        n = len(dom.tag)
        if n > 11:
            continue
        local = [sum(model.odds.get(f, 0.0) for f in own) for own in html_model.features(dom)]
        weight, total = [0.0] * n, 0.0
        for y in itertools.product((0, 1), repeat=n):
            w = model.root if y[0] else 1 - model.root
            for i in range(n):
                w *= 2.718281828459045 ** (local[i] * y[i])
                if i:
                    w *= model.child[y[dom.parent[i]]][y[i]]
            total += w
            for i in range(n):
                weight[i] += w * y[i]
        assert model.marginals(dom) == pytest.approx([w / total for w in weight], abs=1e-9)


def test_other_layouts(model):
    page = """<html><head><title>T</title><style>p{}</style><script>var a="<p>x</p>";</script></head><body>
    <div class="navbar menu"><a href=1>Home</a><a href=2>News</a></div>
    <div id="cookie-banner"><p>This site uses cookies, as they all do.</p><button>OK</button></div>
    <div class="content"><h1>The  headline &amp; more</h1><p>First paragraph, with <b>bold</b>&nbsp;text and
    <a href=x>a link</a> in it. It is long enough.<p>Second one, not closed. It has some words too.
    <ul><li>An item, one.<li>An item, two.</ul></div>
    <aside class="sidebar"><p>Other things, elsewhere. Look.</p></aside>
    <div class="comments"><div class="comment"><p>A reader wrote this. It was nice, they said.</p></div></div>
    <form><p>Write to us, here.</p><textarea>text</textarea></form><footer><p>Copyright, 2020. All rights.</p></footer>"""
    assert model.text(page) == ("The headline & more\nFirst paragraph, with bold text and a link in it. It is long "
                                "enough.\nSecond one, not closed. It has some words too.\nAn item, one.\nAn item, two.")


def test_edges(spark, model):
    big = "<article><p>" + "word, and word. " * 50000 + "</article>"
    rows = [None, "", "plain text, without markup. It is short.", "<p", "&amp;", big, big, "<article></article>",
            "<" * 2000, "<div>" * 3000 + "deep, deep text."]
    df = spark.createDataFrame([(i, "u", h, "clash") for i, h in enumerate(rows)],
                               "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_model.extract(df, model).collect()}
    assert got[0].text == got[1].text == got[7].text == ""
    assert got[5].text == got[6].text == ("word, and word. " * 50000).strip()
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert html_model.extract(df.limit(0), html_model.learn(df.limit(0))).count() == 0


def test_data_y_of_a_page_is_no_label(spark):
    page = "<body><div {}>Menu</div><article><p>Text, of course.</p></article></body>"
    values = ["12px", "1", "7", ""]

    def learned(pages):
        return html_model.learn(spark.createDataFrame(list(enumerate(pages)), "page_id long, html string"))

    marked = learned([page.format(f'data-y="{v}"') for v in values])
    assert marked == learned([page.format("") for _ in values])


def test_misnested_tags():
    """The tree of tags that close others, stay open or match nothing."""
    def tree(html):
        dom = html_model.Dom(html)
        return [(dom.tag[i], dom.parent[i]) for i in range(1, len(dom.tag))]

    assert tree("<p>a<b>c<p>d<hr>e") == [("p", 0), ("b", 1), ("p", 0), ("hr", 0)]
    assert tree("<ul><li>a<b><li>c<ul><li>d</ul><li>e") == [
        ("ul", 0), ("li", 1), ("b", 2), ("li", 1), ("ul", 4), ("li", 5), ("li", 1)]
    assert tree("<table><tr><td>a<td>b<tr><th>c<table><tr><td>d") == [
        ("table", 0), ("tr", 1), ("td", 2), ("td", 2), ("tr", 1), ("th", 5), ("table", 6), ("tr", 7), ("td", 8)]
    assert tree("</b><div><span></div></span><i/><svg/><path/><a>") == [
        ("div", 0), ("span", 1), ("i", 0), ("svg", 3), ("path", 3), ("a", 3)]


@pytest.mark.parametrize("start, again", [("<div>", "</span>"), ("<b>", "<hr>"), ("<b>", "<li></li>"), ("<b>", "</i>")])
def test_many_open_elements(start, again):
    """Time in proportion to the page: 100,000 tags under 100,000 open elements (a look
    through the open ones at each tag takes minutes)."""
    began = time.monotonic()
    dom = html_model.Dom("<ul><li>" + 100_000 * start + 100_000 * again)
    assert time.monotonic() - began < 30
    assert dom.tag.count(start[1:-1]) == 100_000
