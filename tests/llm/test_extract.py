import itertools
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadlens.llm import boosting, dom, extract

PROSE = [" ".join(["The river runs past the old mill, and every spring the water rises again over the road."] * k) for k in (3, 1, 4, 2)]
PAGES = {
    "plain article": (f"<html><body><nav><a href=/>Home</a> <a href=/x>News</a></nav><article><h1>Title</h1><p>{PROSE[0]}</p><p>Short.</p></article><footer>&copy; x</footer></body></html>", ["Title", PROSE[0], "Short."]),
    "divs with words": (
        f'<div id="top-nav"><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></div><div class="cookie-notice">We use cookies. <button>OK</button></div><div class="post-content"><h2>Head</h2><p>{PROSE[1]}<p>{PROSE[2]}'
        f'<aside class="advert">Buy now</aside><p>{PROSE[3]}</div><div class="sidebar"><h3>Popular</h3><a href=c>More</a></div><div id="comments"><p>{PROSE[1]}</p></div>',
        ["Head", PROSE[1], PROSE[2], PROSE[3]],
    ),
    "main with form": (f"<header><h1>Site</h1></header><main><p>{PROSE[0]}</p><form><input name=q>Subscribe</form><ul><li>first point<li>second point</ul></main>", [PROSE[0], "first point", "second point"]),
    "silent parts": (f"<article><style>p{{}}</style><script>var t='</p>'; a<b;</script><p>A &lt;b&gt; &amp; c&nbsp;d</p><noscript>no</noscript><!-- <p>x</p> --><p>{PROSE[1]}</p></article>", ["A <b> & c d", PROSE[1]]),
}


@pytest.fixture(scope="module")
def trees(spark):
    from conftest import FOLDER

    return extract.learn(spark.read.parquet(f"{FOLDER}/pages.parquet"))


@pytest.mark.parametrize("name", PAGES)
def test_main_text(trees, name):
    html, want = PAGES[name]
    assert extract.main_texts([dom.read(html)], trees)[0].split("\n\n") == want


def test_pages_without_signs_keep_their_prose(trees):
    html = f"<body><div><a href=a>One</a> <a href=b>Two</a> <a href=c>Three</a></div><div><p>{PROSE[0]}</p><p>{PROSE[2]}</p></div></body>"
    assert PROSE[0] in extract.main_texts([dom.read(html)], trees)[0]


def test_given_pages(spark, trees):
    from conftest import FOLDER

    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    got = {r.page_id: r for r in extract.extract(pages, trees).collect()}
    for r in pages.collect():
        page = dom.read(r.html)
        inside = np.zeros(len(page.tags), bool)
        for i, tag in enumerate(page.tags):
            if tag == "article":
                inside[i : page.ends[i]] = True
        assert got[r.page_id].text == dom.joined(page, inside & ~dom.silent(page)) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_trees_and_blocks():
    page = dom.read("<p>a<b>b<br>c</p>d<ul><li>e<li>f</ul><table><tr><td>g<td>h</table>i")
    assert dom.joined(page, np.ones(len(page.tags), bool)).split("\n\n") == ["ab c", "d", "e", "f", "g", "h", "i"]
    for i, end in enumerate(page.ends):
        assert end > i and all(page.parents[j] >= i for j in range(i + 1, end))


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<html><head><title>T</title><meta charset=x><body><p>a</p></html>", "a"),
        ("<head><link rel=x><p>a</p>", "a"),
        ("<head><title>T</title>\n a", "a"),
        ("<head><style>x</style><noscript>n</noscript></head><p>a</p>", "a"),
        ("<p>a</p><noscript><p>b</p>", "a\n\nb"),
        ("<p>a</p><iframe src=x><p>b</p><template><p>c</p><IFRAME>", "a\n\nb\n\nc"),
        ("<p>a</p><noscript>n</noscript><p>b</p><script>x<p>c</p>", "a\n\nb"),
    ],
)
def test_open_heads_and_raw_elements_without_an_end(trees, html, want):
    page = dom.read(html)
    assert dom.joined(page, ~dom.silent(page)) == want
    if "<p>a" in html:
        assert PROSE[0] in extract.main_texts([dom.read(html.replace("<p>a", f"<p>{PROSE[0]}"))], trees)[0]


@pytest.mark.parametrize("seed", range(20))
def test_decoding_like_brute_force(seed):
    rng = random.Random(seed)
    html = "".join(rng.choice(["<div>", "</div>", "<p>", "x", "<span>", "</span>"]) for _ in range(10))
    nodes = extract.Nodes([dom.read(html)])
    n = len(nodes.tags)
    logit = np.array([rng.gauss(0, 2) for _ in range(n)])
    yes, no = -np.logaddexp(0, -logit), -np.logaddexp(0, logit)
    best = None
    for labels in itertools.product([0, 1], repeat=n - 1):
        labels = (1, *labels)
        if all(labels[int(nodes.parent[i])] >= labels[i] for i in range(1, n)):
            score = sum((yes if v else no)[i] for i, v in enumerate(labels) if i)
            best = max(best or (-1e18, ()), (score, labels))
    assert tuple(nodes.decode(logit).astype(int)) == best[1]


def test_boosting_learns_a_rule():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = boosting.fit(x[:2000], y[:2000])
    assert ((model.logit(x[2000:]) > 0) == (y[2000:] > 0)).mean() > 0.95
    one = boosting.fit(x[:50], np.ones(50))
    assert (one.logit(x) > 0).all()


@pytest.mark.parametrize("html", ["<" * 200_000, "<a href=\"" * 50_000, "<div>" * 50_000 + "x", "<p>" * 100_000, "</p>" * 100_000, "<!--" * 100_000, "<script>" * 50_000, "<b>x</i>" * 50_000, "<li>" * 60_000, "&" * 200_000, "a < b " * 200_000, "<div class='" + "a " * 100_000 + "'>x"])
def test_hostile_pages_end(trees, html):
    begin = time.perf_counter()
    extract.main_texts([dom.read(html)], trees)
    assert time.perf_counter() - begin < 30


def test_end_tags_in_capitals_and_letters_that_grow_when_lowered():
    for letter in "İI":
        page = dom.read(f"<head><script>var a = 1;</SCRIPT><STYLE>p {{}}</Style></head><body><p>{letter}stanbul is a city.</p></body>")
        assert dom.joined(page, ~dom.silent(page)) == f"{letter}stanbul is a city."


def test_formulas_and_lone_signs_stay():
    page = dom.read("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> and a < b < c, d <e>.</p></article>")
    assert dom.joined(page, ~dom.silent(page)) == "Let x=2 and a < b < c, d ."


def test_odd_rows(spark, trees):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "no tags"), (3, "u", "no tags"), (None, "u", PAGES["plain article"][0]), (4, "u", "<article><p>" + PROSE[0] * 3000 + "</p></article>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit(1)).withColumn("n_chars", F.lit("x"))
    got = extract.extract(pages, trees).collect()
    assert len(got) == 6 and {r.text for r in got if r.page_id in (1, 2)} == {""}
    assert [r.n_chars for r in got if r.page_id == 4] == [len(" ".join((PROSE[0] * 3000).split()))]
    assert extract.extract(pages.limit(0), trees).count() == 0
    none = extract.learn(pages.limit(0))
    assert [r.text for r in extract.extract(pages.where("page_id IS NULL"), none).collect()] == ["Home News\n\nTitle\n\n" + PROSE[0] + "\n\nShort.\n\n© x"]
