import random
from html.parser import HTMLParser

import duckdb
import numpy as np
import pytest

from daybook.llm import blocks_lstm as bl

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return bl.fit(spark.read.parquet(f"{FOLDER}/pages.parquet"))


class Article(HTMLParser):
    """What a page has between the tags of its article, as the standard library's parser reads it."""

    RUNNING = {"a", "b", "i", "em", "strong", "span", "br", "code", "small", "sup", "sub", "u", "img"}

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.inside, self.mute, self.blocks = 0, 0, [""]
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        self.mute += tag in ("script", "style")
        self.blocks += [] if tag in self.RUNNING else [""]
        if tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        self.blocks += [] if tag in self.RUNNING else [""]
        self.inside -= tag == "article"
        self.mute -= tag in ("script", "style")

    def handle_data(self, data):
        if self.inside and not self.mute:
            self.blocks[-1] += data


def article(page):
    blocks = [" ".join(b.split()) for b in Article(page).blocks]
    return "\n".join(b for b in blocks if b)


def test_given_pages(spark, model):
    pages = duckdb.sql(f"SELECT page_id, url, html FROM '{FOLDER}/pages.parquet'").fetchall()
    got = {r.page_id: r for r in bl.main_text(spark.read.parquet(f"{FOLDER}/pages.parquet"), model=model).collect()}
    assert len(got) == len(pages)
    right = 0
    for page_id, url, html in pages:
        r = got[page_id]
        assert (r.url, r.n_chars) == (url, len(r.text))
        right += r.text == article(html)
    assert right >= 0.99 * len(pages)


PROSE = "Anat with by of nteres atre are thnt eringing, onheed with erenenst thaner ing tionha and the by."
PAGES = [
    (
        f"<html><head><title>t</title><style>p{{}}</style></head><body><header><h1>Site</h1></header><nav><a href=x>Home</a></nav>"
        f"<main><h1>Title &amp; more</h1><p>{PROSE}<br>  next\n line</p><ul><li>an item</li></ul>"
        f"<div class='advertisement'>Buy {PROSE}</div><p>{PROSE}</p>"
        f"<section id=comments><h3>Comments</h3><p>Great! {PROSE}</p></section></main>"
        f"<aside class=sidebar><p>{PROSE}</p></aside><div class='cookie-notice'>We use cookies {PROSE}</div>"
        f"<form><label>Name</label><button>Go</button></form><footer>&copy; {PROSE}</footer><script>var a='<p>no</p>';</script></body></html>",
        ["Title & more", f"{PROSE} next line", "an item", PROSE],
    ),
    (
        f"<body><div id=top-menu><a>a</a> <a>b</a></div><div class='post-content'><h2>Head</h2><p>{PROSE}<p>{PROSE}</div>"
        f"<div class=comments>{PROSE}</div><div class=footer>x</div>",
        ["Head", PROSE, PROSE],
    ),
]


@pytest.mark.parametrize("html,blocks", PAGES)
def test_other_templates(model, html, blocks):
    page = bl.leaf_blocks(html)
    (p,) = model.label([page])
    assert [b.text for b, x in zip(page, p) if x >= 0.5] == blocks


def test_odd_pages(spark, stored, model):
    rng = random.Random(1)
    pieces = ["<p>", "</p>", "<b>", "<a href='x", "\">", "<!--", "-->", "<script>", "</div>", "<div class=ad", "&amp", "&#x1F600;", "text ", "<", ">", "é\xa0"]
    rows = [(i, "u", "".join(rng.choice(pieces) for _ in range(rng.randrange(60)))) for i in range(300)]
    rows += [(None, None, None), (1, "u", ""), (1, "u", ""), (2, "u", "<p>" * 5000), (3, "u", f"<p>{PROSE}</p>" * 3000), (4, "u", "<a b='" * 3000)]
    df = stored(rows, "page_id long, url string, html string", clash=True)
    got = bl.main_text(df, model=model).collect()
    assert len(got) == len(rows)
    assert all(r.n_chars == len(r.text) for r in got)
    assert all(r.text == "" for r in got if r.page_id is None)


def test_few_and_no_pages(stored):
    schema = "page_id long, url string, html string"
    assert bl.main_text(stored([], schema)).count() == 0
    (row,) = bl.main_text(stored([(1, "u", f"<article><p>{PROSE}</p></article>")], schema, "one")).collect()
    assert row.text == PROSE
    blank = [(1, "u", ""), (2, "u", None), (3, "u", "<script>x</script>")]
    assert bl.fit(stored(blank, schema, "blank")) is None
    assert [r.text for r in bl.main_text(stored(blank, schema, "none")).collect()] == ["", "", ""]


def test_only_long_pages(stored):
    """Pages far longer than a window are learned from, and read whole."""
    page = "<nav><a href=x>Home</a></nav><article>" + f"<p>{PROSE}</p>" * 700 + "</article><footer>foot</footer>"
    rows = [(i, "u", page + " " * i) for i in range(6)]
    got = bl.main_text(stored(rows, "page_id long, url string, html string")).collect()
    assert [r.text for r in got] == ["\n".join([PROSE] * 700)] * 6


def test_windows_cover_whole_pages():
    blocks = bl.leaf_blocks("".join(f"<p>{i} {'x' * i}" for i in range(1001)))
    found = bl._windows(blocks, 400, 50)
    assert [w[0].split()[0] for part in found for w in part] == [str(i) for i in range(1001)]
    assert {len(part) for part in found} <= {333, 334} and max(len(w[0]) for part in found for w in part) == 50


def test_parser():
    text = lambda h: [b.text for b in bl.leaf_blocks(h)]
    assert text("a<b>b</b> c<p>d<i> e</i>\n f<p>g</div>h") == ["ab c", "d e f", "g", "h"]
    assert text("x<!-- <p>no</p> -->y<script>'</p>'</script>z<textarea>no</textarea>") == ["xyz"]
    assert text("<title>no</title>&lt;p&gt; &eacute;&nbsp;&am") == ["<p> é &am"]
    assert text("<td>a<td>b<tr><td>c") == ["a", "b", "c"]
    assert [b.linked for b in bl.leaf_blocks("<li><a>ab</a>cd<li><a>x</a>")] == [0.5, 1.0]


def test_gradients():
    rng = np.random.default_rng(0)
    pages = [bl.leaf_blocks(h) for h, _ in PAGES]
    model = bl.Labeller()
    x, mask = bl.padded([bl.features([p]) for p in pages])
    label, weight = rng.integers(0, 2, mask.shape).astype(float), rng.random(mask.shape) * mask

    def loss():
        p = model.run(x, mask)[0]
        return -((label * np.log(p) + (1 - label) * np.log(1 - p)) * weight).sum() / weight.sum()

    for w, slope in zip(model.weights(), model.gradients(x, mask, label, weight)):
        for _ in range(3):
            at = tuple(rng.integers(s) for s in w.shape)
            w[at] += 1e-5
            up = loss()
            w[at] -= 2e-5
            assert (up - loss()) / 2e-5 == pytest.approx(slope[at], rel=1e-3, abs=1e-7)
            w[at] += 1e-5


def test_padding_and_order_do_not_matter(model):
    pages = [bl.leaf_blocks(h) for h, _ in PAGES] + [[]]
    together = model.label(pages)
    for page, p in zip(pages, together):
        assert np.allclose(model.label([page])[0], p)


@pytest.mark.parametrize(
    "html,blocks",
    [
        ("<article><p>one</p><svg class=\"i\"/><p>two</p><p>three</p></article>", ["one", "two", "three"]),
        ("<p>one</p><svg><p>two</p><svg><path d='x'/><text>no</text></svg><p>three", ["one", "two", "three"]),
        ("<video-player src=x></video-player><p>one</p><title-bar>two</title-bar><svg-icon/><p>three</p>", ["one", "two", "three"]),
        ("<p>if <math><mi>x</mi><mo>&lt;</mo><mn>2</mn></math> then</p>", ["if x<2 then"]),
        ("<p>see <video src=x>a film</video> <audio>a song</audio> <object>a map</object> <canvas>a plot</canvas></p>", ["see a film a song a map a plot"]),
        ("<p>one</p><noscript><p>two</p></noscript><p>three</p>", ["one", "two", "three"]),
        ("<title>no<noscript></head><p>one</p><noscript><p>two", ["one", "two"]),
        ("<div><script>var x = '<p>no'; </div><p>one</p><style>no { }</p><p>two", ["one", "two"]),
        ("a<svg><text>no</text><svg><text>no</text></svg><text>no</text></svg>b<template>no<template>no</template>no</template>c", ["abc"]),
        ("<svg/>a<svg>b</p>c<svg><text>d</text>", ["ab", "c", "d"]),
        ("<title>no</title>a<svg viewBox='0 0'><title>no</title><text>no</text></svg>b<script >no</script>c", ["abc"]),
    ],
)
def test_only_raw_elements_are_dropped(html, blocks):
    assert [b.text for b in bl.leaf_blocks(html)] == blocks
