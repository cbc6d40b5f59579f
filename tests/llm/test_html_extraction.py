"""Main text of written pages, held-out accuracy on labelled pages, robustness of the reader."""

from __future__ import annotations

import itertools
import math
import random
import time

import pytest

from tidemark.llm.html_blocks import Block, read_blocks
from tidemark.llm.html_extraction import (
    _gradient, _scores, block_features, decode, default_weights, extract_main_text, fit, main_text,
)
from tidemark.llm.labelled_pages import CONTENT_MARK, labelled_pages

LONG = "The committee met on Tuesday and agreed, after some debate, that the bridge should be rebuilt in stone."

PAGES = {
    "article with everything around it": (
        f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>
        <header><a href=/>Site</a><p>Tagline of the site.</p></header><nav><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav>
        <div class="cookie-notice"><p>We use cookies to improve this site. {LONG}</p><button>OK</button></div>
        <article><h1>Bridge &amp; road</h1><p>{LONG}</p><div class="ad"><p>Buy our bricks today, they are good bricks.</p></div>
        <p>Second&nbsp;paragraph\n   with <b>bold</b> and <a href=x>a link</a>.<ul><li>One item here</li><li>Another item here</li></ul>
        <aside><h3>Related</h3><p>{LONG}</p></aside></article>
        <section id="comments"><h2>Comments</h2><div class="comment"><p>I liked this. {LONG}</p></div></section>
        <form><p>Subscribe to our letter for more of this.</p><input><button>Go</button></form>
        <div class="sidebar"><p>{LONG}</p></div><footer>&copy; 2020 Site. All rights reserved.</footer><script>var a = "<p>no</p>";</script></body></html>""",
        ["Bridge & road", LONG, "Second paragraph with bold and a link.", "One item here", "Another item here"],
    ),
    "comments and forms inside the article": (
        f"""<body><main><article><header><h1>Title here</h1></header><p>{LONG}<p>Short end.
        <div id="reader-comments"><article class="comment"><p>{LONG}</p></article></div>
        <form class="newsletter"><label>Mail</label></form></article></main></body>""",
        ["Title here", LONG, "Short end."],
    ),
    "no article element": (
        f"""<body><div id="menu"><a href=1>One</a> | <a href=2>Two</a></div><div class="content"><h2>Head line</h2>
        <p>{LONG}</p><p>{LONG}</p></div><div id="footer"><p>Imprint and contact</p></div></body>""",
        ["Head line", LONG, LONG],
    ),
}


@pytest.mark.parametrize("name", list(PAGES))
def test_pages(name):
    page, blocks = PAGES[name]
    assert main_text(page, default_weights()) == "\n".join(blocks)


def test_held_out_pages():
    wrong = blocks_seen = whole = 0
    for page in labelled_pages(150, seed=99):
        blocks = read_blocks(page)
        labels = [int(b.text.startswith(CONTENT_MARK)) for b in blocks]
        found = decode([b._replace(text=b.text.replace(CONTENT_MARK, "")) for b in blocks], default_weights())
        errors = sum(a != b for a, b in zip(labels, found))
        wrong, blocks_seen, whole = wrong + errors, blocks_seen + len(blocks), whole + (errors == 0)
    assert wrong / blocks_seen < 0.01 and whole >= 0.94 * 150


def test_chain_carries_more_than_single_blocks():
    weights = default_weights()
    assert weights["near:11"] > weights["near:10"]
    assert fit([]) == {} and decode([], weights) == []


@pytest.mark.parametrize(
    "page, texts",
    [
        ("", []), ("plain", ["plain"]), ("a < b and 3 > 2", ["a < b and 3 > 2"]), ("<p>a<br>b<p>c", ["a b", "c"]),
        ("<p>x &lt;b&gt; &#233; &amp;amp;", ["x <b> é &amp;"]), ("<!-- <p>no</p> -->y<script>if (a<b) {}</script>z", ["yz"]),
        ('<div title="a > b">t</div>', ["t"]), ("<div title='x>t</div>", ["t"]), ("</p></div>t", ["t"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"]), ("<ul><li>a<ul><li>b</ul><li>c</ul>", ["a", "b", "c"]),
        ("<script>never closed <p>x", []), ("<P>A</P><Div>B</dIV>", ["A", "B"]), ("w<b>or</b>d", ["word"]), ("   ", []),
        ("<head><title>t</title><body>b", ["b"]), ("<p>before</p><canvas/><p>after", ["before", "after"]),
        ("<video src=x><p>after", ["after"]), ("<svg><svg>x</svg>y</svg>z", ["z"]), ("<title>t<p>rest", ["t", "rest"]),
        ("<template><template>a</template>b</template>c", ["c"]), ("<svg>a</svg><svg/>b<svg>c</svg>d", ["bd"]),
        ("<script src=x />a</script>b", ["b"]), ('<a title=\'">\' b>t</a>', ["t"]), ("a<!b", ["a<!b"]), ("a<p<!-- x", ["a<p"]),
        ("<p x='a>b", ["b"]), ("<ul><li><ul></li>a</ul>b</ul>c", ["a", "b", "c"]), ("<head>x", ["x"]), ("<", ["<"]),
    ],
)
def test_blocks(page, texts):
    assert [b.text for b in read_blocks(page)] == texts


def test_deep_and_long_pages_are_read():
    assert len(read_blocks("<div>" * 3000 + "x" + "</div>" * 3000)) == 1
    assert len(read_blocks("<p>a" * 50_000)) == 50_000
    assert [b.text for b in read_blocks('<a href="' * 2000)][0].startswith("<a")


@pytest.mark.parametrize(
    "page",
    [
        "<p" * 100_000, "<a " * 100_000, "<a " * 100_000 + ">", "<p x='" * 50_000 + ">", "<a \"<b '>" * 50_000, "<!-" * 100_000,
        "<svg>" * 50_000 + "</svg>", "<svg " * 50_000, "<head>" * 50_000, "</script" * 50_000 + "<script>" * 50_000,
        "<div>" * 50_000 + "</p>" * 50_000, "<ul><li><ul>" + "<nav>" * 50_000 + "</li>" * 50_000, "&" * 200_000,
        "<a b=\"" + "<a b=\">\"" * 50_000 + "'", "<p id=" + " id" * 100_000 + ">x", "<a '\">" * 50_000 + "'",
    ],
)
def test_odd_pages_take_time_in_proportion_to_their_length(page):
    began = time.perf_counter()
    read_blocks(page)
    assert time.perf_counter() - began < 5


def chain_score(blocks, labels, weights):
    units, steps = _scores(blocks, weights)
    return sum(u for u, y in zip(units, labels) if y) + sum(s[2 * a + b] for s, a, b in zip(steps, labels, labels[1:]))


def random_chains(seed, lengths=range(1, 10)):
    rng = random.Random(seed)
    for n in lengths:
        blocks = [Block("w" * rng.randint(1, 9), rng.choice(["p", "li"]), frozenset(rng.sample("abcd", 2)), 0, rng.randint(0, 1)) for _ in range(n)]
        names = {f for b in blocks for f in block_features(b)} | {f"{k}:{x}{y}" for k in ("near", "far") for x in (0, 1) for y in (0, 1)}
        yield blocks, {f: rng.uniform(-2, 2) for f in sorted(names)}, [rng.randint(0, 1) for _ in blocks]


@pytest.mark.parametrize("seed", range(5))
def test_viterbi_equals_enumeration_of_all_chains(seed):
    for blocks, weights, _ in random_chains(seed):
        best = max(itertools.product((0, 1), repeat=len(blocks)), key=lambda y: chain_score(blocks, y, weights))
        assert chain_score(blocks, decode(blocks, weights), weights) == pytest.approx(chain_score(blocks, best, weights))
        assert tuple(decode(blocks, weights)) == best


@pytest.mark.parametrize("seed", range(3))
def test_gradient_equals_differences_of_the_likelihood(seed):
    def likelihood(blocks, labels, weights):
        total = math.log(sum(math.exp(chain_score(blocks, y, weights)) for y in itertools.product((0, 1), repeat=len(blocks))))
        return chain_score(blocks, labels, weights) - total

    for blocks, weights, labels in random_chains(seed, range(1, 6)):
        slopes = _gradient(blocks, labels, weights)
        for name in weights:
            up, down = ({**weights, name: weights[name] + h} for h in (1e-5, -1e-5))
            difference = (likelihood(blocks, labels, up) - likelihood(blocks, labels, down)) / 2e-5
            assert slopes.get(name, 0.0) == pytest.approx(difference, abs=5e-4)


def test_table(spark):
    page = PAGES["no article element"][0]
    rows = [(1, "u", page, "old", 5, 9), (1, "u", page, "old", 5, 9), (2, None, None, None, None, None), (None, "u", "", "x", 1, 2)]
    df = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int, extra int"))
    assert df.columns == ["page_id", "url", "extra", "text", "n_chars"]
    found = sorted(map(tuple, df.collect()), key=str)
    text = "\n".join(PAGES["no article element"][1])
    assert found == sorted([(1, "u", 9, text, len(text))] * 2 + [(2, None, None, "", 0), (None, "u", 2, "", 0)], key=str)
    assert extract_main_text(df.sparkSession.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_given_pages_keep_their_article(spark):
    import re

    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        want = [b.text for b in read_blocks(inner)]
        assert main_text(r["html"], default_weights()) == "\n".join(want)
