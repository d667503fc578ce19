"""HTML extraction: blocks, labels on unseen pages, odd markup, gradients."""

import numpy as np
import pytest

from hexsite.llm import html, html_train

PAGE = """<!doctype html><html><head><title>T &amp; t</title><style>p{}</style></head><body>
<header><div class=logo>Site</div><nav><ul><li><a href=/>Home</a><li><a href=/x>News</a></ul></nav></header>
<div class="cookie-notice"><p>We use cookies.</p><button>Accept</button></div>
<article><h1>A title &ndash; here</h1><p>First   paragraph with <b>bold</b>&nbsp;words
and a second line, long enough to be read.<p>Second one is unclosed, with <a href="#">a link</a> in it.
<script>var a = "<p>not text</p>";</script><!-- <p>nor this</p> --><blockquote>Somebody said something of note.</blockquote>
<p>5 &lt; 6 &#233; and it ends here.</article>
<section class="comments"><h3>Comments</h3><div class="comment"><p>Nice post!</p></div></section>
<aside class=sidebar><h3>Related articles</h3><ul><li><a href=#>Other</a></li></ul></aside>
<footer><p>&copy; 2024 Site. All rights reserved.</p></footer></body></html>"""


@pytest.fixture(scope="module")
def labeller():
    return html.Labeller(html.load())


def test_page(labeller):
    assert html.extract([PAGE], labeller, html.Hasher())[0].split("\n\n") == [
        "A title – here",
        "First paragraph with bold words and a second line, long enough to be read.",
        "Second one is unclosed, with a link in it.",
        "Somebody said something of note.",
        "5 < 6 é and it ends here.",
    ]


def test_unseen_pages(labeller):
    assert html_train.accuracy(html.load(), 150, seed=4321) > 0.985


def test_batches_change_nothing(labeller):
    found = [html.vectors(html.blocks_of(p), html.Hasher()) for p, _ in html_train.pages(12, 77)]
    together = labeller.label(found)
    assert all((a == b).all() for a, b in zip(together, [labeller.label([f])[0] for f in found], strict=True))


@pytest.mark.parametrize("page", ["", "   ", "<p>", "</p></div>", "<", "< p", "a < b > c", "<a href='x>y", "<!-- open", "<script>never closed", "&#xZZ; &nosuch; &", "<p" * 500, "<" * 3000, "<div>" * 3000, "\0\x01", '<p title="a>b">x', "<p>x<svg/>y<br/>z"])
def test_odd_markup(labeller, page):
    blocks = html.blocks_of(page)
    assert all(b.text and b.text == " ".join(b.text.split()) for b in blocks)
    html.extract([page], labeller, html.Hasher())


def test_texts_of_blocks():
    assert [b.text for b in html.blocks_of("a < b > c")] == ["a < b > c"]
    assert [b.text for b in html.blocks_of('<p title="a>b">x<p>y')] == ["x", "y"]
    assert [b.text for b in html.blocks_of("<p>x<svg/>y<br/>z")] == ["x y z"]
    assert [(b.text, b.link) for b in html.blocks_of("<ul><li><a>one</a> two<li>three</ul>")] == [("one two", 3), ("three", 0)]


def test_query(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "x"), (3, "v", "", None)]
    got = [tuple(r) for r in html.op10(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).orderBy("page_id").collect()]
    assert got[0] == got[1] and got[0][3] == len(got[0][2]) > 100
    assert got[2:] == [(2, None, "", 0), (3, "v", "", 0)]
    assert html.op10(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_gradients():
    draw = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in html_train.begin(1).items()}
    x = draw.normal(size=(4, 3, html.INPUTS))
    mask = np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 0, 0]], bool)
    label = draw.integers(0, 2, (4, 3)).astype(float)
    _, g = html_train.gradients(w, x, mask, label)
    for name in ("fx", "fh", "fb", "bx", "bh", "ob", "o"):
        at = tuple(draw.integers(0, n) for n in w[name].shape)
        step = 1e-3
        w[name][at] += step
        up, _ = html_train.gradients(w, x, mask, label)
        w[name][at] -= 2 * step
        down, _ = html_train.gradients(w, x, mask, label)
        w[name][at] += step
        assert g[name][at] == pytest.approx((up - down) / (2 * step), abs=2e-4)


def test_training_learns():
    w = html_train.train(400, 3, 20, seed=5)
    assert html_train.accuracy(w, 40, seed=6) > 0.85
