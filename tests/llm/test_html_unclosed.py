"""Odd markup around text: what is never closed, nested or empty, and pages of any length."""

import time

import numpy as np
import pytest

from hexsite.llm import html


def texts(page):
    return [b.text for b in html.blocks_of(page)]


@pytest.mark.parametrize("tag", ["math", "noscript", "object", "svg", "iframe", "noframes", "noembed", "xmp"])
def test_text_of_whatever_element_is_kept(tag):
    page = f"<p>Before it.</p><{tag} x=1><p>After it.</p><{tag}><p>The end.</p>"
    assert texts(page) == ["Before it.", "After it.", "The end."]
    assert texts(f"<p>Let <{tag}>x=5</{tag}> be given.</p><p>After it.</p>") == ["Let x=5 be given.", "After it."]


def test_templates_are_not_text():
    assert texts("<p>One.</p><template><p>gone</p><template>gone</template><p>gone</p></template><p>Two.</p>") == ["One.", "Two."]
    assert texts("<p>One.</p><template><p>Two.</p><template><p>Three.</p>") == ["One.", "Two.", "Three."]


@pytest.mark.parametrize("comment", ["<!-->", "<!--->", "<!---->", "<!-- a > b -->", "<!-- a --!>", "<!-- <p>gone</p> -->"])
def test_comments(comment):
    assert texts(f"<p>One.</p>{comment}<p>Two.</p><!-- x --><p>Three.</p>") == ["One.", "Two.", "Three."]


def test_raw_text_runs_to_the_end():
    assert texts("<p>Before it.</p><script>var a;<p>After it.</p>") == ["Before it."]
    assert texts("<p>a</p><title>b<title>c</title><p>d</p>") == ["a", "d"]
    assert texts("<p>a</p><scripted>b</scripted>") == ["a", "b"]


@pytest.fixture(scope="module")
def labeller():
    return html.Labeller(html.load())


def test_reading_in_parts_changes_nothing(labeller):
    from hexsite.llm import html_train

    hasher = html.Hasher()
    for page, _ in html_train.pages(8, 31):
        found = html.blocks_of(page)
        assert (labeller.long(found, hasher, 7) == labeller.label([html.vectors(found, hasher)])[0]).all()


def test_a_long_article_of_short_paragraphs(labeller):
    draw = np.random.default_rng(6)
    lines = [f"Word{draw.integers(10**6)} other{k}." for k in range(20_000)]
    page = "<html><body><nav><ul><li><a href=/>Home</a></ul></nav><article><h1>A title of it</h1>" + "".join(f"<p>{t}</p>" for t in lines) + "</article><footer><p>&copy; 2024 Site</p></footer></body></html>"
    got = html.extract([page], labeller, html.Hasher())[0].split("\n\n")
    assert len(set(lines) & set(got)) > 0.99 * len(lines)
    assert "© 2024 Site" not in got and "Home" not in got


def test_a_page_of_ten_megabytes(labeller):
    line = "A sentence of some words that goes on for a while and then ends here. " * 12
    page = "<article>" + f"<p>{line}</p>" * (10_000_000 // (len(line) + 7)) + "</article>"
    assert len(page) > 9_900_000
    got = html.extract([page], labeller, html.Hasher())[0]
    assert len(got) > 0.95 * len(page)


def test_deep_nesting_takes_time_in_proportion():
    start = time.time()
    assert len(html.blocks_of("<div>x" * 60_000 + "<p>y" * 20_000)) == 80_000
    assert time.time() - start < 20


# Pages written by hand, as real sites have them; each line of main text begins with "+", other text with "-".
PAGES = [
    """<!doctype html><html><head><title>-t</title></head><body class="home single"><a class="skip-link" href="#c">- Skip to content</a>
<header id="masthead"><p class="site-title"><a href="/">- The Daily Example</a></p><nav class="main-navigation"><ul><li><a href="/a">- News</a></li><li><a href="/b">- Sports</a></li></ul></nav></header>
<div id="content"><main><article class="post type-post"><header class="entry-header"><h1 class="entry-title">+ The town rebuilds its old bridge</h1></header>
<div class="entry-content"><p>+ After three years of work the bridge was opened again on Monday, to the joy of those who live beside it.</p>
<p>+ It had been closed since a flood damaged two of its piers.</p><blockquote><p>+ We waited long for this day, said the mayor.</p></blockquote>
<h2>+ What comes next</h2><ul><li>+ The road to the station is repaired in spring.</li><li>+ A path for bicycles follows.</li></ul>
<p>+ The costs came to 4.2 million, a little more than was planned.</p></div></article></main>
<section class="comments-area" id="comments"><h2>- 2 thoughts</h2><ol class="comment-list"><li class="comment"><p>- Finally! I drive there every day.</p></li></ol></section>
<aside class="sidebar widget-area"><section class="widget"><h3>- Recent posts</h3><ul><li><a href="/x">- Rain expected</a></li></ul></section></aside></div>
<footer class="site-footer"><p>- © 2024 The Daily Example. All rights reserved.</p></footer></body></html>""",
    """<html><body><div class="cookie-banner"><p>- We use cookies to improve your experience.</p><button>- Accept all</button></div>
<nav><a href="/">- Home</a> | <a href="/docs">Docs</a></nav>
<div class="article"><h1>+ How to bake bread</h1><p>+ Mix flour, water, salt and yeast, and leave the dough in a warm place for two hours.</p>
<div class="ad">- Buy our oven today and save a lot!</div><p>+ Bake it at 230 degrees for 40 minutes.</p><p>+ Let it cool before you cut it.</p></div>
<form class="newsletter"><label>- E-mail</label><input><button>- Subscribe</button></form><footer>- Imprint</footer></body></html>""",
]


def test_pages_written_by_hand(labeller):
    right = every = 0
    for page in PAGES:
        got = set(html.extract([page], labeller, html.Hasher())[0].split("\n\n"))
        for b in html.blocks_of(page):
            every += 1
            right += (b.text in got) == b.text.startswith("+")
    assert right / every >= 0.9
