from __future__ import annotations

import html
import re

import pytest
from brute import SMALL, frame  # noqa: F401

from tillroll.llm import pages

SCHEMA = "page_id long, url string, html string, text string, host string, path string"
MENU = '<nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="ad">Buy now, a long advert text. </div>'
BODY = "<p>First &amp; <b>bold</b>ly&nbsp;said.</p>\n<p>Second   paragraph<br>goes on.</p>"


def page(article, around=MENU):
    return f'<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{around}{article}<footer>&copy; us</footer></body></html>'


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain words only", "plain words only"),
        (page(f"<article><h1>Title</h1>{BODY}</article>"), "Title First & boldly said. Second paragraph goes on."),
        (page("<article><h1>A</h1><p><b>open<br><p>next</p></article>"), "A open next"),
        (page("<article><p>cut off in the mid").split("<foot")[0] + "</artic", "cut off in the mid"),
        (page(f'<main><div class="post-12">{BODY}</div><div class="comments"><p>{"Reader says. " * 40}</p></div></main>'), "First & boldly said. Second paragraph goes on."),
        (page(f'<div id="sidebar"><p>{"Side text. " * 30}</p></div><div class="content">{BODY}</div>'), "First & boldly said. Second paragraph goes on."),
        (page(f'<article>{BODY}<aside>More</aside><form>Name <input></form><script>var a="</p>";</script><!-- no <p>x</p> --></article>'), "First & boldly said. Second paragraph goes on."),
        (page(f'<div class="cookie-notice">We use cookies. {"x " * 90}</div><section>{BODY}</section>'), "First & boldly said. Second paragraph goes on."),
        (page("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table><pre>x\n y</pre></article>"), "one two a b x y"),
        (page("<article><p>1 &lt; 2 &#x41;&#66; a < b</p></article>"), "1 < 2 AB a < b"),
        ("<nav>menu</nav><script>x()</script>", ""),
        (page(f'<div id="page" class="has-sidebar no-ads"><div class="text">{BODY}</div></div>'), "First & boldly said. Second paragraph goes on."),
        (page(f'<div class="sidebar-page">{BODY}</div>', ""), "First & boldly said. Second paragraph goes on."),
        (page(f'<article>{BODY}<article class="comment"><p>{"I say so. " * 50}</p></article></article>'), "First & boldly said. Second paragraph goes on."),
        (page(f'<div class="cookiebar"><p>{"We bake. " * 50}</p></div><article class="comment">{BODY}</article>'), "First & boldly said. Second paragraph goes on."),
        ("<p" * 2000, ""),
        ("<div>" * 3000 + "deep text", "deep text"),
    ],
)
def test_single_pages(source, text):
    parsed = pages.parse(source)
    best = pages.best_container(parsed)
    own = None if best is None else parsed.paths[best]
    assert pages.extract(source, own) == text == pages.extract(source, "no such path")


@pytest.mark.parametrize("mark", ['<svg class="i"/>', "<svg/>", "<math />", "<svg-icon></svg-icon>", "<title-bar>", "<svg><title>no</title></svg>"])
def test_only_raw_elements_are_swallowed(mark):
    assert pages.extract(page(f"<article><p>One {mark} two.</p><p>Three.</p></article>"), None) == "One two. Three."


@pytest.mark.parametrize(
    "tag", ["<p data-x=it's>", '<p title=5" class=a>', "<p x='a>b'>", '<p x="it\'s">', "<p a=1 b>", '<p "x">', "<p a = 'q' b>"]
)
def test_attributes_are_read_as_browsers_do(tag):
    source = page(f'<article>{tag}One said.</p><p>Two "quoted" words.</p></article>')
    assert pages.extract(source, None) == 'One said. Two "quoted" words.'


@pytest.mark.parametrize("name", ["market-share", "search-engines", "related-work", "notice-period", "entry-header", "post category-advertising", "no-ads", "data-sidebar-x"])
def test_names_that_only_hold_a_mark_stay(name):
    for attribute in ("class", "id"):
        source = page(f'<article><div {attribute}="{name}"><p>One said.</p></div><p>Two more.</p></article>')
        assert pages.extract(source, None) == "One said. Two more."


@pytest.mark.parametrize("name", ["share", "share-buttons", "related-posts", "comments-area", "wp-block-comments", "cookie-notice", "social-media", "sidebar left", "x search-form"])
def test_marks_go(name):
    source = page(f'<article><p>One said.</p><div class="{name}"><p>Not this.</p></div><p>Two more.</p></article>')
    assert pages.extract(source, None) == "One said. Two more."


@pytest.mark.parametrize("tag", ["<div hidden>", '<div class="a" hidden="">', "<p hidden>", '<div style="color:red; display: none">', "<div style='display:none'>", "<section STYLE=display:none>"])
def test_hidden_elements_go(tag):
    end = f"</{tag[1:].split()[0].rstrip('>')}>"
    source = page(f"<article><p>One said.</p>{tag}Not this.{end}<p>Two more.</p></article>")
    assert pages.extract(source, None) == "One said. Two more."


def test_names_and_values_that_hide_nothing():
    source = page('<article><p class="x hidden-gem">One said.</p><p data-a="is hidden now">Two.</p><p title="display:none">Three.</p><h1 class="header-title">Four</h1></article>')
    assert pages.extract(source, None) == "One said. Two. Three. Four"


LONG = "<p>" + "Long body text. " * 30 + "</p>"


@pytest.mark.parametrize(
    ("source", "starts", "ends"),
    [
        (f'<article><h1>Title</h1><p class="lead">Lead.</p><div class="entry-content">{LONG}</div><p>End.</p></article>', "Title Lead. Long", "End."),
        (f'<article><section class="a">{LONG}</section><section class="b"><p>Other part.</p></section></article>', "Long", "Other part."),
        (f"<article><p>Before.</p><ul><li>{'item ' * 90}</li></ul><p>After.</p></article>", "Before. item", "After."),
        (f'<main><h1>Title</h1><div class="text">{LONG}</div><div class="related"><p>Not this.</p></div></main>', "Title Long", "text."),
        (f'<div class="post"><h1>Title</h1><div class="text">{LONG}</div><div class="more"><p>Teaser.</p></div></div>', "Title Long", "text."),
    ],
)
def test_the_article_is_taken_whole(frame, source, starts, ends):
    rows = [(i, f"http://h.org/{i}", page(source), "c", "c", "c") for i in range(2)]
    for r in pages.main_texts(frame(rows, SCHEMA)).collect():
        assert r.text.startswith(starts) and r.text.endswith(ends)


def test_host_decides_against_a_single_page(frame):
    usual = page(f'<div class="story-1">{BODY}</div><div class="more"><p>short</p></div>')
    odd = page(f'<div class="story-77"><p>tiny</p></div><div class="more"><p>{"long teaser text " * 9}</p></div>')
    rows = [(i, f"http://H.org/{i}", usual, "c", "c", "c") for i in range(5)]
    rows += [(9, "http://h.org/9", odd, "c", "c", "c"), (10, "https://other.org/", odd, "c", "c", "c")]
    rows += [(11, None, odd, "c", "c", "c"), (None, "http://h.org/x", None, "c", "c", "c"), rows[0]]
    got = pages.main_texts(frame(rows, SCHEMA))
    texts = [(r.page_id, r.text) for r in got.collect()]
    assert len(texts) == len(rows)
    by_id = dict(texts)
    assert by_id[0] == "First & boldly said. Second paragraph goes on."
    assert by_id[9] == "tiny" and by_id[10].startswith("long teaser") and by_id[11].startswith("long teaser")
    assert by_id[None] == ""


def test_empty_table(frame):
    assert pages.main_texts(frame([], SCHEMA)).count() == 0


def test_given_pages(spark):
    table = spark.read.parquet(f"{SMALL}/pages.parquet")
    got = {r.page_id: r.text for r in pages.main_texts(table).collect()}
    for r in table.collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        assert got[r.page_id] == " ".join(html.unescape(re.sub(r"<[^>]*(>|$)", " ", inner)).split())
