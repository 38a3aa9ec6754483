"""Main text of pages: names, links, buttons, attributes, time, and the whole table against a plain reader."""

import sys
import time
from html.parser import HTMLParser
from pathlib import Path

import pyarrow.parquet as pq
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tessera.llm import html_extract  # noqa: E402

SF = "/root/testdata/sf0.01"
ARTICLE = "".join(f"<p>Sentence {k}, which is long enough to be prose, with commas, and it goes on &amp; on.</p>" for k in range(6))
LINES = [f"Sentence {k}, which is long enough to be prose, with commas, and it goes on & on." for k in range(6)]
OTHER = "<p>Some other prose, which is long enough, with commas, and it goes on.</p>"


def lines(page):
    return html_extract.main_text(page).split("\n")


NAMES = (
    "page-footer sidebar-content col-sidebar footer-wrap main-nav site-header pageHeader commentlist replies responses discussion user-comments leftsidebar"
    " rightSidebar advertbox adbox alert notices site-notice cookiebar related-posts relatedLinks sharebuttons social-links newsletter-signup topbar navlinks"
).split()


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("kind", ["class", "id"])
def test_named_parts_are_left_out(name, kind):
    part = f"<div {kind}='{name}'>{OTHER * 2}</div>"
    assert lines(f"<body><article>{ARTICLE}</article>{part}</body>") == LINES
    assert lines(f"<body><article>{ARTICLE}{part}</article></body>") == LINES
    assert lines(f"<body>{part}<div class='post'>{ARTICLE}</div></body>") == LINES


@pytest.mark.parametrize("name", ["no-sidebar", "content with-sidebar", "ad-free", "has-comments", "category-social", "tag-advertising", "commentary", "responsive", "shareholders", "adventure", "entry-header", "navy", "post menu-free"])
def test_names_that_only_sound_alike_leave_nothing_out(name):
    assert lines(f"<body><article>{ARTICLE}<div class='{name}'>{OTHER}</div></article></body>") == [*LINES, "Some other prose, which is long enough, with commas, and it goes on."]


def test_a_section_of_a_paper_is_no_comment():
    page = f"<main><section id=methods>{ARTICLE}</section><section id=discussion><h2>Discussion</h2>{OTHER}</section></main>"
    assert lines(page) == [*LINES, "Discussion", "Some other prose, which is long enough, with commas, and it goes on."]


@pytest.mark.parametrize("page, want", [
    ("<p title=it's>It is one's first text, which is long.</p><p>Then there's more of it.</p>", ["It is one's first text, which is long.", "Then there's more of it."]),
    ("<p data-x=a'b\"c>One \"quoted\" text's end, it's here.</p>", ["One \"quoted\" text's end, it's here."]),
    ("<p title = 'a > b' class=x>Text of one.</p>", ["Text of one."]),
    ('<p title="open>Text of one.</p><p>And more.</p>', ["Text of one.", "And more."]),
    ("<p a==b \"'>Text.</p>", ["Text."]),
    ("<a href=x/y/>link</a> and text", ["link and text"]),
])
def test_attributes(page, want):
    assert lines(page) == want


def test_links_and_buttons_inside_the_article():
    link = "<div><a href=x>This whole paragraph of the text is one link, as it happens.</a></div>"
    button = "<p>Press the <button>Save</button> key and wait for the answer.</p>"
    sources = "<ol><li><a href=1>A cited paper</a></li><li><a href=2>Another paper</a></li></ol>"
    long = "<ul><li><a href=1>The quite long title of the first cited paper</a></li><li><a href=2>The quite long title of the second paper</a></li></ul>"
    menu = "<ul><li><a href=1>Home</a></li><li><a href=2>Products</a></li></ul><p><button>Buy now</button></p>"
    want = [
        *LINES, "This whole paragraph of the text is one link, as it happens.", "Press the Save key and wait for the answer.", "A cited paper", "Another paper",
        "The quite long title of the first cited paper", "The quite long title of the second paper",
    ]
    assert lines(f"<article>{ARTICLE}{link}{button}{sources}{long}{menu}</article>") == want


BAD = {
    "unmatched ends": "<b>" * 40_000 + "</i>" * 40_000,
    "ends beyond a block": "<i><div>" + "<b>" * 20_000 + "</i>" * 20_000,
    "items in inline": "<b>" * 20_000 + "<li></li>" * 20_000,
    "items in divs": "<div>" * 20_000 + "<li></li>" * 20_000,
    "cells in lists": "<li><ul>" + "<b>" * 20_000 + "<td></td>" * 20_000,
    "rows in tables": "<table>" * 20_000 + "<tr></tr>" * 20_000,
    "open paragraphs": "<b><p>x" * 20_000,
    "open quotes": "<p>" + '<a b="' * 30_000,
    "open values": "<a b=" + "'x " * 30_000,
    "equal signs": "<a " + "= " * 100_000,
}


@pytest.mark.parametrize("name", BAD)
def test_any_page_is_read_in_linear_time(name):
    t = time.process_time()
    html_extract.main_text(BAD[name])
    assert time.process_time() - t < 4


class Plain(HTMLParser):
    """Blocks of the one article of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks, self.held = False, [], []

    def flush(self):
        text = " ".join("".join(self.held).split())
        if text:
            self.blocks.append(text)
        self.held = []

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("article", "h1", "p"):
            self.flush()
        elif tag == "br":
            self.held.append(" ")

    def handle_endtag(self, tag):
        if tag in ("article", "h1", "p"):
            self.flush()
        if tag == "article":
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.held.append(data)


def test_all_pages_of_the_table(spark):
    table = pq.read_table(f"{SF}/pages.parquet", columns=["page_id", "html"]).to_pylist()
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark.read.parquet(f"{SF}/pages.parquet")).collect()}
    assert len(got) == len(table)
    for row in table:
        plain = Plain()
        plain.feed(row["html"])
        plain.close()
        plain.flush()
        assert got[row["page_id"]] == "\n".join(plain.blocks)
