"""Main text: the driver's pages against their marked articles, other layouts, and broken markup."""

import html
import re

import pytest

from faultline.llm import html_text
from faultline.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"
STORY = "It was a long day and the river had not moved. "


def article(page):
    inside = re.search(r"<article>(.*?)(</article>|<footer>|\Z)", page, re.S)
    blocks = re.sub(r"</?b>", "", inside[1])
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", blocks)).split())


def test_query_finds_marked_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    got = QUERIES["op8_html_text"](spark, DATA).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.url == pages[r.page_id].url and r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text)


CASES = {
    "inline": ("<div>a <b>b</b>c<br>d &amp; &#8212;&nbsp;e</div>", "a bc d & — e"),
    "plain": ("no markup  at\nall", "no markup at all"),
    "empty": ("", ""),
    "scripts": ("<p>" + STORY * 3 + "<script>if (a < b) { x('<p>no</p>') }</script><style>p{}</style></p>", (STORY * 3).strip()),
    "link list": ("<ul><li><a href=x>Home page of all</a><li><a>Two</a></ul><div><p>" + STORY * 5 + "<p>Short.<p>" + STORY * 4 + "</div>", f"{(STORY * 5).strip()} Short. {(STORY * 4).strip()}"),
    "comments": ("<main><h1>Head</h1><p>" + STORY * 4 + "</p><section class='reader-comments'><p>" + STORY * 6 + "</p></section></main>", f"Head {(STORY * 4).strip()}"),
    "around": (
        "<header><h1>Site name</h1><p>" + STORY + "</p></header><div id='cookie-notice'>" + STORY * 2 + "</div><div id=content><h2>Title</h2><p>" + STORY * 3
        + "</p><p>Ok.</p></div><div class='sidebar right'>" + STORY * 3 + "</div><form><p>" + STORY + "</form><footer>" + STORY + "</footer>",
        f"Title {(STORY * 3).strip()} Ok.",
    ),
    "broken": ("<p class='x>" + "<div><p>" + STORY + "<!-- never closed " + STORY, STORY.strip()),
    "cut tag": ("<article><p>" + STORY + "</p><p>more <a href='x", STORY.strip() + " more"),
    "less than": ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_layouts(case):
    page, want = CASES[case]
    assert html_text.main_text(page) == want


def test_awkward_pages_take_linear_time():
    for piece in ("<!--", "<p ", "<", "<a href='", "<div>", "</p>", "<b>x", "&", "<script>"):
        html_text.main_text(piece * 20_000)


def test_edge_rows(spark):
    rows = [(1, None, None), (2, "u", ""), (2, "u", ""), (None, "v", "<p>Text.</p>"), (3, "w", "<p>" + STORY * 5_000)]
    pages = spark.createDataFrame([(*r, "clash", 5) for r in rows], "page_id bigint, url string, html string, text string, n_chars int")
    got = {(r.page_id, r.url, r.n_chars) for r in html_text.extracted(pages).collect()}
    assert got == {(1, None, 0), (2, "u", 0), (None, "v", 5), (3, "w", len((STORY * 5_000).strip()))}
    assert html_text.extracted(pages.limit(0)).count() == 0
