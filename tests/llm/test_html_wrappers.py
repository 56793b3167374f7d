"""Main text: attribute words around the article, and short or link-only blocks inside it."""

import pytest

from faultline.llm import html_text

STORY = "It was a long day and the river had not moved. "
LINKS = "<ul><li><a>One</a><li><a>Two</a><li><a>Three</a><li><a>Four</a></ul>"


@pytest.mark.parametrize("name", ["wrap has-sidebar", "no-sidebar", "ad-free", "has-comments", "sidebar", "page-form"])
@pytest.mark.parametrize("inner", ["article", "main", "section"])
def test_wrappers_of_the_text_are_not_aside(name, inner):
    page = f"<div class='{name}'><{inner}><p>{STORY * 4}</p></{inner}></div><div class='related'><p>{STORY}</p></div>"
    assert html_text.main_text(page) == (STORY * 4).strip()


@pytest.mark.parametrize("attribute", ["data-src='/img/hidden-lake.jpg'", "title='hidden places'", "data-x='class=ad'"])
def test_words_in_other_attributes_do_not_count(attribute):
    assert html_text.main_text(f"<article {attribute}><p>{STORY * 4}</p></article>") == (STORY * 4).strip()
    assert html_text.main_text(f"<body><p>{STORY}</p><p hidden>{STORY}</p></body>") == STORY.strip()


def test_short_opening_and_closing_paragraphs_stay():
    gap = "<form><p>a</p><p>b</p><p>c</p><p>d</p></form>"
    page = f"<div><p>Short start.</p>{gap}<p>{STORY * 20}</p>{gap}<p>Short end.</p></div>"
    assert html_text.main_text(page) == f"Short start. {(STORY * 20).strip()} Short end."


def test_link_only_blocks_inside_stay():
    links = "One Two Three Four"
    assert html_text.main_text(f"<article><p>{STORY}</p>{LINKS}<p>{STORY}</p>{LINKS}</article>") == f"{STORY}{links} {STORY}{links}"
    assert html_text.main_text(f"<div><p>{STORY}</p>{LINKS}<p>{STORY}</p></div>") == f"{STORY}{links} {STORY.strip()}"


def test_deep_pages_take_linear_time():
    for piece in ("<div>x", "<div class=ad>x", "<article class=ad>x"):
        html_text.main_text(piece * 20_000)
