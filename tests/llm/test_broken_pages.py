"""Main text of pages whose markup is broken, odd or very long."""

from __future__ import annotations

import time

import pytest

from earshot.llm.main_text import blocks, main_text

TEXT = "the house of the king stands on a hill and all of us have been to it in the summer " * 2
WANT = " ".join(TEXT.split())


@pytest.mark.parametrize(
    "page",
    [
        f"<article><p title=it's>{TEXT}</p></article>",
        f'<article><p data-x=5">{TEXT}</p></article>',
        f"<article><p class=\"a\"id='b'data-q=\"x>y\">{TEXT}</p></article>",
        f'<article><p data-x = "a > b" >{TEXT}</p></article>',
        f"<article><p a=b=c\"d>{TEXT}</p></article>",
        f'<div data-hidden="1" x-hidden aria-hidden=false><article><p>{TEXT}</p></article></div>',
        f"<article><p>{TEXT}</p></article><!-- left open <p>not this</p>",
        f"<!----><!-->{''}<article><p>{TEXT}</p></article>",
        f"<?xml version='1.0'?><!DOCTYPE html><article><p>{TEXT}</p></article>",
    ],
)
def test_text_is_neither_lost_nor_markup_shown(page):
    assert main_text(page) == WANT


def test_a_stray_quote_does_not_swallow_the_next_paragraph():
    page = f"<article><p title=it's>one {TEXT}</p><p>didn't {TEXT}</p><p>three {TEXT}</p></article>"
    assert main_text(page) == f"one {WANT} didn't {WANT} three {WANT}"


def test_a_value_left_open_to_the_end_hides_one_tag():
    page = f'<article><p>{TEXT}</p><p title="open>more {TEXT}</p></article>'
    assert main_text(page) == f"{WANT} more {WANT}"


@pytest.mark.parametrize("how", ["hidden", 'hidden=""', "HIDDEN", "hidden='until-found'"])
def test_hidden_elements_stay_hidden(how):
    assert main_text(f"<article><p>{TEXT}</p><div {how}><p>not {TEXT}</p></div></article>") == WANT


def test_a_link_in_an_article_inherits():
    link = "<p><a href=x>The whole of this sentence is a link to another page of ours</a></p>"
    page = f"<article><p>{TEXT}</p>{link}<p>{TEXT}</p></article>"
    middle = "The whole of this sentence is a link to another page of ours"
    assert main_text(page) == f"{WANT} {middle} {WANT}"


def test_links_around_blocks_are_links():
    cards = "".join(f"<a href=x><div><h3>Card {i}</h3><p>{TEXT}</p></div></a>" for i in range(6))
    assert main_text(f"<body>{cards}</body>") == ""
    assert main_text(f"<body><p>plain {TEXT}</p>{cards}</body>") == f"plain {WANT}"


def test_a_link_left_open_ends_with_its_block():
    page = f"<article><p><a href=x>{TEXT}</p><p>{TEXT}</p><p><a href=y>short</a></p></article>"
    found = blocks(page)
    assert [bool(b.link_chars) for b in found] == [True, False, True]


@pytest.mark.parametrize("tail", ["", ">", '"', "'>\""])
@pytest.mark.parametrize(
    "unit, n",
    [
        ("<a ", 333_000),
        ("<! ", 333_000),
        ('<a x="', 100_000),
        ("<a x='\"", 100_000),
        ("<!--", 200_000),
        ("<script", 100_000),
        ("<title/>", 100_000),
        ("<p title=it's>", 60_000),
    ],
)
def test_a_megabyte_of_broken_markup_is_quick(unit, n, tail):
    start = time.process_time()
    main_text(unit * n + tail)
    assert time.process_time() - start < 3


def test_end_tags_without_a_beginning_are_quick_under_deep_nesting():
    start = time.process_time()
    main_text("<section>" * 20_000 + "</nav>" * 20_000 + TEXT)
    assert time.process_time() - start < 3
