"""Pages and their main text."""

from __future__ import annotations

import pytest

from patronage.llm import html_text

ONE = " ".join(f"first{i}" for i in range(40))
TWO = " ".join(f"second{i}" for i in range(50))
AD = "buy this now"


@pytest.mark.parametrize(
    "inner",
    [
        f"<p>{ONE}</p><p>{TWO}</p>",
        f'<p class="ad">{AD}<p>{ONE}<p>{TWO}',
        f'<p>{ONE}</p><p class="notice">{AD}<div>{TWO}</div>',
        f'<ul><li class="share">{AD}<li>{ONE}<li>{TWO}</ul>',
        f'<dl><dt class="ad">{AD}<dd>{ONE}<dt class="ad">{AD}<dd>{TWO}</dl>',
        f'<table><tr class="ad"><td>{AD}<tr><td>{ONE}<td class="ad">{AD}<td>{TWO}</table>',
        f'<table><thead class="ad"><tr><td>{AD}<tbody><tr><td>{ONE}<tr><td>{TWO}</table>',
        f'<div title="a hidden gem"><p>{ONE}</p></div><p class="md:block hidden lg:flex">{TWO}</p>',
        f'<p>{ONE}</p><svg width="4" /><p>{TWO}</p><math/>',
        f"<p>{ONE}</p><svg><path d='M0'/><text>x</text></svg><p>{TWO}</p>",
        f'<p>{ONE}</p><div hidden>{AD}</div><div aria-hidden="true">{AD}</div><div style="display: none">{AD}</div><p>{TWO}</p>',
        f'<p>{ONE}</p><ul class="share"><li>{AD}<ul><li>{AD}</ul><li>{AD}</ul><p>{TWO}</p>',
    ],
)
def test_article_text_is_whole(inner):
    for page in (f"<html><body><article>{inner}</article></body></html>", f"<!doctype html><head><title>t</title><meta charset=utf-8><body><main>{inner}</main>"):
        assert html_text.main_text(page).split("\n\n") == [ONE, TWO]


@pytest.mark.parametrize("tag", ["button", "noscript", "video", "object", "select", "audio", "canvas"])
@pytest.mark.parametrize("ended", [True, False])
def test_text_of_controls_goes_and_nothing_else(tag, ended):
    """Unended ones end with their parent."""
    control = f"<{tag}>{AD}" + f"</{tag}>" * ended
    page = f"<body><article><div>{control}</div><p>{ONE}</p><p>{TWO}{f'<{tag}>{AD}</{tag}>'}</p></article></body>"
    assert html_text.main_text(page).split("\n\n") == [ONE, TWO]


@pytest.mark.parametrize("name", ["legal", "discussion", "discussions"])
def test_parts_of_an_article_by_any_subject(name):
    part = f'<section class="{name}"><p>{TWO}</p></section>'
    assert html_text.main_text(f"<article><p>{ONE}</p>{part}</article>").split("\n\n") == [ONE, TWO]
    assert html_text.main_text(f"<body><article><p>{ONE}</p></article>{part}</body>") == ONE


def test_short_page():
    assert html_text.main_text("<body><nav>a b</nav><div><h1>Title</h1><p>Five words are in here.</p></div></body>") == "Title\n\nFive words are in here."
    assert html_text.main_text("<body><nav>a b</nav><div><a href=x>only a link</a></div></body>") == ""


def test_odd_pages(spark):
    long = " ".join(f"w{i}" for i in range(300_000))
    pages = [(1, None, 5), (2, "", 5), (3, "plain words without any markup at all in this page here", 5), (4, f"<article><p>{long}</p></article>", 5),
             (5, "<" * 1000, 5), (6, "<p>" * 3000 + ONE, 5), (6, "<p>" * 3000 + ONE, 5), (7, "&amp;&#65;&bogus; " + ONE, 5), (8, "<!-- " + ONE, 5)]
    table = spark.createDataFrame([(i, "u", h, n, "x") for i, h, n in pages], "page_id long, url string, html string, words long, text string")
    found = [(r.page_id, r.text) for r in html_text.extract(table).collect()]
    texts = dict(found)
    assert len(found) == len(pages)
    assert texts[1] == texts[2] == texts[8] == "" and texts[4] == long and texts[6] == ONE
    assert texts[7] == "&A&bogus; " + ONE
    assert html_text.extract(table.limit(0)).count() == 0
