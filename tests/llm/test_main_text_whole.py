"""All of the article is kept, whatever its best part scores."""

import pytest
from test_main_text import LONG, MORE, NAV, clean, page

from courtlens.llm.main_text import main_text

BODY = f"<p>{LONG}</p><p>{MORE}</p><p>{LONG}</p><p>{MORE}</p>"
TEXT = [clean(LONG), clean(MORE)] * 2
SMALL = "<section><h2>Second</h2><p>A small one.</p></section>"


@pytest.mark.parametrize("tag", ["article", "main"])
def test_title_and_short_end_around_the_body(tag):
    got = main_text(page(f"{NAV}<{tag}><h1>Title</h1><div class=body>{BODY}</div><p>Short end.</p></{tag}>"))
    assert got == "\n".join(["Title", *TEXT, "Short end."])


def test_heading_between_two_bodies_and_a_small_section():
    got = main_text(page(f"{NAV}<article><div>{BODY}</div><h2>Between</h2><div>{BODY}</div>{SMALL}</article>"))
    assert got == "\n".join([*TEXT, "Between", *TEXT, "Second", "A small one."])


@pytest.mark.parametrize("wrap", ["<div>{}</div>", "{}"])
def test_without_article_and_main(wrap):
    inner = f"<h1>Title</h1><div>{BODY}</div><p>Short end.</p>{SMALL}"
    got = main_text(page(NAV + wrap.format(inner) + "<div><a href=/a>Some link</a> <a href=/b>and another of more words</a></div>"))
    assert got == "\n".join(["Title", *TEXT, "Short end.", "Second", "A small one."])


def test_links_and_other_articles_stay_out():
    other = "<article><h2>Other</h2><p>Teaser.</p></article>"
    got = main_text(page(f"<main><h1>Site</h1><article><h1>Title</h1><div>{BODY}</div></article>{other}</main>"))
    assert got == "\n".join(["Site", "Title", *TEXT])
