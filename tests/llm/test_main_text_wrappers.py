"""Wrappers whose class or id has a word that also names junk."""

import pytest
from test_main_text import ARTICLE, LONG, MORE, NAV, WANT, clean, page

from courtlens.llm.main_text import main_text

BODY = f"<p>{LONG}</p><p>{MORE}</p>"
COMMENTS = f"<div id=comments><article class='comment-body'><p>{LONG}{LONG}{LONG}</p></article></div>"


@pytest.mark.parametrize("names", ["class='layout has-sidebar'", "class='no-comments content'", "id=search-result-page", "class=widget"])
def test_article_inside(names):
    assert main_text(page(f"{NAV}<div {names}>{ARTICLE}<div class=share>Share, this</div></div>")) == WANT
    assert main_text(page(f"{NAV}<div {names}>{ARTICLE}{COMMENTS}</div>")) == WANT


@pytest.mark.parametrize("names", ["class='layout has-sidebar'", "class='no-comments content'", "id=search-result-page"])
def test_most_of_the_text_inside(names):
    got = main_text(page(f"{NAV}<div {names}><div>{BODY}</div></div><div class=sidebar><p>{MORE}</p></div>"))
    assert got == "\n".join([clean(LONG), clean(MORE)])


def test_named_junk_still_goes():
    assert main_text(page(ARTICLE + COMMENTS)) == WANT
    got = main_text(page(f"<div><p>{MORE}</p></div><div class=comments><p>{LONG}</p><p>{LONG}</p></div>"))
    assert got == clean(MORE)


def test_nothing_else_on_the_page():
    assert main_text(page(f"{NAV}<div class=comments>{BODY}</div>")) == "\n".join([clean(LONG), clean(MORE)])
