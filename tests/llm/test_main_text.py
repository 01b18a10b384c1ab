import pytest

from courtlens.llm.main_text import extract_main_text, main_text

LONG = "This sentence is part of an article, it has some commas, and it says a little about nothing. " * 3
MORE = "Another paragraph follows the first one, again with commas, clauses, and words of no meaning. " * 2


def clean(text):
    return " ".join(text.split())


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{body}</body></html>"


NAV = "<nav><ul>" + "".join(f"<li><a href='/{i}'>Menu {i}</a></li>" for i in range(9)) + "</ul></nav>"
ARTICLE = f"<article><h1>Head &amp; line</h1><p><b>{LONG}<br><p>{MORE}</p><ul><li>one</li><li>two</li></ul></article>"
WANT = "\n".join(["Head & line", clean(LONG), clean(MORE), "one", "two"])

SAME = {
    "menus, adverts and footers": f"{NAV}<div class='ad'>Buy, now, this, thing</div>{ARTICLE}<footer>&copy; all</footer>",
    "unclosed at the end": f"{NAV}{ARTICLE}<footer>&copy; cut o",
    "sidebars": f"<div id=sidebar><p>{MORE}</p><p>{MORE}</p></div>{ARTICLE}<aside><p>{LONG}</p></aside>",
    "comments": ARTICLE + f"<section class='user comments'><p>{LONG}</p><p>{LONG}</p><p>{MORE}</p></section>",
    "forms and notices": f"<div class=cookie-notice><p>{MORE}</p></div><form><p>{MORE}</p><input></form>{ARTICLE}",
    "markup comments": f"<!-- <p>{LONG}</p> -->{ARTICLE}<!-- open",
    "hidden": f"<div style='display: none'><p>{LONG}</p></div><div hidden><p>{LONG}</p></div>{ARTICLE}",
    "upper case": f"{NAV.upper()}{ARTICLE.replace('<p>', '<P>').replace('article>', 'ARTICLE>')}",
    "noise between": f"{NAV}<p>x</p></div></span></p>{ARTICLE}",
}


@pytest.mark.parametrize("name", SAME)
def test_article_alone(name):
    got = main_text(page(SAME[name]))
    assert got.removeprefix("x\n") == WANT


def test_without_semantic_elements():
    body = f"<div class=top><a href=/>Home</a> <a href=/b>Other</a></div><div><div><p>{LONG}</p><p>{MORE}</p></div></div><div><ul><li><a href=/c>Links, links, links</a></li></ul></div>"
    assert main_text(page(body)) == "\n".join([clean(LONG), clean(MORE)])


def test_parts_inside_the_article_that_do_not_belong():
    body = f"<article><p>{LONG}</p><div class='share'>Share this</div><script>x</script><p>{MORE}</p><ul><li><a href=1>See also one</a></li><li><a href=2>See also two</a></li></ul></article>"
    assert main_text(page(body)) == "\n".join([clean(LONG), clean(MORE)])


def test_white_space_references_and_inline_elements():
    body = f"<article><p>a\n\t b<b>c</b> &lt;d&gt;&nbsp;&#233;&#x1F600; &notit; {LONG}</p></article>"
    assert main_text(page(body)).startswith("a bc <d> é\U0001f600 ¬it; This")


@pytest.mark.parametrize(
    ("html", "text"),
    [("", ""), ("   ", ""), ("just text", "just text"), ("<p>one", "one"), ("<", "<"), ("a < b", "a < b"), ("<!--", ""),
     ("<script>alert(1)", ""), ("<p></p>", ""), ("<h1>Only a head</h1>", "Only a head")],
)
def test_small_pages(html, text):
    assert main_text(html) == text


def test_deep_nesting_and_long_pages():
    assert main_text("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    rows = "".join(f"<p>{MORE}{i}</p>" for i in range(5_000))
    assert main_text(page(f"{NAV}<main>{rows}</main>")).count("\n") == 4_999


def test_frame(spark):
    rows = [(1, "u", page(ARTICLE), "x"), (1, "u", page(ARTICLE), "x"), (2, None, None, "x"), (None, "v", "", "x")]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string, text string")
    got = sorted((str(r["_id"]), r["url"] or "", r["text"]) for r in extract_main_text(pages).collect())
    assert got == [("1", "u", WANT), ("1", "u", WANT), ("2", "", ""), ("None", "v", "")]
    assert extract_main_text(pages.limit(0)).collect() == []
