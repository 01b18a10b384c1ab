"""Parts of an article that look like something else, time in the size of a page, and the scores."""

import random
import time

import pytest
from test_main_text import ARTICLE, LONG, MORE, NAV, WANT, clean, page

from courtlens.llm import main_text as module
from courtlens.llm.main_text import LEVELS, main_text

BODY = f"<p>{LONG}</p><p>{MORE}</p>"
TEXT = [clean(LONG), clean(MORE)]


def test_a_page_inside_one_form():
    fields = "<input name=q><select><option>One</select><label>Name</label><button>Send</button>"
    assert main_text(page(f"<form action=/x>{fields}{NAV}<div>{BODY}</div></form>")) == "\n".join(TEXT)
    assert main_text(page(f"<form>{NAV}{ARTICLE}{fields}</form>")) == WANT
    assert main_text(page(f"{ARTICLE}<form><p>Write to us, please</p>{fields}</form>")) == WANT


@pytest.mark.parametrize(
    "part, text",
    [
        ("<section id='related-work'><h2>Related work</h2><p>Others did so, too.</p></section>", ["Related work", "Others did so, too."]),
        ("<p class='notice-period'>The period is a month.</p>", ["The period is a month."]),
        ("<h2 id='comments-on-the-law'>Comments on the law</h2>", ["Comments on the law"]),
        ("<h2>Sources</h2><ul><li><a href=/1>One source</a><li><a href=/2>And another</a></ul>", ["Sources", "One source", "And another"]),
    ],
)
def test_parts_of_an_article(part, text):
    got = main_text(page(f"{NAV}<article>{BODY}{part}<p>{MORE}</p></article>"))
    assert got == "\n".join([*TEXT, *text, clean(MORE)])


def test_a_named_part_of_a_plain_page():
    got = main_text(page(f"{NAV}<div>{BODY}<div class='extra-info'><p>More about it, in short.</p></div></div>"))
    assert got == "\n".join([*TEXT, "More about it, in short."])


@pytest.mark.parametrize("name", ["comment-list", "ad-slot-3", "social share", "related-posts", "cookie-notice", "newsletter_box"])
def test_names_of_junk_and_parts(name):
    assert main_text(page(f"{ARTICLE[:-10]}<div class='{name}'><p>{MORE}</p></div></article>")) == WANT
    assert main_text(page(f"{ARTICLE}<div id='{name}'><p>{MORE}</p></div>")) == WANT


def test_a_menu_first_in_an_article_goes():
    got = main_text(page(f"<article><ul><li><a href=/>Home</a><li><a href=/x>Here</a></ul>{BODY}</article>"))
    assert got == "\n".join(TEXT)


@pytest.mark.parametrize(
    "html",
    [
        "<div>x" * 20_000,
        "<b>y</i>" * 20_000,
        "<p><b>z" * 20_000,
        "<li>" + "<b>x</li>" * 20_000,
        "<body>x" * 20_000,
        "<i>" + "<div><b></i>x" * 20_000,
        "<table>" * 5_000 + "<td>x</tr>" * 5_000,
    ],
)
def test_time_is_linear(html):
    main_text("<p>warm, up")
    start = time.process_time()
    text = main_text(html)
    assert time.process_time() - start < 2.5
    assert text.count(html[-1]) >= html.count(html[-1]) // 2 or ">" in html[-5:]


def random_page(rng: random.Random, depth: int = 0) -> str:
    out = []
    for _ in range(rng.randint(1, 4)):
        kind = rng.choice(["text", "div", "p", "a", "section", "li", "h2", "article", "text"])
        if kind == "text" or depth > 5:
            out.append(" ".join(rng.choice(["ab", "cde,", "f", "ghij"]) for _ in range(rng.randint(1, 60))))
        else:
            out.append(f"<{kind}>{random_page(rng, depth + 1)}</{kind}>")
    return "".join(out)


def brute_scores(root, blocks):
    """Points, text and links of every element, each summed over all blocks from the definition."""
    nodes, todo = [], [root]
    while todo:
        node = todo.pop()
        nodes.append(node)
        todo += [c for c in node.children if isinstance(c, module.Node)]

    def chain(node):
        return [] if node is None else [node, *chain(node.parent)]

    for node in nodes:
        points = text = linked = 0
        for container, words, links in blocks:
            up = chain(container)
            if node in up:
                text, linked = text + len(words), linked + links
            if container.tag in module._HEADINGS:
                continue
            if container.tag in module._PROSE and container.parent is not None:
                up = up[1:]
            earned = (1 + words.count(",") + min(len(words) / 100, 3)) * (1 - links / len(words))
            if node in up[:LEVELS]:
                points += earned / (up.index(node) + 1)
        yield node, points, text, linked


@pytest.mark.parametrize("seed", range(25))
def test_scores_by_brute_force(seed):
    root = module.read_tree(random_page(random.Random(seed)))
    blocks = module._collect(root)
    scored = module.score(root, blocks)
    want = list(brute_scores(root, blocks))
    for node, points, text, linked in want:
        assert (node.points, node.text, node.linked) == (pytest.approx(points), text, linked)
    assert {id(n) for n in scored} == {id(n) for n, points, _, _ in want if points}
    # What is kept of a page are its blocks in order.
    lines = [t for _, t, _ in blocks]
    got = main_text(random_page(random.Random(seed))).split("\n")
    assert [t for t in lines if t in got] == [t for t in lines if t in set(got)] and set(got) <= set(lines) | {""}
