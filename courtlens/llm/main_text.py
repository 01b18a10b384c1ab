"""Main text of web pages by scoring the element tree.

Markup is read into a tree with the usual implied end tags. Every block of text is a paragraph: it
earns a point, one per comma and one per hundred characters up to three, discounted by the share
of its text inside links, and passes them in full to its container, half to the container above
and a third and so on up to LEVELS of them. The container with the most points, discounted by its own share of
links and with a small bonus for elements that declare content, is found. The article or main around
it is kept whole (main if it has only that article); without these, the ancestor up to which what
is added is not mostly links. So are siblings that score well or are headings, sections or
paragraphs, however short. Of what is kept, blocks come in page order.

Left out before scoring: elements that are no content by name (menus, headers, footers, sidebars,
scripts, styles, ...), by role, by a class or id (adverts, notices, comments, ...), or hidden; and
forms. A class or id counts if all its words are such names or words for parts of a page
("comment-list"), not if one of them is ("notice-period"). Neither a class or id nor a form leaves
out an element that holds most of the page's article (its text in article and main elements,
without links; of a page without these, all its text, unless one class names the element alone, as
"comments" does), and names are not looked at if they would leave nothing. Lists of links inside the
kept part go too, unless they are inside an article right below a heading, as its sources are, or
between its prose.

The tree is read, summed and scored in time linear in the page: open elements are found by their
tag, sums go once up the tree and decisions once down.

Defined cases: null pages are empty; an empty page, or one without text, gives an empty text;
unclosed, stray and cut-off tags are repaired; nesting has no limit; a page without markup is its
own text; repeated rows get one row each; other columns are ignored; nothing is cut to a length.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlens.llm.common import column

# ---- fixed values: names of HTML --------------------------------------------

_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title xmp iframe noembed noframes".split())
_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
_NO_CONTENT = set(
    "applet aside audio button canvas datalist dialog embed fieldset footer head header iframe "
    "input label link map menu meta nav nextid noembed noframes noscript object optgroup option "
    "script search select style svg template textarea title video".split()
)
_ROLES = set(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
    "status toolbar".split()
)
# Words of a class or id that name something other than the article.
_JUNK = set(
    "ad ads adv advert adverts advertisement advertising adsense banner billboard breadcrumb "
    "breadcrumbs byline-share comment comments commentlist cookie cookies consent copyright "
    "disclaimer disqus disclosure extra feedback footer footnav gdpr header hidden login masthead "
    "menu menus modal nav navbar navigation newsletter notice notices outbrain overlay pager "
    "pagination popup prompt promo promos promoted promotion reactions recommended rail related "
    "replies reply respond rss search share shares sharing shoutbox sidebar sidebars signin signup "
    "skip skyscraper social sponsor sponsored subscribe subscription taboola tags teaser toolbar "
    "topbar widget widgets".split()
)
# Words that a class or id may have beside those: parts of a page, not topics.
_PARTS = set(
    "area author bar block body bottom box button buttons center column container content date desktop "
    "footer form group head icon icons image images img inner item items left link links list lists "
    "meta middle mobile module outer panel post posts right row section side slot small stories story "
    "text thread title top unit wrap wrapper zone".split()
)
_GOOD = {"article": 5.0, "main": 3.0}
# Containers above a paragraph that share its points.
LEVELS = 10
_PROSE = {"p", "pre", "blockquote", "td", "li", "dd", "dt", "figcaption", "caption", "center", "address"}
# Kept beside the best container whatever their length, unless they are links.
_BESIDE = {"p", "pre", "blockquote", "section", "h1", "h2", "h3", "h4", "h5", "h6"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "th", "legend", "summary"}
# An end tag is implied: for a new element, which open ones close, and what they may not reach past.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, set()),
}
_SCOPES = {"td", "th", "table", "caption", "button", "html", "template", "object", "marquee"}

_TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_WORDS = re.compile(r"[a-z]+")
_KEPT_ATTRIBUTES = ("class", "id", "role", "hidden", "style", "aria-hidden")


class Node:
    __slots__ = ("tag", "attributes", "parent", "children", "junk", "points", "text", "linked", "kept")

    def __init__(self, tag: str, attributes: str, parent: Node | None) -> None:
        self.tag, self.parent, self.children = tag, parent, []
        self.attributes = attributes
        self.junk = False
        self.points, self.text, self.linked = 0.0, 0, 0
        self.kept: bool | None = None


class _Open:
    """The open elements, with the places of every tag among them."""

    def __init__(self, root: Node) -> None:
        self.root = root
        self.nodes: list[Node] = []
        self.places: dict[str, list[int]] = {}
        self.scopes: list[int] = []
        self.blocks: list[int] = []

    @property
    def top(self) -> Node:
        return self.nodes[-1] if self.nodes else self.root

    def add(self, node: Node) -> None:
        at = len(self.nodes)
        self.nodes.append(node)
        self.places.setdefault(node.tag, []).append(at)
        if node.tag in _SCOPES:
            self.scopes.append(at)
        if node.tag in _BLOCK:
            self.blocks.append(at)

    def cut(self, at: int) -> None:
        """Close the element at a place and all in it."""
        while len(self.nodes) > at:
            last = len(self.nodes) - 1
            self.places[self.nodes.pop().tag].pop()
            for places in (self.scopes, self.blocks):
                if places and places[-1] == last:
                    places.pop()

    def last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else -1

    def end(self, tag: str) -> None:
        """An end tag. A stray inline one closes no block, and nothing closes past a table cell."""
        at = self.last(tag)
        limit = -1
        if tag not in _SCOPES and self.scopes:
            limit = self.scopes[-1]
        if tag not in _BLOCK and self.blocks:
            limit = max(limit, self.blocks[-1])
        if at >= max(limit, 0):
            self.cut(at)

    def implied(self, tag: str) -> None:
        """The end tags that a start tag implies."""
        if tag in _BLOCK:
            # A block ends an open paragraph, whatever inline elements are open in it.
            at = max(self.scopes[-1] if self.scopes else -1, self.blocks[-1] if self.blocks else -1)
            if at >= 0 and self.nodes[at].tag == "p":
                self.cut(at)
        closes, stops = _CLOSES.get(tag, (None, None))
        if closes:
            stop = max((self.last(t) for t in stops), default=-1)
            inside = []
            for t in closes:
                places = self.places.get(t, [])
                first = bisect_right(places, stop)
                inside += places[first : first + 1]
            if inside:
                self.cut(min(inside))


def read_tree(page: str) -> Node:
    """The element tree; children are nodes or strings with references decoded."""
    root = Node("html", "", None)
    elements, at, size, body = _Open(root), 0, len(page), False

    def text(start: int, end: int) -> None:
        if end > start:
            piece = page[start:end]
            elements.top.children.append(unescape(piece) if "&" in piece else piece)

    while at < size:
        found = _TAG.search(page, at)
        if found is None:
            text(at, size)
            break
        text(at, found.start())
        at = found.end()
        closing, name, rest = found.groups()
        if name is None:
            continue
        name = name.lower()
        if closing:
            elements.end(name)
            continue
        if name == "html" or name == "body" and body:
            continue
        elements.implied(name)
        above = elements.top
        child = Node(name, rest if any(a in rest.lower() for a in _KEPT_ATTRIBUTES) else "", above)
        above.children.append(child)
        body = body or name == "body" and above is root
        if name in _VOID or rest.endswith("/") and name not in _BLOCK and name not in _RAW and name != "a":
            continue
        if name in _RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else size
            continue
        elements.add(child)
    return root


def _is_junk(node: Node) -> bool:
    if node.tag in _NO_CONTENT:
        return True
    if not node.attributes or node.tag in ("html", "body"):
        return False
    for name, value in _ATTRIBUTE.findall(node.attributes):
        name, value = name.lower(), unescape(value.strip("\"'")).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value in _ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def _junk_names(node: Node) -> tuple[bool, bool]:
    """Whether a class or id names junk, and whether one has no other words."""
    named = alone = False
    if node.attributes and node.tag not in ("html", "body"):
        for name, value in _ATTRIBUTE.findall(node.attributes):
            if name.lower() not in ("class", "id"):
                continue
            for one in unescape(value.strip("\"'")).lower().split():
                words = _WORDS.findall(one)
                if not _JUNK.isdisjoint(words) and all(w in _JUNK or w in _PARTS for w in words):
                    named, alone = True, alone or _JUNK.issuperset(words)
    return named or node.tag == "form", alone


def _mark_junk(root: Node) -> None:
    """Set ``junk`` of elements that their class or id leaves out."""
    seen: list[tuple[Node, int, int]] = []
    named: list[tuple[Node, bool]] = []
    todo = [(root, False, False)]
    while todo:
        node, in_link, in_article = todo.pop()
        names, alone = _junk_names(node)
        if names and node.tag not in _GOOD:
            named.append((node, alone))
        in_link, in_article = in_link or node.tag == "a", in_article or node.tag in _GOOD and not names
        own = 0 if in_link else sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        seen.append((node, own, own if in_article else 0))
        todo += [(c, in_link, in_article) for c in node.children if isinstance(c, Node) and not _is_junk(c)]
    if not named:
        return
    texts: dict[int, list[int]] = {}
    for node, own, article in reversed(seen):
        sums = texts.setdefault(id(node), [0, 0])
        sums[0] += own
        sums[1] += article
        if node.parent is not None:
            above = texts.setdefault(id(node.parent), [0, 0])
            above[0] += sums[0]
            above[1] += sums[1]
    page, article = texts[id(root)]
    for node, alone in named:
        inside = texts[id(node)]
        most = 2 * inside[1] > article if article else 2 * inside[0] > page and not alone
        node.junk = not most


def _unmark(root: Node) -> None:
    todo = [root]
    while todo:
        node = todo.pop()
        node.junk = False
        todo += [c for c in node.children if isinstance(c, Node)]


class _Blocks:
    """Blocks of text in page order, as (container, text, characters in links)."""

    def __init__(self) -> None:
        self.done: list[tuple[Node, str, int]] = []
        self.open: list[str] = []
        self.links = 0

    def end(self, container: Node) -> None:
        if self.open:
            text = " ".join("".join(self.open).split())
            if text:
                self.done.append((container, text, min(self.links, len(text))))
            self.open, self.links = [], 0


def _collect(root: Node) -> list[tuple[Node, str, int]]:
    blocks = _Blocks()
    # (child, nearest block element, inside a link); None ends that block element.
    todo: list[tuple[Node | str | None, Node, bool]] = [(root, root, False)]
    while todo:
        item, container, in_link = todo.pop()
        if item is None:
            blocks.end(container)
        elif isinstance(item, str):
            blocks.open.append(item)
            if in_link:
                blocks.links += len(item.strip())
        elif item.tag in ("br", "wbr", "hr"):
            if item.tag == "hr":
                blocks.end(container)
            elif item.tag == "br":
                blocks.open.append("\n")
        elif item is not root and (item.junk or _is_junk(item)):
            # What stands around it is not one run of text.
            if item.tag in _BLOCK:
                blocks.end(container)
        elif item.tag in _BLOCK:
            blocks.end(container)
            todo.append((None, item, False))
            todo += [(c, item, in_link) for c in reversed(item.children)]
        else:
            todo += [(c, container, in_link or item.tag == "a") for c in reversed(item.children)]
    blocks.end(root)
    return blocks.done


def _whole(best: Node) -> Node:
    """The article around the best container: all of it, not only what scores."""
    above = []
    up = best
    while up is not None:
        above.append(up)
        up = up.parent
    article = next((n for n in above if n.tag == "article"), None)
    main = next((n for n in above if n.tag == "main"), None)
    if article is not None:
        # What stands in main beside its only article belongs to it.
        if main is not None and above.index(main) > above.index(article) and not _other_articles(main, article):
            return main
        return article
    if main is not None:
        return main
    while best.parent is not None:
        rest, links = best.parent.text - best.text, best.parent.linked - best.linked
        if 2 * links > rest:
            break
        best = best.parent
    return best


def _other_articles(main: Node, article: Node) -> bool:
    todo = [main]
    while todo:
        node = todo.pop()
        for child in node.children:
            if isinstance(child, Node) and child is not article and child.text:
                if child.tag == "article":
                    return True
                todo.append(child)
    return False


def _in_order(root: Node) -> list[Node]:
    """All elements, every one after its parent."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in node.children if isinstance(c, Node)]
    return order


def score(root: Node, blocks: list[tuple[Node, str, int]]) -> list[Node]:
    """Set text, linked and points of the elements; returns those with points, as first rewarded."""
    scored: list[Node] = []
    for container, text, links in blocks:
        container.text += len(text)
        container.linked += links
        if container.tag in _HEADINGS:
            continue
        points = 1 + text.count(",") + min(len(text) / 100, 3.0)
        points *= 1 - links / len(text)
        prose = container.tag in _PROSE and container.parent is not None
        up, share = (container.parent if prose else container), 1
        while up is not None and points > 0 and share <= LEVELS:
            if not up.points:
                scored.append(up)
            up.points += points / share
            up, share = up.parent, share + 1
    for node in reversed(_in_order(root)):
        if node.parent is not None:
            node.parent.text += node.text
            node.parent.linked += node.linked
    return scored


def value(node: Node) -> float:
    return (node.points + _GOOD.get(node.tag, 0.0)) * (1 - node.linked / max(1, node.text))


def _links(node: Node) -> bool:
    return node.tag in ("ul", "ol", "table", "div") and node.linked > 0.8 * node.text


def _decide(root: Node, kept: set[int], sources: set[int]) -> None:
    """``kept`` of all elements: that of the nearest one that is chosen or a list of links."""
    for node in _in_order(root):
        above = node.parent.kept if node.parent is not None else False
        if _links(node) and id(node) not in sources:
            node.kept = False
        else:
            node.kept = above or id(node) in kept


def _sources(root: Node, blocks: list[tuple[Node, str, int]]) -> set[int]:
    """Lists of links in an article that stand below a heading or between its prose."""
    out: set[int] = set()
    before: dict[int, Node] = {}
    open_lists: dict[int, set[int]] = {}
    article: dict[int, Node | None] = {}
    inside: dict[int, Node | None] = {}
    for node in _in_order(root):
        above = node.parent
        article[id(node)] = node if node.tag == "article" else above and article[id(above)]
        outer = above and inside[id(above)]
        inside[id(node)] = outer or (node if _links(node) else None)
    for container, _, _ in blocks:
        mine, links = article[id(container)], inside[id(container)]
        if mine is None:
            continue
        if links is None:
            before[id(mine)] = container
            out |= open_lists.pop(id(mine), set())
        elif id(mine) in before and article[id(links)] is mine:
            below = before[id(mine)].tag in _HEADINGS
            (out if below else open_lists.setdefault(id(mine), set())).add(id(links))
    for node in _in_order(root):
        # What is in such a list stays with it.
        if node.parent is not None and id(node.parent) in out:
            out.add(id(node))
    return out


def main_text(page: str) -> str:
    root = read_tree(page)
    _mark_junk(root)
    blocks = _collect(root)
    if not blocks:
        _unmark(root)
        blocks = _collect(root)
    if not blocks:
        return ""
    scored = score(root, blocks)
    if not scored:
        return "\n".join(text for _, text, links in blocks if links < len(text))
    best = max(scored, key=value)
    top = value(best)
    best = _whole(best)
    kept = {id(best)}
    if best.parent is not None:
        for sibling in best.parent.children:
            if not isinstance(sibling, Node) or sibling is best or not sibling.text:
                continue
            density = sibling.linked / sibling.text
            if sibling.points and value(sibling) >= max(5.0, 0.2 * top):
                kept.add(id(sibling))
            elif sibling.tag in _BESIDE and density < 0.25:
                kept.add(id(sibling))
    _decide(root, kept, _sources(root, blocks))
    return "\n".join(text for container, text, _ in blocks if container.kept)


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(_id, url, text) per row, one projection without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("url"), pa.array(texts, pa.string())],
                ["_id", "url", "text"],
            )

    rows = pages.select(
        column(pages, id_col).alias("_id"),
        column(pages, url_col).alias("url"),
        F.coalesce(column(pages, html_col), F.lit("")).alias("_text"),
    )
    kind, url = (rows.schema[c].dataType.simpleString() for c in ("_id", "url"))
    return rows.mapInArrow(run, f"_id {kind}, url {url}, text string")
