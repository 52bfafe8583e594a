"""Main text of web pages by composite text density.

A page becomes a tree of its block elements. Each has a density: characters per block, scaled down where much of its
text is in links and up where little is, against the page's share of linked text. A node's density sum adds up the
densities of its children. The node with the largest sum is the main content; its ancestors' smallest density, up to
the page's body, is the threshold at which neighbouring subtrees still belong to it.

Elements ``article`` and ``main`` bound this choice. If the main content lies in an ``article``, it is widened to the
innermost one. If it lies in any, then outside of the outermost only other such elements that reach the threshold are
taken, and headings inside it beside the path stay whatever their density.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments are left out of the tree by
element and role before densities are taken. By class or id name they are left out whatever their size, unless the
name is that of a wrapper: an element that holds the page's article, or all but a little of the text where it lies.
Articles inside an article that has text of its own are comments on it. Link lists inside the content are left out
after. Headings just before the content, or between two of its parts, belong to it.

Of equal density sums the innermost node is taken, of those the last on the page.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of HTML by their role.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split()
)
ARTICLES = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 header hgroup".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SPACING = frozenset("br td th img wbr".split())
#: Cells of a row are no blocks of text by themselves, but may be menus.
CELLS = frozenset(["td", "th"])
DROPPED = frozenset(
    "head nav footer aside form button select textarea input script style noscript template iframe svg object canvas audio video dialog menu search".split()
)
#: An open element of these kinds ends where a start tag of its set comes, unless one of its stops lies between.
ENDS = {
    "p": (BLOCKS - {"html", "body"}, frozenset("td th table li dd dt div article section main blockquote aside nav footer header button".split())),
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "tbody", "tfoot", "thead"]), frozenset(["table"])),
    "td": (frozenset(["td", "th", "tr", "tbody", "tfoot"]), frozenset(["table"])),
    "th": (frozenset(["td", "th", "tr", "tbody", "tfoot"]), frozenset(["table"])),
    "option": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "head": (frozenset(["body"]), frozenset()),
}
#: Roles and words of class and id names that mark what is not the article.
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense adbox banner sponsor sponsored sponsors promo promotion "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar masthead footer foot header topbar "
    "cookie cookies consent gdpr notice notices notification alert disclaimer popup modal overlay newsletter subscribe subscription signup login "
    "comment comments commentlist respond response responses reactions replies disqus share sharing social related recommended widget toolbar pagination pager side-bar skip-link".split()
)
#: Such words may be grown together with others of their kind, as in ``cookiebar``.
GROWN = re.compile(r"(?:comments?|sidebar|cookies?|advert|footer|navbar)(?:bar|box|list|form|wrap|wrapper|area|section|container|block|links|banner|message|policy|notice|menu|nav|widget)")
#: A class with one of these words says something of the layout or of what is not there.
STATES = frozenset("has have no not with without layout is hide show".split())
#: Headers of a part of the text, which hold its title.
PARTS = frozenset("entry post article story section title content page chapter".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|noscript|iframe|template)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[A-Za-z][^\s/>]*)(?P<rest2>[^>]*)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
_CLOSED = re.compile(r"(?:-->|</\w+\s*>|^<[!?](?!--)[^>]*>)\Z")
_OPEN = re.compile(r"<(?:/?[A-Za-z]|!--)")
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[^\W\d_]+")

#: A list, or a division without paragraphs, with this share of its text in links is a menu.
LINK_SHARE = 0.7
LISTS = frozenset("ul ol dl dir".split())
DIVISIONS = frozenset("div section table td center".split())
#: Inside an article, links longer than this on average are its references.
REFERENCE_CHARS = 40
#: Characters outside links and headings that make a text, and the share of an element's text that, coming after it, does.
TEXT_CHARS = 25
AFTER_SHARE = 0.1


class _Node:
    __slots__ = ("name", "parent", "items", "chars", "tags", "link_chars", "link_tags", "density", "total", "named", "in_article")

    def __init__(self, name: str, parent: _Node | None, named: bool = False, in_article: bool = False) -> None:
        self.name, self.parent, self.named, self.in_article = name, parent, named, in_article
        self.items: list = []  # texts and child nodes in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _marked(value: str, in_article: bool) -> bool:
    """Does a class or id name mark what is not the article? Every name is taken by itself."""
    for token in value.split():
        words = [w.lower() for w in _WORDS.findall(token)]
        joined = "-".join(words)
        if STATES.intersection(words):
            continue
        found = NAMES.intersection(words)
        if "header" in found and (in_article or PARTS.intersection(words)):
            found -= {"header"}
        if found or "side-bar" in joined or "skip-link" in joined or any(map(GROWN.fullmatch, words)):
            return True
    return False


def _unwanted(name: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Is this element no part of an article, and is it so by its class or id name?

    A header inside an article holds its title.
    """
    if name in DROPPED or name == "header" and not in_article:
        return True, False
    if not attributes or name in ("html", "body"):
        return False, False
    named = False
    for key, *values in _ATTRIBUTE.findall(attributes):
        kind, value = key.lower(), next((v for v in values if v), "")
        if kind == "hidden" or kind == "aria-hidden" and value.strip().lower() == "true":
            return True, False
        if kind == "style" and _INVISIBLE.search(value):
            return True, False
        if kind == "role":
            if value.strip().lower() in ROLES:
                return True, False
        elif kind in ("class", "id") and not (in_article and name in ("header", "h1", "h2", "h3")):
            named = named or _marked(value, in_article)
    return False, named


def _tree(page: str) -> list[_Node]:
    """All block nodes in page order, the root first; unwanted elements are left out.

    Those with a name of unwanted elements are nodes too, and ``named``.
    """
    root = _Node("html", None)
    nodes = [root]
    stack: list[tuple[str, _Node, bool, bool]] = [("", root, False, False)]  # element, its node, in a link, dropped
    opened: Counter[str] = Counter()
    at = 0

    def close(k: int) -> None:
        opened.subtract(s[0] for s in stack[k:])
        del stack[k:]

    def add(text: str) -> None:
        _, node, linked, dropped = stack[-1]
        if dropped or not text:
            return
        text = html.unescape(text)
        node.items.append(text)
        n = len(text) if not text.isspace() else 0
        node.chars += n
        node.link_chars += n * linked

    last = page.rfind(">") + 1  # a tag that begins later has no end and is dropped
    whole = True
    for token in _TOKEN.finditer(page, 0, last):
        if token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        name = (token["name"] or token["name2"] or "").lower()
        if not name:
            whole = bool(_CLOSED.search(token[0]))
            continue
        if token["close"] or token["close2"]:
            if opened[name] > 0:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == name))
            if name in SPACING:
                add(" ")
            continue
        for ended, (starts, stops) in ENDS.items():
            if name in starts and opened[ended] > 0:
                k = next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == ended or stack[k][0] in stops)
                if stack[k][0] == ended:
                    close(k)
        _, node, linked, dropped = stack[-1]
        rest = token["rest"] or token["rest2"] or ""
        in_article = opened["article"] + opened["main"] > 0
        unwanted, named = (True, False) if dropped else _unwanted(name, rest, in_article)
        dropped = dropped or unwanted or named and name in VOID
        if name in SPACING and not dropped:
            add(" ")
        if (name in BLOCKS or name in CELLS or named) and not dropped and name not in ("html", "body"):
            node = _Node(name, stack[-1][1], named, in_article)
            node.parent.items.append(node)
            nodes.append(node)
        if name == "a" and not dropped:
            node.link_tags += 1
            linked = True
        if name not in VOID and not rest.endswith("/"):
            stack.append((name, node, linked, dropped))
            opened[name] += 1
    add(page[at:last])
    rest = page[max(at, last) :] if whole else ""
    add(rest[: m.start()] if (m := _OPEN.search(rest)) else rest)
    return nodes


def _without_named(nodes: list[_Node]) -> list[_Node]:
    """Drop what is named as no part of the article, and articles that are comments on one, but for wrappers."""
    at = {id(n): k for k, n in enumerate(nodes)}
    up = [at[id(n.parent)] if n.parent is not None else -1 for n in nodes]
    heading = [False] * len(nodes)
    outer = [-1] * len(nodes)  # the outermost article around a node
    for k, n in enumerate(nodes):  # parents come before their children
        heading[k] = n.name in HEADINGS or up[k] >= 0 and heading[up[k]]
        if up[k] >= 0:
            outer[k] = outer[up[k]] if outer[up[k]] >= 0 else up[k] if nodes[up[k]].name == "article" else -1
    own = [0 if heading[k] else n.chars - n.link_chars for k, n in enumerate(nodes)]
    named = [n.named for n in nodes]
    nested = [k for k, n in enumerate(nodes) if n.name == "article" and outer[k] >= 0]
    if nested:
        apart = dict.fromkeys((outer[k] for k in nested), 0)  # text outside of articles within
        inner = [False] * len(nodes)
        for k, n in enumerate(nodes):
            inner[k] = up[k] >= 0 and inner[up[k]] or n.name == "article" and outer[k] >= 0
            holder = k if n.name == "article" and outer[k] < 0 else outer[k]
            if holder in apart and not inner[k]:
                apart[holder] += own[k]
        for k in nested:
            named[k] = named[k] or apart[outer[k]] >= TEXT_CHARS
    if not any(named):
        return nodes
    text, last = own[:], list(range(len(nodes)))  # of whole subtrees: text, and the last node
    for k in range(len(nodes) - 1, 0, -1):
        text[up[k]] += text[k]
        last[up[k]] = max(last[up[k]], last[k])
    under = named[:]
    for k in range(1, len(nodes)):
        under[k] = under[k] or under[up[k]]
    stays: set[int] = set()
    articles = [k for k, n in enumerate(nodes) if n.name in ARTICLES and any(m.chars for m in nodes[k : last[k] + 1])]
    scopes = [k for k in articles if not under[k]]
    if not scopes and articles:
        most = max(articles, key=lambda k: (text[k], -k))
        scopes, k = [most], most
        while k >= 0:
            stays.add(k)
            k = up[k]
    for scope in scopes or [0]:
        while True:
            inside: list[int] = []  # outermost named elements, and the text around them
            around: list[tuple[int, int]] = []
            k = scope
            while k <= last[scope]:
                if named[k] and k not in stays:
                    inside.append(k)
                    k = last[k] + 1
                else:
                    around.append((k, own[k]))
                    k += 1
            big = max(inside, key=lambda k: (text[k], -k), default=None)
            if big is None or text[big] < TEXT_CHARS:
                break
            before, after = sum(c for k, c in around if k < big), sum(c for k, c in around if k > big)
            if before >= TEXT_CHARS or after >= AFTER_SHARE * text[big]:
                break
            stays.add(big)
            scope = big
    gone: set[int] = set()
    left = []
    for k, node in enumerate(nodes):
        if up[k] >= 0 and id(nodes[up[k]]) in gone or named[k] and k not in stays:
            gone.add(id(node))
        else:
            left.append(node)
    for node in left:
        node.items = [i for i in node.items if id(i) not in gone]
    return left


def _densities(nodes: list[_Node]) -> None:
    for node in reversed(nodes):  # children come after their parents
        if (up := node.parent) is not None:
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    page = nodes[0]
    share = page.link_chars / page.chars if page.chars else 0.0
    for node in nodes:
        c, t = node.chars, node.tags or 1
        if not c:
            continue
        node.density = c / t
        if share:
            base = math.log(c / max(c - node.link_chars, 1) * node.link_chars + share * c + math.e)
            scale = math.log(max(c / (node.link_chars or 1) * t / (node.link_tags or 1), 1.0)) / math.log(max(base, 1.1))
            node.density *= scale
    for node in nodes[1:]:
        node.parent.total += node.density


def _menu(node: _Node) -> bool:
    if node.link_tags < 2 or node.link_chars < LINK_SHARE * node.chars or node.in_article and node.link_chars > REFERENCE_CHARS * node.link_tags:
        return False
    return node.name in LISTS or node.name in DIVISIONS and not any(isinstance(i, _Node) and i.name in ("p", *HEADINGS) for i in node.items)


def _heads(node: _Node) -> bool:
    """Is this a heading, or does it hold headings only?"""
    if node.name in HEADINGS:
        return True
    parts = [i for i in node.items if not (isinstance(i, str) and i.isspace())]
    return bool(parts) and all(isinstance(i, _Node) and _heads(i) for i in parts)


def _blocks(node: _Node, out: list[str]) -> None:
    """Texts of the node's blocks in page order: what stands between two block borders is one block."""
    todo: list = [(iter(node.items), True)]
    run: list[str] = []

    def end() -> None:
        if run and (text := " ".join("".join(run).split())):
            out.append(text)
        run.clear()

    while todo:
        for item in todo[-1][0]:
            if isinstance(item, str):
                run.append(item)
            elif not _menu(item):
                if item.name in BLOCKS or item.name == "border":
                    end()
                todo.append((iter(item.items), item.name in BLOCKS or item.name == "border"))
                break
            else:
                end()
        else:
            if todo.pop()[1]:
                end()
    end()


def main_text(page: str) -> str:
    """The article of a page, one block per line; empty if there is none."""
    nodes = _without_named(_tree(page))
    _densities(nodes)
    best = max(reversed(nodes), key=lambda n: n.total)  # of equals the innermost
    if not best.total:
        best = nodes[0]
    path = [best]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    content = next((n for n in path if n.name == "article"), best)
    on_path = set(map(id, path[path.index(content) + 1 :]))
    marked = [k for k, n in enumerate(path) if n.name in ARTICLES]
    within = set(map(id, path[: marked[-1] + 1] if marked else path))
    holds: set[int] = set()  # nodes with an article or main below them
    for node in reversed(nodes):  # children come after their parents
        if node.parent is not None and (node.name in ARTICLES or id(node) in holds):
            holds.add(id(node.parent))
    # From the body down: the content itself, and subtrees beside its path that are dense enough. Headings wait for what
    # they head: they are taken with the next part that is, if no other text lies between.
    chosen = _Node("content", None)
    out: list[str] = []
    waiting: list[_Node] = []
    todo = [(iter([path[-1]]), False)]
    while todo:
        items, inside = todo[-1]
        for item in items:
            if isinstance(item, str):
                if inside:
                    chosen.items.append(item)
                if not item.isspace():
                    waiting.clear()
            elif item is content:
                chosen.items += [*waiting, item]
                waiting.clear()
            elif id(item) in on_path:
                chosen.items.append(_Node("border", None))
                todo.append((iter(item.items), id(item) in within))
                break
            elif _heads(item):
                if inside and marked:
                    chosen.items += [*waiting, item]
                    waiting.clear()
                else:
                    waiting.append(item)
            elif (inside or item.name in ARTICLES) and item.density >= threshold:
                chosen.items += [*waiting, item]
                waiting.clear()
            elif not inside and id(item) in holds:
                todo.append((iter(item.items), False))
                break
            elif item.chars:
                waiting.clear()
        else:
            todo.pop()
            chosen.items.append(_Node("border", None))
    _blocks(chosen, out)
    return "\n".join(out)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page or "") for page in batch.column("html").to_pylist()]
        columns = [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def page_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row: its main text and the number of its characters.

    Null or empty html, and pages without text outside menus and the like, have an empty text. An empty table gives
    no rows. Broken markup is read
    as browsers do: unclosed elements end with what holds them. Rows are taken one by one, whatever their ids.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
