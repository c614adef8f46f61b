"""Main text of web pages, by a tree-structured graphical model over the DOM.

Nodes are block elements (and other elements that a class, id or role marks); each is content or not. A node's potential is
linear in features of its tag, its marks and its text; a potential on each parent-child pair says how labels go
together. Sum-product messages pass from the leaves to the root and back, which gives each node's exact marginal. Text
counts if its node's marginal is over one half. Weights are fitted by ``fit`` on labelled pages, by gradient ascent on
the conditional likelihood; ``html_model.json`` holds those fitted on the pages of ``dom_pages.labelled`` (seed 1).

The whole html is read, in time that grows with its length, whatever it holds. Null or empty html gives an empty text. Broken markup is read as it comes: an end tag without
a start is skipped, an open paragraph or list item ends where the next block begins, what is still open ends with the page, but an svg
without an end tag where the next block begins. A quote counts where it begins an attribute's value; one that is never closed is a character like any other, and if a
tag's quotes leave it without an end, quotes count for nothing from there on. Formulas in math are text. Rows repeat in the result as in the input; null ids and urls are kept, extra columns
ignored. An empty table gives no rows.
"""

from __future__ import annotations

import html
import json
import math
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCKS = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup iframe legend li main menu nav ol option p pre search section select summary table tbody td textarea tfoot th thead tr ul".split()
)
RAW = frozenset(("script", "style", "title", "noscript", "template", "svg", "object", "audio", "video", "canvas", "iframe"))
#: Start tags that end an svg left open, as in HTML parsers, and the elements of an svg that HTML may stand in.
_BREAKS = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
_HOSTS = frozenset(("foreignobject", "desc", "title"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Marks in class, id and role, by what they tell of.
MARKS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs toc pagination pager tabs toolbar skip",
    "head": "header masthead topbar banner branding logo hero",
    "foot": "footer foot copyright colophon legal bottom contentinfo",
    "side": "sidebar side aside rail widget widgets related recommended more popular trending complementary tags",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted commercial",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay dialog banner paywall newsletter subscribe signup disclaimer warning",
    "social": "share sharing social follow like",
    "form": "form login search searchbox contact input signin register",
    "comment": "comment comments reply replies respond discussion disqus reader responses feedback",
    "content": "article content post entry story main body text page read prose",
}
_MARK = {w: k for k, words in MARKS.items() for w in words.split()}
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_STEP = re.compile(r"[^>=]*+(?:=\s*+([\"']?))?")
_BARE = re.compile(r"[^\s>]*+")
_ATTR = re.compile(r"(?<![-\w:.])([a-zA-Z_:][-\w:.]*+)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
#: What ends an open element of these; inside a list or table, only elements of that one end.
_ENDS = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
_LISTS = frozenset(("ul", "ol", "menu", "table", "dl", "select"))
_ROWS = frozenset(("tbody", "tfoot", "thead"))
_CELL_ENDS = {"tr": _ROWS | {"tr"}, "td": _ROWS | {"td", "th", "tr"}, "th": _ROWS | {"td", "th", "tr"}} | dict.fromkeys(_ROWS, _ROWS)


class Node:
    __slots__ = ("tag", "marks", "parent", "children", "words", "linked", "links", "stops", "label", "hidden")

    def __init__(self, tag: str, marks: tuple[str, ...], parent: int, label: int | None, hidden: bool):
        self.tag, self.marks, self.parent, self.label, self.hidden = tag, marks, parent, label, hidden
        self.children: list[int] = []
        self.words = self.linked = self.links = self.stops = 0


class _Markup:
    """The tokens of a page. Every character is looked at a bounded number of times: what a failed search found out is kept."""

    def __init__(self, page: str):
        self.page, self.quotes = page, True
        self.last = {c: page.rfind(c) for c in "\"'>"}

    def token(self, at: int) -> tuple[int, str | None, bool, str | None, str]:
        """(end, text, closing, name, attributes) of the token at at: text, or a tag's name, or neither for comments and declarations."""
        page = self.page
        if page[at] != "<":
            end = page.find("<", at)
            end = len(page) if end < 0 else end
            return end, page[at:end], False, None, ""
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            return (len(page) if end < 0 else end + 3), None, False, None, ""
        if page.startswith(("<!", "<?"), at):
            end = page.find(">", at)
            return (len(page) if end < 0 else end + 1), None, False, None, ""
        closing = page.startswith("/", at + 1)
        m = _NAME.match(page, at + 1 + closing) if at < self.last[">"] else None
        if m is None:
            return at + 1, "<", False, None, ""
        end = self._end(m.end())
        return end, None, closing, m[0].lower(), page[m.end() : end - 1]

    def _end(self, at: int) -> int:
        """The end of the tag whose attributes begin at at; a > comes somewhere."""
        page, x = self.page, at
        while self.quotes:
            m = _STEP.match(page, x)
            x = m.end()
            if m[1]:
                x = page.index(m[1], x) + 1 if x <= self.last[m[1]] else x
            elif m[1] is not None:
                x = _BARE.match(page, x).end()
            elif x < len(page):
                return x + 1
            if x >= len(page):
                self.quotes = False
        return page.index(">", at) + 1


def _after_svg(markup: _Markup, start: int) -> dict[int, int]:
    """Where the page goes on after the svg whose start tag ends at start, and after each one inside: without an end tag at the next block, or else right there."""
    found, at, end = {}, start, len(markup.page)
    stack = [[start, 0]]  # open ones, with how many of _HOSTS are open in each
    while stack and at < end:
        begin = at
        at, _, closing, name, attrs = markup.token(at)
        if name in _BREAKS and not closing:
            while stack and not stack[-1][1]:
                found[stack.pop()[0]] = begin
        elif attrs.rstrip().endswith("/"):
            continue
        elif name == "svg" and closing:
            found[stack.pop()[0]] = at
        elif name == "svg":
            stack.append([at, 0])
        elif name in _HOSTS:
            stack[-1][1] = max(0, stack[-1][1] + (-1 if closing else 1))
    return found | {x: x for x, _ in stack}


class _Open:
    """The open elements that are nodes, innermost last, as (name, node)."""

    def __init__(self):
        self.stack: list[tuple[str, int]] = [("", 0)]
        self.names: dict[str, int] = {}
        self.items: list[int] = []  # places of what _ENDS names, and of lists
        self.cells: list[int] = []  # places of tables and their parts

    def push(self, name: str, node: int) -> None:
        if name in _ENDS or name in _LISTS:
            self.items.append(len(self.stack))
        if name in _CELL_ENDS or name == "table":
            self.cells.append(len(self.stack))
        self.names[name] = self.names.get(name, 0) + 1
        self.stack.append((name, node))

    def cut(self, k: int) -> None:
        for name, _ in self.stack[k:]:
            self.names[name] -= 1
        del self.stack[k:]
        for places in (self.items, self.cells):
            while places and places[-1] >= k:
                places.pop()

    def close(self, name: str) -> bool:
        """Ends the innermost element of that name and all inside it."""
        if not self.names.get(name):
            return False
        k = len(self.stack) - 1
        while self.stack[k][0] != name:
            k -= 1
        self.cut(k)
        return True

    def begin(self, name: str) -> None:
        """Ends what an element of that name ends by beginning."""
        if name in _CELL_ENDS:
            for k in reversed(self.cells):
                if self.stack[k][0] == "table":
                    break
                if name in _CELL_ENDS[self.stack[k][0]]:
                    self.cut(k)
        for k in reversed(self.items):
            if self.stack[k][0] in _LISTS:
                break
            if name in _ENDS[self.stack[k][0]]:
                self.cut(k)
                break


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """(nodes, parents first; text blocks in page order as (node, raw text))."""
    nodes = [Node("body", (), -1, None, False)]
    elements, markup = _Open(), _Markup(page)
    blocks: list[tuple[int, str]] = []
    text: list[str] = []
    owner = 0
    in_link = False
    after: dict[int, int] = {}
    unended: set[str] = set()  # raw elements that no end tag follows any more
    at, end = 0, len(page)

    def flush() -> None:
        if text:
            blocks.append((owner, "".join(text)))
            text.clear()

    while at < end:
        at, raw, closing, name, given = markup.token(at)
        if raw is not None:
            here = elements.stack[-1][1]
            if here != owner:
                flush()
                owner = here
            text.append(raw)
            n = len(raw.split())
            node = nodes[here]
            node.words += n
            node.linked += n if in_link else 0
            node.stops += raw.count(". ") + raw.count(", ") + raw.rstrip().endswith((".", "!", "?", "…"))
            continue
        if name is None:
            continue
        if closing:
            if name == "a":
                in_link = False
            if elements.names.get(name):
                if name in BLOCKS:
                    flush()
                elements.close(name)
            continue
        alone = given.rstrip().endswith("/")
        if name in RAW:
            if alone:
                continue
            if name == "svg":
                if at not in after:
                    after |= _after_svg(markup, at)
                at = after[at]
                continue
            close = None if name in unended else re.compile(rf"</{name}\s*+>", re.I).search(page, at)
            if close is None:
                unended.add(name)
            at = close.end() if close else end
            continue
        if name in ("br", "hr"):
            text.append(" ")
        if name in VOID or alone:
            continue
        if name == "a":
            in_link = True
            nodes[elements.stack[-1][1]].links += 1
        attrs = {a.lower(): v or w or x for a, v, w, x in _ATTR.findall(given)} if given else {}
        found = [_MARK[p] for k in ("class", "id", "role") if k in attrs for p in dict.fromkeys(x.lower() for x in _PART.findall(attrs[k])) if p in _MARK]
        hidden = re.search(r"(?:^|\s)hidden(?:\s|=|$)|display\s*+:\s*+none", given) is not None if given else False
        if name not in BLOCKS and not found and not hidden:
            continue
        if name in BLOCKS:
            flush()
            elements.begin(name)
        if name == "body" and len(nodes) == 1:
            nodes[0].marks = tuple(dict.fromkeys(found))
            continue
        nodes.append(Node(name, tuple(dict.fromkeys(found)), elements.stack[-1][1], int(attrs["data-y"]) if attrs.get("data-y") in ("0", "1") else None, hidden))
        nodes[elements.stack[-1][1]].children.append(len(nodes) - 1)
        elements.push(name, len(nodes) - 1)
    flush()
    return nodes, blocks


def features(nodes: list[Node]) -> list[list[str]]:
    """Per node the names of its features that hold."""
    words, linked, stops = ([getattr(n, k) for n in nodes] for k in ("words", "linked", "stops"))
    for i in range(len(nodes) - 1, 0, -1):
        p = nodes[i].parent
        words[p] += words[i]
        linked[p] += linked[i]
        stops[p] += stops[i]
    total = max(1, words[0])
    own = [0] * len(nodes)  # words of text that is no link, below a node's paragraphs
    for i, n in enumerate(nodes):
        if n.tag in ("p", "pre", "blockquote", "td", "li") and i:
            own[n.parent] += words[i] - linked[i]
    main = max(range(len(nodes)), key=lambda i: own[i])
    path, at = set(), main
    while at >= 0:
        path.add(at)
        at = nodes[at].parent
    out = []
    for i, n in enumerate(nodes):
        f = ["bias", f"tag:{n.tag}", *(f"mark:{k}" for k in n.marks)]
        if n.marks:
            f.append("marked")
        if n.hidden:
            f.append("hidden")
        w = words[i]
        f.append("words:0" if not w else "words:1" if w < 5 else "words:5" if w < 15 else "words:15" if w < 50 else "words:50")
        if w:
            f.append(f"links:{min(3, int(4 * linked[i] / w))}")
            f.append(f"stops:{min(3, int(20 * stops[i] / w))}")
            f.append(f"share:{min(3, int(4 * w / total))}")
        if i == 0:
            f.append("root")
        else:
            f.append("place:" + ("main" if i == main else "holds" if i in path else "in" if n.parent == main else "before" if i < main else "after"))
            f.append(f"under:{nodes[n.parent].tag}")
        out.append(f)
    return out


def _add(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def beliefs(nodes: list[Node], theta: list[float], pair: list[list[float]]):
    """Sum-product on the tree. (marginal log odds of each node, and for each edge, by child, the log weights of (parent, child) labels).

    theta: the log potential of content against not, by node; pair[a][b]: that of a parent's label a with a child's b."""
    n = len(nodes)
    up = [[0.0, theta[i]] for i in range(n)]
    message = [(0.0, 0.0)] * n
    for i in range(n - 1, 0, -1):
        u0, u1 = up[i]
        message[i] = (_add(pair[0][0] + u0, pair[0][1] + u1), _add(pair[1][0] + u0, pair[1][1] + u1))
        p = up[nodes[i].parent]
        p[0] += message[i][0]
        p[1] += message[i][1]
    full: list = [None] * n
    edges: list = [None] * n
    full[0] = up[0]
    for i in range(1, n):
        b = full[nodes[i].parent]
        o0, o1 = b[0] - message[i][0], b[1] - message[i][1]
        u0, u1 = up[i]
        edges[i] = (o0 + pair[0][0] + u0, o0 + pair[0][1] + u1, o1 + pair[1][0] + u0, o1 + pair[1][1] + u1)
        full[i] = [_add(edges[i][0], edges[i][2]), _add(edges[i][1], edges[i][3])]
    return [b[1] - b[0] for b in full], edges


def fit(pages: list[str], rounds: int = 40, rate: float = 0.3, decay: float = 1e-3) -> dict:
    """Weights from pages whose nodes carry data-y. Adagrad on the conditional log likelihood; the same pages give the same weights."""
    w: dict[str, float] = {}
    g2: dict[str, float] = {}
    pair = [[0.0, 0.0], [0.0, 0.0]]
    data = []
    for page in pages:
        nodes = parse(page)[0]
        y = [n.label for n in nodes]
        y[0] = 1
        for i in range(1, len(nodes)):
            if y[i] is None:
                y[i] = y[nodes[i].parent]
        data.append((nodes, features(nodes), y))
    for _ in range(rounds):
        for nodes, f, y in data:
            odds, edges = beliefs(nodes, [sum(w.get(k, 0.0) for k in x) for x in f], pair)
            grad: dict[str, float] = {}
            for i, x in enumerate(f):
                e = y[i] - 1 / (1 + math.exp(-max(-50.0, min(50.0, odds[i]))))
                for k in x:
                    grad[k] = grad.get(k, 0.0) + e
            for i in range(1, len(nodes)):
                top = max(edges[i])
                p = [math.exp(v - top) for v in edges[i]]
                s = sum(p)
                for k in range(4):
                    name = f"pair:{k // 2}{k % 2}"
                    grad[name] = grad.get(name, 0.0) + (y[nodes[i].parent] == k // 2 and y[i] == k % 2) - p[k] / s
            for k, e in grad.items():
                e -= decay * w.get(k, 0.0)
                g2[k] = g2.get(k, 1e-6) + e * e
                w[k] = w.get(k, 0.0) + rate * e / math.sqrt(g2[k])
            pair = [[w.get(f"pair:{a}{b}", 0.0) for b in (0, 1)] for a in (0, 1)]
    return {k: round(v, 4) for k, v in sorted(w.items())}


@lru_cache(1)
def weights() -> dict:
    return json.loads((Path(__file__).parent / "html_model.json").read_text())


def extract(page: str | None, w: dict | None = None) -> str:
    """The main text: its blocks, white space made single, joined by line breaks."""
    if not page:
        return ""
    w = w or weights()
    nodes, blocks = parse(page)
    pair = [[w.get(f"pair:{a}{b}", 0.0) for b in (0, 1)] for a in (0, 1)]
    odds, _ = beliefs(nodes, [sum(w.get(k, 0.0) for k in x) for x in features(nodes)], pair)
    texts = (" ".join(html.unescape(t).split()) for i, t in blocks if odds[i] > 0)
    return "\n".join(t for t in texts if t)


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per page."""
    w = weights()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [extract(x.as_py(), w) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())], ["page_id", "url", "text", "n_chars"])

    d = pages.select("page_id", "url", F.col("html").cast("string"))
    return d.mapInArrow(run, f"page_id {d.schema['page_id'].dataType.simpleString()}, url {d.schema['url'].dataType.simpleString()}, text string, n_chars long")
