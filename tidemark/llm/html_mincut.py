"""Main-text extraction by minimum-cut labelling.

A page is cut into blocks (runs of text between block-level tags).  A log-odds
score from a block's own features (words, links, tag, the names of its ancestors)
becomes its terminal capacity: to the source if it looks like content, to the sink
if like boilerplate.  Blocks that follow one another, and blocks next to each other
under one parent, are joined by smoothness edges, heavier the deeper their common
ancestor.  The blocks on the source side of the minimum cut are the main text.

Pages are labelled one by one, whole, within the task that reads them.  Edges are
linear in the number of blocks.

Defined results: a null or empty page, and one without text, give an empty text;
markup that ends early is read as far as it goes (a tag cut off at the end of the
page is markup, not text); rows with equal ids or pages are extracted one by one;
null urls stay null; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship_package, text_of

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"'=]|=\s*(?:"[^"]*"|'[^']*')|["'=])*+)(?:>|\Z)""",
    re.S,
)
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s=/"'>]+)""")
#: Elements whose content is never text of the page.
UNSEEN = frozenset("script style title noscript template iframe object svg math canvas textarea select audio video".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An opening tag of the left kind ends an open element of the right kinds.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "body": ("head",),
}
#: Elements and roles that hold something else than the article.
ASIDE_TAGS = frozenset("nav footer aside form menu dialog button label fieldset search".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
#: Words in class or id names that say so too.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright discussion disqus footer form gdpr legal login masthead menu modal nav navbar navigation newsletter "
    "notice notification overlay pager pagination popup privacy promo promoted promotion recommended related replies reply "
    "respond search share sharing shoutbox sidebar signup skip social sponsor sponsored subscribe tags teaser toolbar topbar "
    "widget widgets".split()
)
MAIN_WORDS = frozenset("article articlebody body content entry main maincontent post story text".split())
#: Asides by their tag that can be wrapped around a whole page, and the spaces from which
#: a block is running text.
WRAPPERS, RUNNING = frozenset(("form", "fieldset", "dialog")), 8
#: What an element costs that is no article by its tag, or only by its names.
OUTSIDE, STRONG, NAMED = 4.0, 14.0, 8.0


@dataclass
class Element:
    name: str
    parent: "Element | None"
    depth: int
    tagged: bool
    named: bool
    barred: bool
    main: bool
    chars: int = 0
    running: int = 0
    against: float = 0.0


@dataclass
class Block:
    element: Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _names(value: str) -> set[str]:
    return {w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", value)}


def _element(name: str, attrs: str, parent: Element | None) -> Element:
    tagged, named, barred = name in ASIDE_TAGS, False, False
    main = name in ("article", "main")
    if attrs and not attrs.isspace():
        found = {}
        for m in _ATTR.finditer(attrs):
            found.setdefault((m[1] or m[5]).lower(), m[2] or m[3] or m[4] or "")
        words = _names(found.get("class", "") + " " + found.get("id", ""))
        named = bool(words & ASIDE_WORDS)
        barred = bool(words & {"header", "bar", "top"}) and name not in HEADINGS
        tagged = tagged or found.get("role", "").lower() in ASIDE_ROLES
        tagged = tagged or "hidden" in found or found.get("aria-hidden", "").lower() == "true"
        tagged = tagged or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I) is not None
        main = main or found.get("role", "").lower() in ("main", "article") or bool(words & MAIN_WORDS)
    return Element(name, parent, 0 if parent is None else parent.depth + 1, tagged, named, barred, main)


def _above(x: Element, y: Element | None) -> bool:
    """Whether ``y`` is ``x`` or stands in it."""
    while y is not None and y is not x:
        y = y.parent
    return y is x


def _in_aside(e: Element | None, spared: set[int]) -> bool:
    while e is not None:
        if e.tagged or (e.named and id(e) not in spared):
            return True
        e = e.parent
    return False


def _judge(elements: list[Element], blocks: list[Block]) -> None:
    """Sets main and against, from the root down.  Names say nothing of the page
    itself, nor of an element that holds a main element or the longest article (of a
    quarter of the text or more; else the first article that stands in no aside); where
    there are none, of one that holds most of the text.  A form or the like that holds
    most of the page's running text wraps it: its tag says nothing either, unless a
    main element or article stands beside it."""
    for b in blocks:
        b.element.chars += len(b.text)
        if b.text.count(" ") >= RUNNING and 2 * b.linked < len(b.text):
            b.element.running += len(b.text)
    for e in reversed(elements):
        if e.parent is not None:
            e.parent.chars += e.chars
            e.parent.running += e.running
    spared = {id(e) for e in elements if e.name in ("html", "body")}
    # a comment can be an article element as well: it has little of the page's text
    articles = [e for e in elements if e.name == "article" and 4 * e.chars > elements[0].chars]
    mains = [e for e in elements if e.name == "main" and e.chars]
    if not articles and not mains:
        articles = [e for e in elements if e.name == "article" and e.chars and not _in_aside(e.parent, spared)]
        held = articles[:1]
    else:
        held = mains + sorted(articles, key=lambda e: -e.chars)[:1]
    wraps = set()
    for e in elements:
        if e.name in WRAPPERS and 2 * e.running > elements[0].running and all(_above(e, h) or _above(h, e) for h in held):
            wraps.add(id(e))
    for e in held:
        while e is not None and id(e) not in spared:
            spared.add(id(e))
            e = e.parent
    if not held:
        spared |= {id(e) for e in elements if 2 * e.chars > elements[0].chars}
    for e in elements:
        within = e.parent is not None and e.parent.main
        tagged = (e.tagged and id(e) not in wraps) or (e.name == "header" and not within)
        named = id(e) not in spared and (e.named or (e.barred and not within))
        own = STRONG if tagged else NAMED if named else 0.0
        e.main = (e.main or within) and not own
        e.against = max(own, e.parent.against if e.parent is not None else 0.0)


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page that have text, in page order."""
    root = Element("html", None, 0, False, False, False, False)
    stack, out, current = [root], [], Block(root)
    elements = [root]
    links = 0

    def flush() -> None:
        nonlocal current
        if current.parts:
            current.text = " ".join(unescape("".join(current.parts)).split())
            if current.text:
                out.append(current)
        current = Block(next((e for e in reversed(stack) if e.name in BLOCK), root))

    def add(text: str) -> None:
        if text:
            current.parts.append(text)
            if links:
                current.linked += len(text)

    at, unseen = 0, None
    for m in _MARKUP.finditer(html):
        if m.start() < at:
            continue
        if unseen is None:
            add(html[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if unseen is not None:
            continue
        if m["end"]:
            place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if place:
                links -= sum(e.name == "a" for e in stack[place:])
                del stack[place:]
            if name in BLOCK:
                flush()
            continue
        if name in UNSEEN:
            # its content is no markup: go on after its end tag
            end = re.compile(rf"</{re.escape(name)}(?:[\s/][^>]*)?(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if name in BLOCK:
            closing = CLOSES.get(name, ())
            if name not in ("button", "label"):
                closing = (*closing, "p")
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in closing:
                    links -= sum(e.name == "a" for e in stack[i:])
                    del stack[i:]
                elif stack[i].name in BLOCK and stack[i].name not in ("p",):
                    break
        if name == "br":
            add(" ")
        elif name not in VOID:
            stack.append(_element(name, m["attrs"] or "", stack[-1]))
            elements.append(stack[-1])
            links += name == "a"
        if name in BLOCK:
            flush()
    if at < len(html):
        add(html[at:])
    flush()
    _judge(elements, out)
    return out


def scores(blocks: list[Block]) -> list[float]:
    """Log-odds that a block is content."""
    in_main = sum(len(b.text) for b in blocks if b.element.main and not b.element.against)
    has_main = in_main > 0
    out = []
    for b in blocks:
        words = b.text.count(" ") + 1
        s = 0.9 * math.log2(1 + words) - 2.0
        s -= 4.0 * min(1.0, b.linked / max(1, len(b.text)))
        s += 0.5 * b.text.endswith((".", "!", "?", "…", "。", '"', "”"))
        if b.element.name in HEADINGS:
            s += 1.0
        elif b.element.name in ("p", "blockquote", "pre"):
            s += 0.5
        elif b.element.name in ("li", "td", "th", "dt", "dd"):
            s -= 0.3
        if b.element.against:
            s -= b.element.against
        elif b.element.main:
            s += 5.0
        elif has_main:
            s -= OUTSIDE + 0.9 * math.log2(1 + words)
        out.append(s)
    return out


def _depth_in_common(x: Element, y: Element) -> int:
    a, b = x, y
    while a.depth > b.depth:
        a = a.parent
    while b.depth > a.depth:
        b = b.parent
    while a is not b:
        a, b = a.parent, b.parent
    return a.depth


def edges(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness: between successive blocks, by the share of the path they have in
    common, and between successive blocks of one parent element."""
    out, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            x, y = blocks[i - 1].element, b.element
            shared = _depth_in_common(x, y) / max(1, x.depth, y.depth)
            out.append((i - 1, i, 1.2 * shared * shared))
        parent = id(b.element.parent)
        if parent in last and last[parent] != i - 1:
            j = last[parent]
            out.append((j, i, 0.6 if blocks[j].element.name == b.element.name else 0.3))
        last[parent] = i
    return out


def min_cut(score: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the source side.  Positive scores are capacities from
    the source, negative ones to the sink; links have theirs both ways (Dinic)."""
    n = len(score)
    if all(s > 0 for s in score) or all(s <= 0 for s in score):
        return [s > 0 for s in score]
    source, sink = n, n + 1
    graph: list[list[int]] = [[] for _ in range(n + 2)]
    to, cap = [], []

    def link(u: int, v: int, there: float, back: float) -> None:
        graph[u].append(len(to))
        to.append(v)
        cap.append(there)
        graph[v].append(len(to))
        to.append(u)
        cap.append(back)

    for i, s in enumerate(score):
        if s > 0:
            link(source, i, s, 0.0)
        elif s < 0:
            link(i, sink, -s, 0.0)
    for u, v, w in links:
        if w > 0:
            link(u, v, w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in graph[u]:
                if cap[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        turn = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                push = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= push
                    cap[e ^ 1] += push
                cut = next(k for k, e in enumerate(path) if cap[e] <= tiny)
                u = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while turn[u] < len(graph[u]):
                e = graph[u][turn[u]]
                if cap[e] > tiny and level[to[e]] == level[u] + 1:
                    break
                turn[u] += 1
            if turn[u] < len(graph[u]):
                path.append(graph[u][turn[u]])
                u = to[path[-1]]
            elif path:
                level[u] = -1
                u = to[path.pop() ^ 1]
            else:
                break


def main_text(html: str) -> str:
    blocks = blocks_of(html)
    keep = min_cut(scores(blocks), edges(blocks))
    if not any(keep):  # a page of a few plain words: all that is no aside and no list of links
        keep = [not b.element.against and 2 * b.linked < len(b.text) for b in blocks]
    return "\n".join(b.text for b, k in zip(blocks, keep) if k)


def extract_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    ship_package(pages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": [main_text(h) for h in batch["html"]]})

    narrow = pages.select(F.col(id_col).cast("string").alias("page_id"), F.col("url").cast("string").alias("url"), text_of(html_col).alias("html"))
    return narrow.mapInPandas(run, "page_id string, url string, text string").select(
        F.col("page_id").cast("long").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars")
    )
