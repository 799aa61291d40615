"""Main text of web pages by a minimum cut.

A page becomes a sequence of text blocks with their place in the element tree.
A linear classifier gives each block a cost for either label (content or
boilerplate), which become capacities to the source and the sink. Blocks that
follow each other, and consecutive blocks under one parent, are tied by edges
that weaken with their distance in the tree, with the difference of their
share of links, and where one is inside an article or a margin element and the
other is not. The minimum cut, found by maximum flow, is the cheapest
labelling; blocks on the source side are the text. Costs and ties are of one
size, so a heading, list item or short line that says little by itself goes
with the blocks around it. Blocks whose own cost outweighs all their ties are
settled before the flow.

What an element says of its text (a form, a class name) counts less the more
of the page's words it holds: what holds nearly all of them is the page.
Names of comments, adverts and the like count in full.

A page needs no other page: extraction is one pass without a shuffle.

Results in odd cases: null or empty html, or a page without content, has an
empty text; cut-off or badly nested markup is read as far as it goes; repeated
rows are extracted alike; an empty table gives an empty table; other columns
are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import record_batch, small_batches, tidy

# Element names of HTML by their role here.
HIDDEN = ["script", "style", "noscript", "template", "svg", "math", "textarea", "select", "iframe", "object",
          "canvas", "audio", "video", "title", "datalist"]
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
BLOCK = set("""html head body main article section aside nav header footer div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd
table thead tbody tfoot tr td th caption pre blockquote figure figcaption form fieldset legend label address hr details
summary dialog menu center""".split())
#: An opening tag ends these open elements.
ENDS = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
        "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
MARGIN = {"nav", "aside", "footer", "header", "menu", "form", "dialog", "fieldset", "label"}
MARGIN_ROLES = {"navigation", "banner", "contentinfo", "complementary", "form", "search", "dialog", "alert", "menu",
                "menubar", "toolbar"}
MARGIN_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?\w*|advertis\w+|sponsor\w*|promo\w*|banner\w*|side-?bar\w*|menu\w*|nav\w*|footer\w*|"
    r"masthead|comments?\w*|replies|disqus\w*|cookie\w*|consent|gdpr|notices?|notification\w*|alert\w*|popup\w*|modal|"
    r"overlay|newsletter|subscri\w+|sign-?up|login|search\w*|shar(?:e|ing)\w*|social\w*|recommend\w*|"
    r"breadcrumbs?|pagination|pager|widget\w*|toolbar|copyright|disclaimer|legal)(?:$|[\s_-])", re.I)
#: Names of what is no content even where it holds article elements.
FOREIGN_NAMES = re.compile(
    r"^(?:(?:ads?|adverts?\w*|advertis\w+|sponsor\w*|promo\w*|comments?\w*|replies|(?:reader-?)?reactions|disqus\w*|recommend\w*)"
    r"(?:$|[_-])|related(?:$|[_-]?(?:posts?|articles?|stories|links|content|news|items|topics|reading|products|pages|videos)))", re.I)
#: A name of a state, not of what the element is; and a name whose last word is an article's.
STATE_NAMES = re.compile(r"^(?:has|is|no|with|js)[_-]|[_-](?:open|closed|enabled|disabled|visible|active|on|off)$", re.I)
STORY_NAMES = re.compile(r"[_-](?:story|article|post|entry)$", re.I)
HEADER_NAMES = re.compile(r"(?:^|[\s_-])(?:site-?)?header(?:$|[\s_-])", re.I)
CONTENT_NAMES = re.compile(r"(?:^|[\s_-])(?:article\w*|content|post|entry|story|main|body|text)(?:$|[\s_-])", re.I)

#: Weights of the classifier (log-odds of content). What is outside an article loses by the share of words inside.
W_BASE, W_ARTICLE, W_OUTSIDE, W_NAMED, W_MARGIN, W_FOREIGN, W_UNSEEN = -0.3, 1.0, -2.5, 0.75, -4.0, -8.0, -20.0
W_WORDS, MAX_WORDS, W_SENTENCE, W_LINKS, W_RIGHTS = 0.05, 30, 0.4, -4.0, -3.0
W_TAG = {"p": 0.6, "pre": 0.6, "blockquote": 0.5, "h1": 0.4, "h2": 0.4, "h3": 0.4, "td": -0.1, "th": -0.1}
#: Shares of the page's words between which a margin element loses its weight.
WHOLE_FROM, WHOLE_TO = 0.7, 0.95
#: Smoothness: neighbours in the page, halved by each step in the tree beyond two, consecutive blocks of one parent,
#: what is left of a tie across the edge of an article or a margin element, and what a difference in links takes off.
S_NEXT, S_SIBLING, S_ACROSS, S_LINKS = 2.0, 1.0, 0.3, 0.5
RIGHTS = re.compile(r"(?:©|\(c\)|copyright\b|all rights reserved)", re.I)

#: A button without an end tag before the next button ends with the block around it.
BLOCK_TAG = rf"</?(?:{'|'.join(sorted(BLOCK))})(?![a-z0-9:-])"
#: A hidden element goes up to its end tag; svg and math may close themselves.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:svg|math)(?![a-z0-9:-])(?>[^>\"'/]+|\"[^\"]*\"|'[^']*'|/(?!>))*+/>"
    rf"|<button(?![a-z0-9:-])(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+>"
    rf"(?:(?:(?!<button(?![a-z0-9:-])).)*?</button\s*>|(?:(?!{BLOCK_TAG}).)*+)"
    r"|<(" + "|".join(HIDDEN) + r")(?![a-z0-9:-])(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-z][a-z0-9:-]*)([^>]*)>"
    r"|<[!?][^>]*(?:>|\Z)|<[a-z/][^>]*\Z", re.S | re.I)
#: Every attribute with its value, so that no name is found inside another name or a value.
ATTRIBUTE = re.compile(r"\"[^\"]*\"|'[^']*'|([^\s\"'<>/=]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


class Element:
    """An open block element: depth, parent and what it says of its text."""

    __slots__ = ("tag", "parent", "depth", "holds", "inside", "own", "article", "margin", "named", "unseen", "words", "last")

    def __init__(self, tag: str, parent: Element | None, attributes: str = ""):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.named = parent.named if parent else False
        self.unseen = parent.unseen if parent else False
        self.words = 0  # outside links, in all its blocks
        self.last = -1  # last block right under it
        self.article, self.margin = False, 0.0  # see weigh
        around = parent.inside if parent else False
        self.holds = tag in ("article", "main")
        self.own = 0  # 1: margin by element or name, 2: by a role or a foreign name
        names = []
        for name, a, b, c in ATTRIBUTE.findall(attributes) if attributes else ():
            name, value = name.lower(), a or b or c
            if name in ("class", "id"):
                names += value.split()
            elif name == "role":
                if value.lower() in MARGIN_ROLES:
                    self.own = 2
                self.holds |= value.lower() in ("main", "article")
            elif name == "itemprop":
                self.holds |= value.lower() == "articlebody"
            elif name == "style":
                self.unseen |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                self.unseen = True
        whole = tag in ("html", "body")  # names of the page or of the article say what else is there
        for value in names:
            if STATE_NAMES.search(value):
                continue
            if FOREIGN_NAMES.search(value) and not whole:
                self.own = max(self.own, 1 if self.holds and STORY_NAMES.search(value) else 2)
            elif not (whole or self.holds) and (MARGIN_NAMES.search(value) or (not around and HEADER_NAMES.search(value))):
                self.own = max(self.own, 1)
            elif CONTENT_NAMES.search(value):
                self.named = True
        if not self.holds and tag in MARGIN and not (tag == "header" and around):
            self.own = max(self.own, 1)
        self.inside = around or self.holds

    def weigh(self, total: int) -> None:
        """What it says once its words, and its parent, are known."""
        p = self.parent
        self.article, self.margin = p.article, p.margin
        if self.holds and self.margin > W_FOREIGN:  # an unclosed nav or header, or a name around it, does not hold the article
            self.article, self.margin = True, 0.0
        share = self.words / total if total else 0.0
        soft = W_MARGIN * min(1.0, max(0.0, (WHOLE_TO - share) / (WHOLE_TO - WHOLE_FROM)))
        own = (0.0, soft, W_FOREIGN)[self.own]
        if own < 0:
            self.article, self.margin = False, min(self.margin, own)


def blocks(page: str) -> list[tuple[str, Element, float]]:
    """(text, element, share of code points inside links) of every text block in page order."""
    out: list[tuple[str, Element, float]] = []
    top = Element("", None)
    elements: list[Element] = []
    parts: list[str] = []
    linked = link_size = 0
    at = 0

    def close() -> None:
        nonlocal link_size, linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                links = min(1.0, link_size / len(text))
                top.words += round((text.count(" ") + 1) * (1 - links))
                out.append((text, top, links))
            parts.clear()
        link_size = linked = 0

    for m in TOKEN.finditer(page):
        if m.start() > at:
            text = page[at:m.start()]
            parts.append(text)
            if linked:
                link_size += len(text)
        at = m.end()
        tag = m[3] or m[6]
        if not tag:
            continue
        tag, ending = tag.lower(), m[2] or m[5]
        if tag == "a":
            linked = 0 if ending else 1
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCK:
            close()
            if tag in VOID:
                continue
            if ending:
                e = top
                while e.parent and e.tag != tag:
                    e = e.parent
                if e.parent:
                    top = e.parent
                continue
            ends = ENDS.get(tag, ("p",))
            while top.tag in ends:
                top = top.parent
            top = Element(tag, top, m[4] or m[7] or "")
            elements.append(top)
    if at < len(page):
        parts.append(page[at:])
    close()
    for e in reversed(elements):
        e.parent.words += e.words
    total = next((e.parent.words for e in elements), 0)  # of the page: the first element lies right under the root
    for e in elements:
        e.weigh(total)
    return out


def cost(text: str, e: Element, links: float, inside: float) -> float:
    """Log-odds of being content; ``inside``: share of the page's words in articles."""
    c = W_BASE + W_WORDS * min(MAX_WORDS, text.count(" ") + 1) + W_TAG.get(e.tag, 0.0) + W_LINKS * links + e.margin
    if text[-1] in ".!?:…\"”»":
        c += W_SENTENCE
    c += W_ARTICLE if e.article else W_OUTSIDE * inside
    if e.named:
        c += W_NAMED
    if e.unseen:
        c += W_UNSEEN
    if RIGHTS.match(text):
        c += W_RIGHTS
    return c


def distance(a: Element, b: Element) -> int:
    """Steps between two elements in the tree."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def min_cut(unary: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True: source side) of least cost: a node labelled against the
    sign of its unary pays its size, an edge between different labels its weight."""
    n = len(unary)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in edges:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    label: list[bool | None] = [None] * n
    u = list(unary)
    queue = deque(range(n))
    while queue:  # a node that outweighs its ties has its label in some optimum
        i = queue.popleft()
        if label[i] is not None or abs(u[i]) < sum(near[i].values()):
            continue
        label[i] = u[i] > 0
        for j, w in near[i].items():
            u[j] += w if label[i] else -w
            del near[j][i]
            queue.append(j)
        near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        for i, side in zip(rest, _source_side(rest, u, near)):
            label[i] = side
    return label


def _source_side(rest: list[int], u: list[float], near: list[dict[int, float]]) -> list[bool]:
    """Which of the nodes the source still reaches after a maximum flow, by
    blocking flows over levels."""
    source, sink = -1, -2
    cap: dict[int, dict[int, float]] = {i: dict(near[i]) for i in rest}
    cap[source], cap[sink] = {}, {}
    for i in rest:
        if u[i] > 0:
            cap[source][i], cap[i][source] = u[i], 0.0
        else:
            cap[i][sink], cap[sink][i] = -u[i], 0.0
    while True:
        level = {source: 0}
        bfs = deque([source])
        while bfs:
            i = bfs.popleft()
            for j, c in cap[i].items():
                if c > 1e-9 and j not in level:
                    level[j] = level[i] + 1
                    bfs.append(j)
        if sink not in level:
            return [i in level for i in rest]
        onward = {i: iter(list(cap[i])) for i in level}
        path = [source]
        while path:
            i = path[-1]
            if i == sink:
                flow = min(cap[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    cap[a][b] -= flow
                    cap[b][a] += flow
                # back to before the first edge that is full; its start looks for another way
                path = path[:next(k for k in range(1, len(path)) if cap[path[k - 1]][path[k]] <= 1e-9)]
                continue
            j = next((j for j in onward[i] if cap[i][j] > 1e-9 and level.get(j) == level[i] + 1), None)
            if j is None:
                path.pop()
            else:
                path.append(j)


def label_blocks(page: str) -> tuple[list[str], list[float], list[bool]]:
    """Text, own cost and label (True: content) of every block."""
    found = blocks(page)
    words = [(text.count(" ") + 1) * (1 - links) for text, _, links in found]
    inside = sum(w for w, b in zip(words, found) if b[1].article) / max(1.0, sum(words))
    edges = []

    def tie(i: int, j: int, weight: float) -> None:
        (_, a, x), (_, b, y) = found[i], found[j]
        across = a.article != b.article or (a.margin <= W_MARGIN / 2) != (b.margin <= W_MARGIN / 2)
        weight *= (1 - S_LINKS * abs(x - y)) * (S_ACROSS if across else 1.0)
        if weight > 1e-6:
            edges.append((i, j, weight))

    for i, (_, e, _) in enumerate(found):
        if i:
            tie(i - 1, i, S_NEXT * 0.5 ** min(60, max(0, distance(found[i - 1][1], e) - 2)))
        parent = e.parent or e
        if parent.last >= 0:
            tie(parent.last, i, S_SIBLING)
        parent.last = i
    unary = [cost(*b, inside) for b in found]
    return [b[0] for b in found], unary, min_cut(unary, edges)


def extract(page: str) -> tuple[list[str], int, int]:
    """Content blocks of a page in order, the number of all blocks, and of
    those whose label is not the one of their own cost."""
    texts, unary, label = label_blocks(page)
    changed = sum((u > 0) != x for u, x in zip(unary, label))
    return [t for t, kept in zip(texts, label) if kept], len(texts), changed


RESULT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_blocks", pa.int64()),
                    ("n_kept", pa.int64()), ("n_changed", pa.int64())])


def _extract_all(batches):
    for batch in batches:
        ids, urls = batch.column("page_id").to_pylist(), batch.column("url").to_pylist()
        pages = batch.column("html")
        for at in range(0, len(ids), 500):
            rows = [extract(p or "") for p in pages[at:at + 500].to_pylist()]
            yield record_batch(RESULT, page_id=ids[at:at + 500], url=urls[at:at + 500],
                               text=["\n".join(kept) for kept, _, _ in rows], n_blocks=[n for _, n, _ in rows],
                               n_kept=[len(kept) for kept, _, _ in rows], n_changed=[n for _, _, n in rows])


def html_extraction(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_blocks, n_kept and n_changed (labels that the cut
    turned against the block's own cost) for every row of ``pages``."""
    small_batches(pages.sparkSession)
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return pages.mapInArrow(tidy(_extract_all), "page_id long, url string, text string, n_blocks long, n_kept long, n_changed long")


def op1_html_extraction(spark, sf_dir: str) -> DataFrame:
    out = html_extraction(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
