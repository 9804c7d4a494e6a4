"""Main text of web pages by minimum cut.

A page becomes blocks of text in page order.  A classifier gives each block a cost for
being called content and one for being called boilerplate: a logistic model of its shape
(words, links, sentence ends, element), fitted on pages whose markup names their regions,
and the innermost element that names a region.  A name is evidence of about the weight of
the shape, so neighbours and shape may outvote it; only what the page hides is out for
certain.  The costs are the capacities of terminal edges; blocks next to each other and
blocks of one parent get smoothness edges, weaker across regions.  The minimum cut, found
as maximum flow by levels, separates content from the rest.  A block whose costs are equal
and that no edge ties to content is boilerplate.

One narrow pass over whole pages.  The model is fitted in one task on a bounded sample,
the ``sample`` pages with the smallest hash of their id; without usable samples its weights
are zero.  Null or empty html gives an empty text; repeated rows are read each.  Only
``page_id``, ``url`` and ``html`` are read, whatever other columns there are.  A page's work
grows with its length and, for blocks that names do not settle, with the rounds of the flow.
"""

from __future__ import annotations

import html
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import arrow_map, sampled, slices

SAMPLE = 1000

# Elements of HTML by what they do to the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|title|iframe"  # only their end tag ends them
HIDDEN = "template|noscript|svg|math|object|canvas|select|audio|video"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
CLOSES = {  # an opening element that ends the open one
    **dict.fromkeys("p div article section aside nav header footer main ul ol dl table form h1 h2 h3 h4 h5 h6 pre blockquote figure hr address fieldset details".split(), {"p"}),
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"},
}
BARRIER = frozenset("ul ol dl table article section aside nav header footer main div form body blockquote".split())
BAD_TAGS = frozenset("nav footer aside form button dialog menu fieldset".split()) | frozenset(HIDDEN.split("|"))
GOOD_TAGS = frozenset("article main".split())
BAD_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts banner sponsor sponsored promo promotion nav navigation navbar menu menubar breadcrumb "
    "breadcrumbs sidebar aside footer foot masthead topbar toolbar comment comments commentlist reply replies respond discussion disqus cookie "
    "cookies consent gdpr notice notices notification alert popup modal overlay dialog newsletter subscribe subscription signup login share "
    "sharing social related recommended recommendations trending popular pagination pager skip search tags widget form feedback copyright "
    "contentinfo complementary".split()
)
GOOD_WORDS = frozenset("article articlebody content main post entry story".split())
# Class names such as has-sidebar, no-comments, category-social or comments-open tell of the
# layout or the topic: what follows the first kind of word, and what the second kind ends, is no name.
LAYOUT_WORDS = frozenset("no not has with without is layout category tag".split())
STATE_WORDS = frozenset("open closed enabled disabled off".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<closed>svg|math)(?:\s(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?<=[\s\"']))?/>"
    # Whole ones; those that hold one of their kind or have no end tag are ordinary elements of boilerplate.
    rf"|<(?P<hidden>{HIDDEN})(?=[\s/>])[^>]*>(?:(?!</?(?P=hidden)[\s/>]).)*</(?P=hidden)\s*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>[^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\s*(?=[;!]|$)", re.IGNORECASE)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

NAMED, SHAPE_LIMIT, UNSEEN_COST = 3.5, 3.0, 100.0
NEXT, SIBLING, ACROSS = 0.6, 0.6, 0.15


class Block:
    __slots__ = ("text", "words", "linked", "parent", "tag", "region", "sign")

    def __init__(self, text, linked, node):
        self.text, self.words, self.linked = text, text.count(" ") + 1, linked
        self.parent, self.tag, self.region, self.sign = node.parent, node.tag, node.region, node.sign


class Element:
    """An open element: where it stands and the region it lies in."""

    __slots__ = ("tag", "parent", "region", "sign")

    def __init__(self, tag, parent, sign=0):
        self.tag, self.parent = tag, parent
        if sign:
            self.region, self.sign = self, sign
        else:
            self.region, self.sign = (parent.region, parent.sign) if parent else (None, 0)


def names_of(value: str) -> set[str]:
    """Words of a class, id or role value that may name a region."""
    found: set[str] = set()
    for name in value.split():
        words = [w for w in re.split("[^a-z]+", CAMEL.sub(" ", name).lower()) if w]
        if words and words[-1] not in STATE_WORDS:
            found.update(itertools.takewhile(lambda w: w not in LAYOUT_WORDS, words))
    return found


def sign_of(tag: str, attrs: str, above: Element) -> int:
    """1 or -1 where the element itself names a region of content or of boilerplate, -2
    where it is hidden.  ``main`` is content whatever its classes, an outermost ``article`` too."""
    if above.sign == -2:
        return -2
    sign = -1 if tag in BAD_TAGS or tag == "header" and above.sign <= 0 else 1 if tag in GOOD_TAGS else 0
    words: set[str] = set()
    for match in ATTRIBUTE.finditer(attrs):
        name, value = match[1].lower(), match[2] or match[3] or match[4] or ""
        if name in ("class", "id", "role"):
            words |= names_of(value)
        elif (
            name == "hidden" and value.strip().lower() != "until-found"
            or name == "aria-hidden" and value.strip().lower() == "true"
            or name == "style" and UNSEEN.search(html.unescape(value))
        ):
            return -2
    if tag == "main" or tag == "article" and (above.sign == 0 or words & GOOD_WORDS - {"article"}):
        return sign
    if words & BAD_WORDS or "header" in words and above.sign <= 0 and tag != "body":
        return -1
    if words & GOOD_WORDS and sign == 0 and tag != "body":
        return 1
    return sign


def blocks_of(page: str) -> list[Block]:
    root = Element("body", None)
    now, out, parts, linked, link = root, [], [], 0, 0
    at = 0

    def flush():
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            node = now
            while node.tag in INLINE and node.parent:
                node = node.parent
            out.append(Block(text, linked, node))
        parts.clear()
        linked = 0

    def say(text):
        nonlocal linked
        parts.append(text)
        if link:
            linked += len(text.split())

    for match in TOKEN.finditer(page):
        if match.start() > at:
            say(page[at:match.start()])
        at = match.end()
        tag = (match["tag"] or match["tag2"] or "").lower()
        if not tag:
            continue
        if tag == "br":
            say(" ")
        elif match["end"] or match["end2"]:
            if tag not in INLINE:
                flush()
            link -= tag == "a" and link > 0
            node = now
            while node is not root and node.tag != tag:
                if tag in INLINE and node.tag not in INLINE:
                    node = root
                    break
                node = node.parent
            if node is not root:
                now = node.parent
        elif tag in VOID:
            if tag not in INLINE and tag != "img":
                flush()
        else:
            if tag not in INLINE:
                flush()
                ended, node = CLOSES.get(tag, ()), now
                while node is not root and node.tag not in ended and node.tag not in BARRIER:
                    node = node.parent
                if node is not root and node.tag in ended:
                    now = node.parent
                    if now.tag in ended:  # a paragraph inside the item that ends
                        now = now.parent
            link += tag == "a"
            now = Element(tag, now, sign_of(tag, match["attrs"] or "", now)) if tag not in ("html", "head", "body") else now
    if at < len(page):
        say(page[at:])
    flush()
    return out


def shape(block: Block) -> tuple[float, ...]:
    return (
        1.0, min(np.log1p(block.words), 6.0), min(block.linked / block.words, 1.0), float(block.text[-1] in ".!?…\"'»”"),
        float(block.tag in ("p", "h1", "h2", "h3", "blockquote", "pre")), float(block.tag in ("li", "td", "th", "a", "dt", "dd")),
    )


def fit(pages: pd.DataFrame) -> pd.DataFrame:
    """Logistic weights of the shape, from blocks whose region is named; Newton steps with a ridge."""
    blocks = [b for page in pages["html"] for b in blocks_of(page or "") if b.sign in (1, -1)]
    weights = np.zeros(6)
    if {b.sign for b in blocks} == {1, -1}:
        x, y = np.array([shape(b) for b in blocks]), np.array([b.sign > 0 for b in blocks], float)
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.eye(6), x.T @ (p - y) + weights)
            weights = weights - np.clip(step, -2, 2)
    return pd.DataFrame({"weights": [weights.tolist()]})


def min_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay on the source's side; ``odds`` are terminal capacities, by sign.

    Maximum flow in rounds: levels from all nodes with room from the source, then paths
    that climb them, each edge tried once a round."""
    n, least = len(odds), 1e-9
    rest = list(odds)  # above zero: room from the source; below: room to the sink
    room: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, weight in edges:
        room[a][b] = room[a].get(b, 0.0) + weight
        room[b][a] = room[b].get(a, 0.0) + weight
    ways = [list(r) for r in room]
    while True:
        sources = [i for i in range(n) if rest[i] > least]
        level, line, met = [-1] * n, list(sources), False
        for a in sources:
            level[a] = 0
        for a in line:
            if rest[a] < -least:
                met = True
                continue
            for b in ways[a]:
                if level[b] < 0 and room[a][b] > least:
                    level[b] = level[a] + 1
                    line.append(b)
        if not met:
            return [x >= 0 for x in level]
        tried = [0] * n
        for start in sources:
            path = [start]
            while path:
                a = path[-1]
                if rest[a] < -least:
                    flow = min(rest[start], -rest[a], *(room[x][y] for x, y in zip(path, path[1:])))
                    for x, y in zip(path, path[1:]):
                        room[x][y] -= flow
                        room[y][x] += flow
                    rest[start] -= flow
                    rest[a] += flow
                    path = [start] if rest[start] > least else []
                elif tried[a] < len(ways[a]):
                    b = ways[a][tried[a]]
                    if level[b] == level[a] + 1 and room[a][b] > least:
                        path.append(b)
                    else:
                        tried[a] += 1
                else:
                    path.pop()
                    if path:
                        tried[path[-1]] += 1


def content(blocks: list[Block], weights: list[float]) -> list[bool]:
    odds, edges = [], []
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        own = sum(w * x for w, x in zip(weights, shape(block)))
        named = -UNSEEN_COST if block.sign == -2 else NAMED * block.sign
        odds.append(max(-SHAPE_LIMIT, min(SHAPE_LIMIT, own)) + named)
        if i:
            edges.append((i - 1, i, NEXT if blocks[i - 1].region is block.region else ACROSS))
        before = last.get(id(block.parent))
        if before is not None:
            edges.append((before, i, SIBLING if blocks[before].region is block.region else ACROSS))
        last[id(block.parent)] = i
    if all((odds[a] > 0) == (odds[b] > 0) for a, b, _ in edges) and all(odds):
        return [x > 0 for x in odds]  # no edge to cut
    return min_cut(odds, edges)


def main_text(page: str, weights: list[float]) -> str:
    blocks = blocks_of(page)
    return " ".join(b.text for b, kept in zip(blocks, content(blocks, weights)) if kept)


def train(pages: DataFrame, sample: int = SAMPLE) -> list[float]:
    rows = pages.select(F.col("page_id").cast("string").alias("page_id"), F.col("html").cast("string").alias("html"))
    rows = sampled(rows.where("html IS NOT NULL"), sample, "page_id").orderBy(F.xxhash64("page_id"), "page_id", F.xxhash64("html")).limit(sample)
    found = rows.select("html").groupBy().applyInPandas(fit, "weights array<double>").collect()
    return list(found[0].weights) if found else [0.0] * 6


def extract(pages: DataFrame, weights: list[float]) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            texts = [main_text(page or "", weights) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return arrow_map(rows, work, "page_id long, url string, text string, n_chars long")
