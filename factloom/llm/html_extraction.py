"""Main-text extraction from HTML by minimum-cut labelling of blocks.

A page is read into blocks (runs of text between block-level tags) that know
the elements around them. A log-linear classifier gives each block log-odds of
being content: what its containers say (HTML's own elements and roles, words of
class names), and what its text says (length, links, sentences, few words). The
text's weights and the strength of the edges are fitted on a bounded sample of
pages whose elements tell content from boilerplate. The log-odds become the
capacities of a block's edges to the two terminals. Edges between neighbouring
blocks, and between successive blocks of one parent, are the smoothness costs,
less the further apart the blocks stand in the tree. Max-flow separates content
from boilerplate; blocks still reachable from the content terminal are the main
text. Where elements say nothing, neighbours thus decide for short or odd
blocks; what elements say outright outweighs any neighbours.

White space within a block, line breaks included, becomes one space; blocks are
trimmed, empty ones dropped, the rest joined in page order by one newline.
Scripts, styles, comments and other markup never become text. Null and empty
html give the empty text; so do pages without a content block. A block on both
sides of a tie goes to the boilerplate. Repeated pages are read one by one.
Broken markup is read as far as it makes sense: unclosed elements end with the
page. Pages of any length are read in time nearly linear in it. Other columns,
whatever their names, are left aside. An empty table gives an empty table.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter, deque
from itertools import islice, pairwise

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.shared import bounded_batches

# Elements of the HTML standard by what they do to the flow of text.
BLOCK = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe object svg math canvas audio video".split())
BREAKS = {"br", "wbr", "img", "input"}
CLOSES_P = BLOCK - {"option", "optgroup", "html", "body", "head"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}

# What containers say, as log-odds of content.
TAG_WEIGHT = {"article": 4.0, "main": 3.0, "nav": -9.0, "footer": -9.0, "aside": -9.0, "header": -7.0, "form": -9.0, "fieldset": -4.0, "button": -9.0, "select": -9.0, "menu": -7.0, "dialog": -9.0, "search": -9.0, "head": -9.0}
NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adsense|adbox|banner|sidebar|side-bar|nav|navbar|navigation|menu|topbar|toolbar|footer|header|masthead|comments?|commentlist|"
    r"disqus|replies|reply|respond|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|promo|promotion|sponsor|sponsored|share|sharing|social|related|recommended|"
    r"breadcrumbs?|newsletter|subscribe|subscription|signup|login|widget|pagination|pager|copyright|disclaimer|toc|hidden|sr-only)(?:$|[\s_-]|\d)",
    re.I,
)
GOOD = re.compile(r"(?:^|[\s_-])(?:article|content|main|post|entry|story|body|text|prose)(?:$|[\s_-]|\d)", re.I)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar", "form"}
NOISE_WEIGHT, GOOD_WEIGHT = -9.0, 2.0
# What texts say, before any page has been seen: a constant, hundreds of characters (4 at most), share in links, sentences
# (3 at most), fewer than four words; then the strength of the edges.
FIRST_WEIGHTS, FIRST_EDGE = (-0.5, 0.6, -3.0, 0.5, -0.3), 1.0
EDGES = (0.25, 0.5, 1.0, 1.5, 2.0)  # strengths tried; what two neighbours and two siblings say stays below NOISE_WEIGHT
SAMPLE_PAGES, SAMPLE_CHARS = 400, 1 << 16  # the fit reads so many pages at most, none of them longer

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>|<[!?/a-zA-Z][^>]*\Z", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_SENTENCE = re.compile(r"[.!?…。！？](?:\s|$)")


class Block:
    """One run of text: its length in links, its parent's number, its depth, how much of that it shares with the block before, and its containers' log-odds."""

    __slots__ = ("common", "depth", "linked", "logit", "parent", "text")

    def __init__(self, text: str, linked: int, parent: int, depth: int, common: int, logit: float):
        self.text, self.linked, self.parent, self.depth, self.common, self.logit = text, linked, parent, depth, common, logit


def _element_weight(tag: str, attributes: str) -> float:
    weight = TAG_WEIGHT.get(tag, 0.0)
    if attributes and not attributes.isspace():
        found = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
        names = f"{found.get('class', '')} {found.get('id', '')}"
        if tag not in ("html", "body", "article", "main"):
            if NOISE.search(names):
                weight += NOISE_WEIGHT
            elif GOOD.search(names):
                weight += GOOD_WEIGHT
        role = found.get("role", "").lower()
        if role in ROLES:
            weight += NOISE_WEIGHT
        elif role in ("main", "article"):
            weight += 3.0
        if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
            weight += NOISE_WEIGHT
    return weight


def blocks_of(page: str) -> list[Block]:
    """The page's blocks in order, each with its containers' part of the log-odds."""
    blocks: list[Block] = []
    stack: list[tuple[str, int, float]] = []  # tag, number, weight of all up to here
    opened: Counter[str] = Counter()  # tags on the stack
    pieces: list[str] = []
    links = linked = numbers = common = 0
    lowered: str | None = None

    def flush() -> None:
        nonlocal pieces, linked, common
        if pieces:
            text = " ".join(_html.unescape("".join(pieces)).split())
            if text:
                blocks.append(Block(text, linked, stack[-2][1] if len(stack) > 1 else 0, len(stack), common, stack[-1][2] if stack else 0.0))
                common = len(stack)
            pieces, linked = [], 0

    def close(at: int) -> None:
        nonlocal common
        for entry in stack[at:]:
            opened[entry[0]] -= 1
        del stack[at:]
        common = min(common, at)

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        upto = m.start() if m else size
        if upto > at:
            text = page[at:upto]
            pieces.append(text)
            if links:
                linked += len(text.strip())
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        ending, attributes = bool(m[1] or m[4]), m[3] if m[2] else m[6]
        if ending:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCK or opened[tag]:
                flush()
                if opened[tag]:
                    close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
            continue
        if tag in RAW:
            if attributes.rstrip().endswith("/") and tag in ("svg", "math"):
                continue
            if lowered is None:
                lowered = page.lower()
                if len(lowered) != size:  # some letters change length in lower case
                    lowered = "".join(c.lower() if c.isascii() else c for c in page)
            end = lowered.find(f"</{tag}", at)
            if end == -1:
                at = size if tag in ("script", "style", "title", "textarea") else at
            else:
                close_at = page.find(">", end)
                at = size if close_at == -1 else close_at + 1
            pieces.append(" ")
            continue
        if tag in BREAKS:
            pieces.append(" ")
            continue
        if tag == "a":
            links += 1
            continue
        if tag in BLOCK:
            flush()
            if tag in CLOSES_P and opened["p"]:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p":
                        close(i)
                        break
                    if stack[i][0] in ("article", "section", "div", "td", "li", "body"):
                        break
            if any(opened[t] for t in SAME.get(tag, ())):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in SAME[tag]:
                        close(i)
                        break
                    if stack[i][0] in SCOPE[tag]:
                        break
            if tag == "body":
                close(0)
            links = 0
        elif tag not in ("button", "label", "dialog") and not _marked(attributes):
            continue  # inline elements that say nothing of where they stand
        else:
            flush()
        if tag in VOID:
            continue
        numbers += 1
        before = stack[-1][2] if stack else 0.0
        weight = _element_weight(tag, attributes)
        if tag == "header" and (opened["article"] or opened["main"]):
            weight = max(weight, -1.0)  # an article's own heading
        if weight > 0:
            weight = max(before, weight) if before > 0 else before + weight * (before > NOISE_WEIGHT / 2)
        else:
            weight = min(before, 0.0) + weight if weight < -3 else before + weight
        if not (attributes.endswith("/") and tag not in BLOCK):
            stack.append((tag, numbers, weight))
            opened[tag] += 1
    flush()
    return blocks


def _marked(attributes: str) -> bool:
    return bool(attributes) and ("class" in attributes or "hidden" in attributes or "role" in attributes or "display" in attributes) and _element_weight("span", attributes) < 0


def text_features(block: Block) -> tuple[float, ...]:
    """What the text's weights are for."""
    sentences = sum(1 for _ in islice(_SENTENCE.finditer(block.text), 3))
    few = block.text.count(" ", 0, 200) < 3
    return (1.0, min(4.0, len(block.text) / 100), min(1.0, block.linked / len(block.text)), float(sentences), float(few))


def log_odds(block: Block, weights: tuple[float, ...] = FIRST_WEIGHTS) -> float:
    """Log-odds that the block is content: what its text and what its containers say."""
    return sum(w * x for w, x in zip(weights, text_features(block), strict=True)) + block.logit


def content_blocks(blocks: list[Block], weights: tuple[float, ...] = FIRST_WEIGHTS, edge: float = FIRST_EDGE) -> list[bool]:
    """Which blocks lie on the content side of the minimum cut."""
    caps: list[dict[int, float]] = [{} for _ in blocks]

    def link(i: int, j: int, weight: float) -> None:
        caps[i][j] = caps[i].get(j, 0.0) + weight
        caps[j][i] = caps[j].get(i, 0.0) + weight

    last: dict[int, int] = {}
    for j, block in enumerate(blocks):
        if j:
            link(j - 1, j, edge * 2.0 ** -min(60, max(blocks[j - 1].depth, block.depth) - block.common))
        if block.parent in last:
            link(last[block.parent], j, edge * 0.5)
        last[block.parent] = j
    return minimum_cut([log_odds(b, weights) for b in blocks], caps)


def minimum_cut(odds: list[float], caps: list[dict[int, float]]) -> list[bool]:
    """Which nodes stay on the content side: first those that no neighbours can move, then the rest by max-flow."""
    n = len(odds)
    odds, side = list(odds), [None] * n
    around = [sum(c.values()) for c in caps]
    waiting = [i for i in range(n) if abs(odds[i]) >= around[i]]
    while waiting:
        i = waiting.pop()
        if side[i] is not None:
            continue
        side[i] = odds[i] > 0
        for j, c in caps[i].items():
            if side[j] is None:  # a settled neighbour speaks like a terminal
                odds[j] += c if side[i] else -c
                around[j] -= c
                if abs(odds[j]) >= around[j] - 1e-12:
                    waiting.append(j)
    left = [i for i in range(n) if side[i] is None]
    if left:
        place = {i: x for x, i in enumerate(left)}
        inner = [{place[j]: c for j, c in caps[i].items() if j in place} for i in left]
        for i, found in zip(left, _max_flow([max(0.0, odds[i]) for i in left], [max(0.0, -odds[i]) for i in left], inner), strict=True):
            side[i] = found
    return side


def _max_flow(source: list[float], sink: list[float], caps: list[dict[int, float]]) -> list[bool]:
    """Nodes that stay reachable from the source after blocking flows along shortest paths have been used up."""
    eps, n = 1e-9, len(source)
    while True:
        level = [0 if s > eps else -1 for s in source]
        queue, ends = deque(i for i in range(n) if level[i] == 0), False
        while queue:
            i = queue.popleft()
            ends = ends or sink[i] > eps
            for j, c in caps[i].items():
                if c > eps and level[j] < 0:
                    level[j] = level[i] + 1
                    queue.append(j)
        if not ends:
            return [x >= 0 for x in level]
        tried = [iter(list(c)) for c in caps]
        for start in range(n):
            path = [start]
            while path and source[start] > eps:
                i = path[-1]
                if sink[i] > eps:
                    flow = min(source[start], sink[i], *[caps[a][b] for a, b in pairwise(path)])
                    source[start] -= flow
                    sink[i] -= flow
                    for a, b in pairwise(path):
                        caps[a][b] -= flow
                        caps[b][a] = caps[b].get(a, 0.0) + flow
                    short = next((x for x, (a, b) in enumerate(pairwise(path)) if caps[a][b] <= eps), None)
                    if short is not None:
                        del path[short + 1 :]
                    continue
                step = next((j for j in tried[i] if level[j] == level[i] + 1 and caps[i][j] > eps), None)
                if step is None:
                    path.pop()
                else:
                    path.append(step)


def _told(block: Block) -> int | None:
    """1 or 0 where containers say content or boilerplate outright."""
    return 1 if block.logit >= TAG_WEIGHT["main"] else 0 if block.logit <= NOISE_WEIGHT else None


def fit(pages: list[str]) -> tuple[tuple[float, ...], float]:
    """The text's weights, by logistic regression towards FIRST_WEIGHTS, and the strength of the edges, by how well cuts that see texts and places alone label the same blocks."""
    read = [blocks_of(p) for p in pages]
    known = [(b, _told(b)) for blocks in read for b in blocks if _told(b) is not None]
    y = np.array([t for _, t in known], float)
    if not len(y) or y.min() == y.max():
        return FIRST_WEIGHTS, FIRST_EDGE
    x, first = np.array([text_features(b) for b, _ in known]), np.array(FIRST_WEIGHTS)
    each = np.where(y > 0.5, 0.5 / y.sum(), 0.5 / (len(y) - y.sum())) * min(len(y), 1000)  # both kinds alike
    weights = first.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (each * (p - y)) + (weights - first)
        weights -= np.linalg.solve((x * (each * p * (1 - p))[:, None]).T @ x + np.eye(len(first)), slope)
    found = tuple(float(w) for w in weights) if np.isfinite(weights).all() else FIRST_WEIGHTS

    def right(edge: float) -> float:
        hits = {0: [], 1: []}
        for blocks in read:
            told = [_told(b) for b in blocks]
            bare = [Block(b.text, b.linked, b.parent, b.depth, b.common, 0.0) for b in blocks]
            for t, side in zip(told, content_blocks(bare, found, edge), strict=True):
                if t is not None:
                    hits[t].append(side == bool(t))
        return float(np.mean(hits[0]) + np.mean(hits[1]))

    return found, max(EDGES, key=lambda e: (round(right(e), 6), -e))


def main_text(page: str | None, weights: tuple[float, ...] = FIRST_WEIGHTS, edge: float = FIRST_EDGE) -> str:
    """The main text of one page."""
    if not page:
        return ""
    blocks = blocks_of(page)
    return "\n".join(b.text for b, keep in zip(blocks, content_blocks(blocks, weights, edge), strict=True) if keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row of pages."""
    bounded_batches(pages.sparkSession)
    kept = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    # a share of the hash range that holds some three times as many, of which the first are taken: no more ever reaches the driver
    share = min(1.0, 3 * SAMPLE_PAGES / max(1, kept.count()))
    some = F.shiftrightunsigned(F.xxhash64("page_id", "url"), 11) < int(share * (1 << 53))
    sample = kept.where(some & (F.char_length("html") <= SAMPLE_CHARS)).select("html").limit(SAMPLE_PAGES)
    weights, edge = fit(sorted(r.html for r in sample.collect()))
    types = [f"{c} {kept.schema[c].dataType.simpleString()}" for c in ("page_id", "url")]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(x.as_py(), weights, edge) for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return kept.mapInArrow(run, f"{', '.join(types)}, text string, n_chars long")
