"""Main-text extraction from HTML by minimum cut.

A page is read into text blocks, each with its chain of open elements.  A
linear classifier scores a block (elements and class names around it, length,
share of link text); the score becomes the block's capacity to the source
(content) or the sink (boilerplate).  Blocks that follow each other and
blocks near each other in the tree are joined by edges, the stronger the
nearer.  Maximum flow gives the cheapest labelling.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.textarrays import blocks

_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^"'>])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|</?\Z""", re.S)
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_RAW = {"script", "style", "noscript", "template", "textarea", "svg", "iframe", "title", "select", "object", "canvas", "math"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label",
           "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
_CLOSES_P = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2",
             "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul", "li", "dt", "dd"}
_SIBLING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"ul", "ol", "dl", "table", "menu", "article", "section", "div", "nav", "aside", "main", "body"}

# classifier: log-odds of content
ELEMENT = {"article": 4.0, "main": 3.0, "p": 0.5, "blockquote": 0.5, "pre": 0.5, "h1": 0.8, "h2": 0.5, "h3": 0.5, "li": -0.3, "nav": -9.0, "footer": -9.0,
           "aside": -9.0, "form": -9.0, "menu": -9.0, "header": -6.0, "button": -9.0, "dialog": -9.0, "figcaption": 0.3, "head": -20.0, "fieldset": -6.0}
GOOD_NAME = re.compile(r"\b(?:article|post|entry|story|main|content)(?:[-_]?(?:body|text|content|main|article))?\b", re.I)
BAD_NAME = re.compile(r"(?<![a-z])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|side-?bar|menu|nav\w*|bread-?crumbs?|cookies?\w*|consent|gdpr|notices?|alerts?|newsletter|"
                      r"subscri\w+|sign-?up|share|sharing|social|related|recommend\w*|comments?\w*|respond|replies|disqus|footer|header|masthead|pop-?up|modal|overlay|"
                      r"login|widgets?|toolbar|pagination|pager|copyright|legal|disclaimer|search\w*|complementary|navigation|contentinfo|form)(?![a-z])", re.I)
#: names that say what stands beside an element, or whether it is shown
LAYOUT_NAME = re.compile(r"(?:has|no|with|without|is|not|js|hide|show|can|supports)[-_].*|.*[-_](?:open|opened|closed|enabled|disabled|on|off|visible|hidden|active|collapsed|expanded|allowed|ready)", re.I)
PAGE_WIDE = {"html", "body"}            # their names say nothing of a block
PARDONED = {"form"}                     # elements that may enclose a whole page, too
NAMED = 3.0
BAD_NAMED = -9.0
BIAS, PER_WORD, WORDS, LINKED, SENTENCE = -1.0, 0.08, 30, -4.0, 0.7
NEXT_EDGE, TREE_EDGE = 0.5, 1.2

Block = tuple[str, float, int, int]         # text, score, number of its parent element, depth of that


def _weight(tag: str, attributes: str) -> tuple[float, float]:
    """An element's score, and what of it an article inside may leave out."""
    score = ELEMENT.get(tag, 0.0)
    pardon = score if tag in PARDONED else 0.0
    if attributes and "=" in attributes and tag not in PAGE_WIDE:
        for quoted in _NAMES.findall(attributes):
            own = quoted.strip("\"'").split()
            if BAD_NAME.search(quoted) and (tag == "main" or tag == "article" and not any(map(BAD_NAME.fullmatch, own))):
                continue                                        # 'post has-sidebar': names of the layout
            names = " ".join(name for name in own if not LAYOUT_NAME.fullmatch(name))
            if BAD_NAME.search(names):
                score += BAD_NAMED
                pardon += BAD_NAMED
            elif GOOD_NAME.search(names):
                score += NAMED
    return score, pardon


def text_blocks(html: str) -> tuple[list[Block], list[int]]:
    """The blocks of a page, and the parent of each element by number.

    A main element leaves out what names and forms around it cost: they are
    the layout's ('content-sidebar-wrap').  So does the page's first article
    if no content came before it, and each later one that stands in the same
    elements; articles among comments or related links don't.
    """
    out: list[Block] = []
    parents = [0]
    stack: list[tuple[str, float, int, tuple[int, ...]]] = [("", BIAS, 0, ())]      # tag, score so far, number, costly elements from there up
    cost: dict[int, float] = {}                                 # their costs
    layout: set[int] = set()                                    # those of them that articles leave out
    content = False                                             # whether a block in a content element was found
    text: list[str] = []
    linked = 0
    opened: Counter[str] = Counter()

    def close(keep: int) -> None:
        """Close all but the first elements of the stack."""
        for entry in stack[keep:]:
            opened[entry[0]] -= 1
        del stack[keep:]

    def flush() -> None:
        nonlocal linked, content
        if text:
            joined = "".join(text)
            words = (unescape(joined) if "&" in joined else joined).split()
            if words:
                clean = " ".join(words)
                at = next((e for e in reversed(stack) if e[0] not in _INLINE), stack[0])
                score = stack[-1][1] + PER_WORD * min(len(words), WORDS) + LINKED * min(1.0, linked / len(clean))
                score += SENTENCE if clean[-1] in ".!?…" else 0.0
                out.append((clean, score, at[2], len(stack)))
                content = content or stack[-1][1] > 0
            text.clear()
        linked = 0

    place, size = 0, len(html)
    while place < size:
        mark = _MARKUP.search(html, place)
        piece = html[place:mark.start()] if mark else html[place:]
        if piece:
            text.append(piece)
            if opened["a"]:
                linked += len(piece)
        if not mark:
            break
        place = mark.end()
        end, tag, attributes = (mark[1], mark[2], mark[3]) if mark[2] else (mark[4], mark[5], mark[6])
        if not tag or mark[0][-1] != ">":                       # a comment, a declaration, or cut off
            continue
        tag = tag.lower()
        if tag == "br":
            text.append(" ")
            continue
        if end:
            if tag not in _INLINE:
                flush()
            if opened[tag]:
                close(max(i for i in range(len(stack)) if stack[i][0] == tag) if stack[-1][0] != tag else len(stack) - 1)
            continue
        if tag in _RAW:
            if not attributes.endswith("/"):
                after = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, place)
                place = after.end() if after else size
            continue
        if tag not in _INLINE:
            flush()
        if tag in _VOID:
            continue
        if tag in _CLOSES_P and opened["p"]:
            close(next(i for i in range(len(stack)) if stack[i][0] == "p"))
        for i in range(len(stack) - 1, 0, -1) if tag in _SIBLING else ():
            if stack[i][0] in _SIBLING[tag]:
                close(i)
                break
            if stack[i][0] in _SCOPE:
                break
        parents.append(stack[-1][2])
        inside = tag == "header" and opened["article"] + opened["main"] > 0    # an article's own head
        weight, costs = (0.0, 0.0) if inside else _weight(tag, attributes)
        _, score, _, held = stack[-1]
        if held and (tag == "main" or tag == "article" and not costs):
            if tag == "main" or not content:
                layout.update(held)
            if layout.issuperset(held):
                score, held = score - sum(cost[i] for i in held), ()
        number = len(parents) - 1
        if costs:
            cost[number], held = costs, (*held, number)
        stack.append((tag, score + weight, number, held))
        opened[tag] += 1
    flush()
    return out, parents


def edges(page: list[Block], parents: list[int]) -> list[tuple[int, int, float]]:
    """Edges between blocks: neighbours, and the next block of the same or
    the enclosing element."""
    out, last = [], {}
    for i, (_, _, parent, _) in enumerate(page):
        if i:
            out.append((i - 1, i, NEXT_EDGE if page[i - 1][2] == parent or parents[page[i - 1][2]] == parents[parent] else NEXT_EDGE / 4))
        for key, strength in ((parent, TREE_EDGE), (-1 - parents[parent], TREE_EDGE / 2)):
            if key in last and last[key] != i:
                out.append((last[key], i, strength))
            last[key] = i
    return out


def min_cut(scores: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """For each node, whether it is on the source's side of a minimum cut.

    A node's positive score is its capacity from the source, a negative one
    its capacity to the sink; links have the same capacity both ways.  Dinic's
    method: shortest augmenting paths by levels.
    """
    n = len(scores)
    if all(s > 0 for s in scores) or all(s <= 0 for s in scores):
        return [s > 0 for s in scores]
    excess = list(scores)
    graph: list[list[int]] = [[] for _ in range(n)]
    head, room = [], []
    for a, b, w in links:
        graph[a].append(len(head))
        graph[b].append(len(head) + 1)
        head += [b, a]
        room += [w, w]
    tiny = 1e-9
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if excess[i] > tiny)
        for i in queue:
            level[i] = 0
        met = False
        while queue:
            a = queue.popleft()
            met = met or excess[a] < -tiny
            for e in graph[a]:
                if room[e] > tiny and level[head[e]] < 0:
                    level[head[e]] = level[a] + 1
                    queue.append(head[e])
        if not met:
            return [x >= 0 for x in level]
        turn = [0] * n
        for start in range(n):
            while level[start] == 0 and excess[start] > tiny:
                path, at = [], start                            # depth first along the levels
                while excess[at] >= -tiny or not path:
                    while turn[at] < len(graph[at]):
                        e = graph[at][turn[at]]
                        if room[e] > tiny and level[head[e]] == level[at] + 1:
                            break
                        turn[at] += 1
                    else:
                        if not path:
                            break
                        e = path.pop()
                        at = head[e ^ 1]
                        turn[at] += 1
                        continue
                    path.append(e)
                    at = head[e]
                if not path:
                    break
                flow = min(excess[start], -excess[at], min(room[e] for e in path))
                excess[start] -= flow
                excess[at] += flow
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow


def main_text(html: str | None) -> str:
    """The main text of a page; empty if it has none."""
    if not html:
        return ""
    page, parents = text_blocks(html)
    keep = min_cut([b[1] for b in page], edges(page, parents))
    return " ".join(b[0] for b, k in zip(page, keep, strict=True) if k)


def extract(pages: DataFrame, html: str = "html", key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, url, text, n_chars) per row of ``pages``.

    A null, empty or text-free page has an empty text; null keys and urls are
    carried along; repeated rows are read each; of equally cheap cuts the one
    with the fewest content blocks counts; an empty table gives no rows; other columns
    play no part.  No shuffle.
    """
    key_kind, url_kind = pages.schema[key].dataType.simpleString(), pages.schema[url].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "html"):
                texts = [main_text(x) for x in block.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([block.column("key"), block.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 [key, url, "text", "n_chars"])

    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html"))
    return rows.mapInArrow(run, f"`{key}` {key_kind}, `{url}` {url_kind}, text string, n_chars bigint")
