"""Benchmark decontamination by q-gram counting in diagonal bands.

A document holds a benchmark item if some passage of it is within the item's
edit budget (a share of the item's length).  If it is, passage and item share
at least m - q + 1 - q * budget q-grams (m: the item's length), and these lie
on diagonals (place in the document less place in the item) that differ by
twice the budget at most.  So shared q-grams are counted in overlapping bands
of diagonals, bands that reach the bound are kept, and each is verified by an
alignment limited to the band.

Lengths and edits are in bytes of the UTF-8 text, after A-Z become lower case
and ASCII white space becomes the space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerlake.llm.textarrays import blocks, ragged, utf8

Q = 8                       # a q-gram is one 64-bit number
EDIT_SHARE = 0.08           # edit budget as a share of the item's length
INDEX_BYTES = 8 << 20       # benchmark text in one index, on average; more goes into further indexes
_TABLE_BITS = 20
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_PLAIN[[9, 10, 11, 12, 13]] = 0x20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _grams(data: np.ndarray) -> np.ndarray:
    """The q-gram that begins at each byte (len(data) - Q + 1 numbers)."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.empty(n, np.uint64)
    for shift in range(min(Q, n)):
        part = data[shift:shift + (len(data) - shift) // Q * Q]
        out[shift::Q] = np.ascontiguousarray(part).view("<u8")
    return out


class Index:
    """The q-grams of some benchmark items."""

    def __init__(self, ids: list, texts: list[str | None], share: float = EDIT_SHARE):
        rows = [(i, _PLAIN[np.frombuffer(t.encode(), np.uint8)]) for i, t in zip(ids, texts, strict=True) if t]
        self.ids, self.items = [i for i, _ in rows], [t for _, t in rows]
        self.length = np.array([len(t) for t in self.items], np.int64)
        # a budget for which the bound stays positive; without q-grams, none
        self.budget = np.minimum((share * self.length).astype(np.int64), np.maximum(0, (self.length - Q) // Q))
        self.bound = self.length - Q + 1 - Q * self.budget
        self.width = np.maximum(2 * self.budget, 8)
        grams = [_grams(t) for t in self.items]
        key = np.concatenate([np.empty(0, np.uint64), *grams])
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.empty(0, np.int64), *[np.arange(len(g)) for g in grams]])
        order = np.argsort(key, kind="stable")
        self.item, self.place = item[order], place[order]
        self.key, self.first, self.count = np.unique(key[order], return_index=True, return_counts=True)
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[(self.key * _SPREAD) >> np.uint64(64 - _TABLE_BITS)] = True
        self.short = [k for k, n in enumerate(self.length) if n < Q]

    def candidates(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, item, first diagonal of a band) that reach the bound."""
        grams = _grams(data)
        at = np.flatnonzero(self.table[(grams * _SPREAD) >> np.uint64(64 - _TABLE_BITS)]) if len(self.key) else np.empty(0, np.int64)
        found = np.searchsorted(self.key, grams[at])
        found[found == len(self.key)] = 0
        hit = self.key[found] == grams[at] if len(at) else np.empty(0, bool)
        at, found = at[hit], found[hit]
        doc = np.searchsorted(offsets, at, "right") - 1
        inside = at + Q <= offsets[doc + 1]                  # not across two texts
        at, found, doc = at[inside], found[inside], doc[inside]
        times = self.count[found]
        posting = ragged(self.first[found], times)
        item, doc = self.item[posting], np.repeat(doc, times)
        slack = int(self.length.max(initial=0))
        diagonal = np.repeat(at, times) - self.place[posting] + slack
        band = diagonal // self.width[item]
        bands = (len(data) + 2 * slack) // 8 + 2
        code = (doc * len(self.items) + item) * bands + band
        order = np.argsort(code, kind="stable")
        code, place = code[order], self.place[posting][order]
        code, first, seen = np.unique(code, return_index=True, return_counts=True)
        # a band of double width is two neighbours: [b, b + 2) widths
        both = seen.copy()
        if len(code) > 1:
            next_ = code[1:] == code[:-1] + 1
            both[:-1][next_] += seen[1:][next_]
        pair, band = np.divmod(code, bands)
        doc, item = np.divmod(pair, max(1, len(self.items)))
        keep = np.flatnonzero(both >= self.bound[item])
        # text that repeats itself hits one q-gram of the item many times
        distinct = [len(np.unique(place[first[k]:first[k] + both[k]])) for k in keep.tolist()]
        keep = keep[np.array(distinct, np.int64) >= self.bound[item[keep]]]
        return doc[keep], item[keep], band[keep] * self.width[item[keep]] - slack

    def search(self, data: np.ndarray, offsets: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int]]:
        """(document, item) -> (edits, start, end in its text) of the best passage."""
        data, best = _PLAIN[data], {}
        raw = None
        for doc, item, low in zip(*(x.tolist() for x in self.candidates(data, offsets)), strict=True):
            if best.get((doc, item), (1,))[0] == 0:
                continue
            begin, end = int(offsets[doc]), int(offsets[doc + 1])
            budget, width, m = int(self.budget[item]), int(self.width[item]), int(self.length[item])
            first, last = max(begin, low - budget), min(end, low + 2 * width + m + budget)
            window, pattern = data[first:last], self.items[item]
            place = window.tobytes().find(pattern.tobytes())
            if place >= 0:
                got = (0, first - begin + place, first - begin + place + m)
            else:
                got = align(pattern, window, budget, low - first - budget, low - first + 2 * width + budget)
                got = got and (got[0], first - begin + got[1], first - begin + got[2])
            if got and got < best.get((doc, item), (m + 1,)):
                best[doc, item] = got
        for item in self.short:
            raw = data.tobytes() if raw is None else raw
            pattern = self.items[item].tobytes()
            for doc in range(len(offsets) - 1):
                place = raw.find(pattern, offsets[doc], offsets[doc + 1])
                if place >= 0:
                    best[doc, item] = (0, place - int(offsets[doc]), place - int(offsets[doc]) + len(pattern))
        return best


def _distance(pattern: np.ndarray, text: np.ndarray, low: int, high: int) -> np.ndarray:
    """Edits that turn the pattern into some passage that ends at each place
    of the text, along diagonals low to high (elsewhere large)."""
    n, m, far = len(text), len(pattern), len(pattern) + len(text) + 1
    span = np.arange(low, high + 1)
    row = np.where((span >= 0) & (span <= n), 0, far)        # row 0: free start
    step = np.arange(len(span))
    for i in range(1, m + 1):
        at = span + i                                        # place in the text after this row
        inside = (at >= 0) & (at <= n)
        differs = np.ones(len(span), np.int64)
        some = (at >= 1) & (at <= n)
        differs[some] = text[at[some] - 1] != pattern[i - 1]
        new = np.minimum(np.where(at >= 1, row + differs, far), np.append(row[1:], far) + 1)
        new = np.where(inside, new, far)
        row = np.where(inside, np.minimum.accumulate(new - step) + step, far)
    out = np.full(n + 1, far)
    at = span + m
    inside = (at >= 0) & (at <= n)
    out[at[inside]] = row[inside]
    return out


def align(pattern: np.ndarray, text: np.ndarray, budget: int, low: int, high: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the passage nearest to the pattern, if within
    the budget; the first end, then the shortest passage among equals."""
    ends = _distance(pattern, text, low, high)
    end = int(ends.argmin())
    if ends[end] > budget:
        return None
    # the same, read backwards from that end: places where it can begin
    back, m, edits = text[:end][::-1], len(pattern), int(ends[end])
    far = len(pattern) + end + 1
    row = np.arange(end + 1)                                 # anchored at the end
    for i in range(1, m + 1):
        new = np.full(end + 1, far)
        new[1:] = row[:-1] + (back != pattern[m - i])
        new = np.minimum(new, row + 1)
        row = np.minimum.accumulate(new - np.arange(end + 1)) + np.arange(end + 1)
    return edits, end - int(np.flatnonzero(row <= edits)[0]), end


def _indexes(benchmark: DataFrame, text: str, key: str, share: float) -> Iterator[Broadcast]:
    """Broadcast indexes of about INDEX_BYTES of benchmark text each."""
    items = benchmark.select(F.col(key).alias("i"), F.col(text).alias("t")).where(F.length("t") > 0)
    total = items.select(F.sum(F.octet_length("t"))).head()[0] or 0
    parts = max(1, -(-int(total) // INDEX_BYTES))
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == part).collect()
        yield benchmark.sparkSession.sparkContext.broadcast(Index([r.i for r in rows], [r.t for r in rows], share))


def find_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id", share: float = EDIT_SHARE) -> DataFrame:
    """(key, item key, start, end, edits): the items that each document holds,
    with the best passage of each (fewest edits, then the first), places in
    code points of the document's text, end exclusive.

    An item's budget is ``share`` of its length, less where the q-gram bound
    would not be positive; items shorter than a q-gram must occur as they
    are.  Null and empty texts hold nothing and null or empty items occur
    nowhere; repeated rows are searched each, repeated items give a row each;
    an empty table on either side gives no rows; other columns play no part.
    The benchmark goes to the tasks in indexes of bounded size, each a pass
    of its own over the documents.  No shuffle.
    """
    key_kind, item_kind = docs.schema[key].dataType.simpleString(), benchmark.schema[item_key].dataType.simpleString()
    schema = f"`{key}` {key_kind}, `{item_key}` {item_kind}, start bigint, end bigint, edits bigint"
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    item_type = to_arrow_type(benchmark.schema[item_key].dataType)
    out = None
    for shared in _indexes(benchmark, item_text, item_key, share):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for block in blocks(batch, "text"):
                    data, offsets = utf8(block.column("text"))
                    got = sorted(index.search(data, offsets).items())
                    if not got:
                        continue
                    docs_, items_ = [d for (d, _), _ in got], [index.ids[i] for (_, i), _ in got]
                    edits = [v[0] for _, v in got]
                    start, end = (np.array([int(offsets[d]) + v[k] for (d, _), v in got]) for k in (1, 2))
                    # bytes to code points
                    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                    base = chars[offsets[docs_]]
                    yield pa.RecordBatch.from_arrays([
                        block.column("key").take(pa.array(docs_)), pa.array(items_, item_type), pa.array(chars[start] - base, pa.int64()),
                        pa.array(chars[end] - base, pa.int64()), pa.array(edits, pa.int64())], [key, item_key, "start", "end", "edits"])

        found = source.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_key: str = "item_id", share: float = EDIT_SHARE) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item, with all
    their columns.  Each row is judged by its own text; a null text holds
    none.  No shuffle."""
    for shared in _indexes(benchmark, item_text, item_key, share):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in blocks(batch, text):
                    keep = np.ones(block.num_rows, bool)
                    keep[[doc for doc, _ in shared.value.search(*utf8(block.column(text)))]] = False
                    yield block.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
