"""N-gram Jaccard join: near-copy groups by exact set similarity.

A document's set holds its distinct shingles of SIZE words.  Equal sets are
one node.  Two sets that link share a shingle among their first n - ceil(0.75
n) + 1 in any fixed order of all shingles.  The join runs in five parts:

1. All shingles of all sets are compared across the corpus.  In an order that
   has the shingles of one set only first, a set with n - ceil(0.75 n) + 1 or
   more of these can't link to another; the rest go on.
2. The shingles of those sets are counted in a table of hashed counters of
   fixed size; from here on their order is by that count, then hash.
3. Sets that share one of their first shingles are joined into candidate
   groups.  Within a task, the sets of a shingle send one posting on, so a
   very common shingle weighs no more than one posting a task.
4. Each candidate group goes, in chunks of bounded size, to tasks that join
   it exactly: index lists in blocks by position, whole blocks skipped where
   the positional filter fails, and a set's overlaps derived from those of a
   highly similar set by the few shingles in which the two differ.
5. In groups of several chunks, the sets outside the group's prevailing
   component are sent to those of its other chunks that have one of their
   first shingles.  The links' components are the result.

Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from ledgerlake.llm.components import connected, forest
from ledgerlake.llm.language_model import packed, unpacked
from ledgerlake.llm.store import land, partitions
from ledgerlake.llm.textarrays import Words, blocks, mix, ragged

SIZE = 5                    # words of a shingle
SHARE = 75                  # least 100 * intersection / union of linked sets
COUNTERS = 1 << 18          # hashed counters of the shingle order
SLOTS = 1 << 24             # hashed slots that tell which rows a join may need
CHUNK_SETS = 512
CHUNK_SHINGLES = 1 << 20
FLUSH = 1 << 21             # postings that a task sorts at once
BLOCK = 32                  # entries of a block of an index list
SIMILAR = 0.85              # similarity from which overlaps are derived
PIVOTS = 8                  # sets whose overlaps are kept for that
_STEP = np.uint64(0x9E6C63D0876A9A47)


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Size and 64-bit id of each text's set, and the sets (sorted hashes).
    A text without words has size 0."""
    words = Words(column)
    h, first, n = words.hash, words.first.tolist(), words.per_doc.tolist()
    rolled = np.zeros(len(h), np.uint64)
    count = max(0, len(h) - SIZE + 1)
    for i in range(SIZE):
        rolled[:count] = rolled[:count] * _STEP + h[i:i + count]
    rolled = mix(rolled)
    sets = []
    for a, k in zip(first[:-1], n, strict=True):
        if k >= SIZE:
            sets.append(np.unique(rolled[a:a + k - SIZE + 1]))
        elif k:
            whole = np.array([k], np.uint64)
            for i in range(a, a + k):
                whole = whole * _STEP + h[i]
            sets.append(mix(whole))
        else:
            sets.append(h[:0])
    size = np.array([len(s) for s in sets], np.int64)
    flat = mix(np.concatenate([np.empty(0, np.uint64), *sets]) + _STEP)
    total = np.concatenate([[np.uint64(0)], np.cumsum(flat, dtype=np.uint64)])
    ends = np.cumsum(size)
    ids = mix(total[ends] - total[ends - size] + size.astype(np.uint64)).view(np.int64)
    return size, ids, sets


def prefix_length(n):
    """Shingles of a set of n, of which two linked sets share at least one."""
    return (100 - SHARE) * n // 100 + 1


def _counter(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def _order(rows: DataFrame, counts: np.ndarray) -> Broadcast:
    """The counters, as the tasks that order shingles read them."""
    return rows.sparkSession.sparkContext.broadcast(np.minimum(counts, (1 << 24) - 1).astype(np.uint64))     # COUNTERS numbers


def _first(hashes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The first shingles of a set, of which two linked sets share one, as
    numbers that order them."""
    ranks, k = order[_counter(hashes)] << np.uint64(40) | mix(hashes) >> np.uint64(24), prefix_length(len(hashes))
    return np.partition(ranks, k - 1)[:k]


def _survey(rows: DataFrame, kind: str, parts: int) -> DataFrame:
    """(key, n, node, low, lows, fresh) per document: its set's size and id,
    the least number of places that one of its shingles has, how many of them
    have that number, and whether it is the first of its set in a block.

    A block holds the distinct sets of some of a task's documents; each set of
    each block is a place of its shingles.  A set has as many places as it has
    fresh documents, and a shingle with just as many is in no other set.

    Shingles go to the part of their hash with 32 more bits of it; sets that
    differ only there would seem to share a shingle, which does no harm.
    Documents and numbers travel as compressed differences and byte planes: in
    many parts, a document has few shingles in each.
    """
    key_type = to_arrow_type(DataType.fromDDL(kind))            # all of its fields may be null
    names = ["part", "task", "key", "n", "node", "row", "fresh", "hash", "doc", "size", "low"]
    schema = f"part int, task bigint, key {kind}, n bigint, node bigint, row int, fresh int, hash binary, doc binary, size binary, low binary"
    types = [pa.int32(), pa.int64(), key_type, pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]

    def batch_of(count: int, /, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[n] if n in columns else pa.nulls(count, t) for n, t in zip(names, types, strict=True)], names)

    def flush(task: int, sets: list[np.ndarray]) -> pa.RecordBatch:
        spread = mix(np.concatenate(sets))
        doc = np.repeat(np.arange(len(sets), dtype=np.int64), [len(s) for s in sets])
        place = ((spread >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64) * len(sets) + doc
        by = np.argsort(place, kind="stable")
        short, place = (spread[by] & np.uint64(0xFFFFFFFF)).astype(np.uint32), place[by]
        at = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        size = np.diff(np.append(at, len(place))).astype(np.uint32)
        part, doc = np.divmod(place[at], len(sets))
        found, first = np.unique(part, return_index=True)
        cut = np.append(at, len(place))
        pieces = list(zip(first.tolist(), np.append(first[1:], len(part)).tolist(), strict=True))
        return batch_of(len(found), part=pa.array(found, pa.int32()), task=pa.array(np.full(len(found), task)), size=pa.array([packed(size[i:j]) for i, j in pieces], pa.binary()),
                        doc=pa.array([packed(np.diff(doc[i:j], prepend=0).astype(np.uint32)) for i, j in pieces], pa.binary()),
                        hash=pa.array([short[cut[i]:cut[j]].tobytes() for i, j in pieces], pa.binary()))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, sets_, rows_of, held = TaskContext.get().partitionId() << 32, [], {}, 0
        for batch in batches:
            for block in blocks(batch, "text"):
                size, ids, sets = shingles(block.column("text"))
                row, fresh = [], []
                for n, node, members in zip(size.tolist(), ids.tolist(), sets, strict=True):
                    fresh.append(int(n > 0 and node not in rows_of))
                    if fresh[-1]:
                        rows_of[node] = len(sets_)
                        sets_.append(members)
                        held += n
                    row.append(rows_of[node] if n else -1)
                count = len(row)
                yield batch_of(count, part=pa.array((np.arange(count) % parts).astype(np.int32)), task=pa.array(np.full(count, task)), key=block.column("key").cast(key_type), n=pa.array(size), node=pa.array(ids),
                               row=pa.array(row, pa.int32()), fresh=pa.array(fresh, pa.int32()))
                if held >= FLUSH:
                    yield flush(task, sets_)
                    task, sets_, rows_of, held = task + 1, [], {}, 0
        if held:
            yield flush(task, sets_)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per part, block and set, the least number of places of a shingle,
        and how many have it."""
        held: dict[int, list] = {}
        for batch in batches:
            whole = batch.filter(batch.column("hash").is_null())
            if whole.num_rows:
                yield whole
            some = batch.filter(batch.column("hash").is_valid())
            for part, task, h, doc, size in zip(*(some.column(c).to_pylist() for c in ("part", "task")), some.column("hash"), *(some.column(c).to_pylist() for c in ("doc", "size")), strict=True):
                held.setdefault(part, []).append((task, np.frombuffer(h.as_buffer(), np.uint32), doc, unpacked(size, np.uint32).astype(np.int64)))
        for part, found in sorted(held.items()):
            code = np.concatenate([h for _, h, _, _ in found]).astype(np.uint64) << np.uint64(32)
            code |= np.arange(len(code), dtype=np.uint64)
            code.sort()
            start = np.flatnonzero(np.concatenate([[True], code[1:] >> np.uint64(32) != code[:-1] >> np.uint64(32)]))
            places = np.diff(np.append(start, len(code))).astype(np.uint32)
            seen = np.empty(len(code), np.uint32)
            seen[(code & np.uint64(0xFFFFFFFF)).astype(np.int64)] = np.repeat(places, places)
            first = 0
            for task, h, doc, size in found:
                mine, at = seen[first:first + len(h)], np.cumsum(size) - size
                low = np.minimum.reduceat(mine, at)
                lows = np.add.reduceat((mine == np.repeat(low, size)).astype(np.uint32), at, dtype=np.uint32)
                first += len(h)
                yield batch_of(1, part=pa.array([part], pa.int32()), task=pa.array([task]), doc=pa.array([doc], pa.binary()), size=pa.array([packed(lows)], pa.binary()), low=pa.array([packed(low)], pa.binary()))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[pa.RecordBatch]] = {}
        found: dict[int, list] = {}
        for batch in batches:
            task = batch.column("task").to_numpy()
            whole = batch.column("row").is_valid().to_numpy(zero_copy_only=False)
            for t in np.unique(task[whole]).tolist():
                kept.setdefault(t, []).append(batch.select(["key", "n", "node", "row", "fresh"]).filter(pa.array(whole & (task == t))))
            some = batch.filter(pa.array(~whole))
            for t, *raw in zip(*(some.column(c).to_pylist() for c in ("task", "doc", "low", "size")), strict=True):
                found.setdefault(t, []).append(raw)
        for t, pieces in kept.items():
            count = max(int(p.column("row").to_numpy().max(initial=0)) for p in pieces) + 1
            low, lows = np.full(count, np.iinfo(np.int64).max), np.zeros(count, np.int64)
            for raw in found.pop(t, []):
                doc, part_low, part_lows = (unpacked(r, np.uint32).astype(np.int64) for r in raw)
                doc = np.cumsum(doc)                                        # each once
                lows[doc] = np.where(part_low < low[doc], part_lows, lows[doc] + np.where(part_low == low[doc], part_lows, 0))
                low[doc] = np.minimum(low[doc], part_low)
            for piece in pieces:
                row = piece.column("row").to_numpy()
                yield pa.RecordBatch.from_arrays([piece.column("key").cast(key_type), piece.column("n"), piece.column("node"), *[pa.array(np.where(row >= 0, a[row], 0)) for a in (low, lows)], piece.column("fresh")],
                                                 ["key", "n", "node", "low", "lows", "fresh"])

    compared = rows.mapInArrow(send, schema).repartition(parts, "part").mapInArrow(compare, schema)
    return compared.repartition(parts, "task").mapInArrow(finish, f"key {kind}, n bigint, node bigint, low bigint, lows bigint, fresh int")


def _counters(rows: DataFrame) -> np.ndarray:
    """Counts of hashed shingles over all sets (COUNTERS numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for block in blocks(batch, "text"):
                counts += np.bincount(_counter(np.concatenate([np.empty(0, np.uint64), *shingles(block.column("text"))[2]])), minlength=COUNTERS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used])], ["counter", "seen"])

    out = np.zeros(COUNTERS, np.int64)
    seen = rows.select("text").mapInArrow(run, "counter int, seen bigint").groupBy("counter").agg(F.sum("seen").alias("seen")).toArrow()
    out[seen["counter"].to_numpy()] = seen["seen"].to_numpy()
    return out


def _candidates(rows: DataFrame, order: Broadcast, parts: int) -> DataFrame:
    """Edges (x, y) whose components hold together all sets that may link."""

    def flush(tokens: list[np.ndarray], nodes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        token, node = np.concatenate(tokens), np.concatenate(nodes)
        token, node, x, y = _first_of_each(token, node)
        part = ((mix(token) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
        by = np.argsort(part, kind="stable")
        token, node, part = token[by], node[by], part[by]
        found, at = np.unique(part, return_index=True)
        raw = [[a[i:j].tobytes() for i, j in zip(at.tolist(), [*at[1:].tolist(), len(part)], strict=True)] for a in (token, node)]
        x, y = forest(x, y)
        edge_part = ((mix(y.view(np.uint64)) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(found), *[pa.array(r, pa.binary()) for r in raw], pa.nulls(len(found), pa.int64()), pa.nulls(len(found), pa.int64())],
                                         ["part", "token", "node", "x", "y"])
        yield pa.RecordBatch.from_arrays([pa.array(edge_part), pa.nulls(len(x), pa.binary()), pa.nulls(len(x), pa.binary()), pa.array(x), pa.array(y)],
                                         ["part", "token", "node", "x", "y"])

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, nodes, held, seen = [], [], 0, set()
        for batch in batches:
            for block in blocks(batch, "text"):
                size, ids, sets = shingles(block.column("text"))
                for n, node, members in zip(size.tolist(), ids.tolist(), sets, strict=True):
                    if n and node not in seen:
                        seen.add(node)
                        tokens.append(_first(members, order.value))
                        nodes.append(np.full(len(tokens[-1]), node, np.int64))
                        held += len(tokens[-1])
                if held >= FLUSH:
                    yield from flush(tokens, nodes)
                    tokens, nodes, held, seen = [], [], 0, set()
        if held:
            yield from flush(tokens, nodes)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, node, x, y = [], [], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for batch in batches:
            has = np.flatnonzero(batch.column("token").is_valid().to_numpy(zero_copy_only=False))
            token += [np.frombuffer(batch.column("token")[i].as_buffer(), np.uint64) for i in has.tolist()]
            node += [np.frombuffer(batch.column("node")[i].as_buffer(), np.int64) for i in has.tolist()]
            x.append(batch.column("x").drop_null().to_numpy())
            y.append(batch.column("y").drop_null().to_numpy())
        if token:
            _, _, more_x, more_y = _first_of_each(np.concatenate(token), np.concatenate(node))
            x.append(more_x)
            y.append(more_y)
        x, y = forest(np.concatenate(x), np.concatenate(y))
        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])

    posted = rows.mapInArrow(post, "part int, token binary, node binary, x bigint, y bigint")
    return posted.repartition(parts, "part").mapInArrow(gather, "x bigint, y bigint")


def _first_of_each(token: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One posting for each token (its least node), and edges from the
    token's other nodes to that one."""
    by = np.lexsort((node, token))
    token, node = token[by], node[by]
    first = np.ones(len(token), bool)
    first[1:] = token[1:] != token[:-1]
    least = node[first][np.cumsum(first) - 1]
    other = node != least
    pairs = np.unique(np.stack([node[other], least[other]], 1), axis=0) if other.any() else np.empty((0, 2), np.int64)
    return token[first], node[first], np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])


class Chunk:
    """Some sets, indexed for exact similarity search."""

    def __init__(self, ids: list[int], sets: list[np.ndarray]):
        self.ids, self.n = ids, np.array([len(s) for s in sets], np.int64)
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.n)
        self.tokens, token, often = np.unique(flat, return_inverse=True, return_counts=True)
        by = np.argsort(token, kind="stable")
        self.owner, self.often = owner[by], often               # full index lists, by token
        self.at = np.cumsum(often) - often
        self.rank = np.empty(len(often), np.int64)              # rare first
        self.rank[np.lexsort((self.tokens, often))] = np.arange(len(often))
        self.members = [np.sort(t) for t in np.split(token, np.cumsum(self.n)[:-1])]
        # prefix lists: entries by (token, position), in blocks
        heads = [self._head(m, len(m)) for m in self.members]
        token = np.concatenate([h for h, _ in heads])
        place = np.concatenate([p for _, p in heads])
        owner = np.repeat(np.arange(len(heads)), [len(h) for h, _ in heads])
        by = np.lexsort((place, token))
        self.list_owner, self.list_place, token = owner[by], place[by], token[by]
        start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        length = np.diff(np.append(start, len(token)))
        per_list = -(-length // BLOCK)
        self.block_at = np.repeat(start, per_list) + (ragged(np.zeros(len(start), np.int64), per_list)) * BLOCK
        self.block_end = np.minimum(self.block_at + BLOCK, np.repeat(start + length, per_list))
        rest = self.n[self.list_owner] - self.list_place - 1
        self.block_rest = np.maximum.reduceat(rest, self.block_at)
        self.block_least = np.minimum.reduceat(self.n[self.list_owner], self.block_at)
        self.first_block = np.full(len(often), 0)
        self.blocks_of = np.zeros(len(often), np.int64)
        self.first_block[token[start]] = np.cumsum(per_list) - per_list
        self.blocks_of[token[start]] = per_list
        self.kept: list[tuple[np.ndarray, int, np.ndarray]] = []        # members, size, overlaps with every set

    def _head(self, members: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The prefix of a set: tokens of this chunk and their positions.
        Tokens that the chunk doesn't have are the rarest and come first."""
        strange = n - len(members)
        known = members[np.argsort(self.rank[members])][:max(0, prefix_length(n) - strange)]
        return known, np.arange(len(known)) + strange

    def local(self, members: np.ndarray) -> np.ndarray:
        """The chunk's numbers of the shingles that it has."""
        at = np.searchsorted(self.tokens, members)
        at[at == len(self.tokens)] = 0
        return at[self.tokens[at] == members]

    def _any(self, members: np.ndarray, n: int, own: int) -> bool:
        """Whether the prefix lists leave a set that may link to this one
        (but for the chunk's set ``own``)."""
        token, place = self._head(members, n)
        entry = ragged(self.first_block[token], self.blocks_of[token])
        mine = np.repeat(n - place - 1, self.blocks_of[token])
        need = -(-SHARE * (n + self.block_least[entry]) // (100 + SHARE))
        good = 1 + np.minimum(mine, self.block_rest[entry]) >= need             # else the block is skipped
        entry, mine = entry[good], mine[good]
        length = self.block_end[entry] - self.block_at[entry]
        at, mine = ragged(self.block_at[entry], length), np.repeat(mine, length)
        size = self.n[self.list_owner[at]]
        need = -(-SHARE * (n + size) // (100 + SHARE))
        good = (1 + np.minimum(mine, size - self.list_place[at] - 1) >= need) & (100 * np.minimum(n, size) >= SHARE * np.maximum(n, size))
        return bool((good & (self.list_owner[at] != own)).any())

    def _count(self, members: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner[ragged(self.at[members], self.often[members])], minlength=len(self.n))

    def linked(self, members: np.ndarray, n: int, own: int = -1) -> np.ndarray:
        """Numbers of the sets that link to a set of n shingles, of which the
        chunk has ``members``; the set may be the chunk's own."""
        overlap = None
        for other, size, known in self.kept:
            common = len(np.intersect1d(members, other, assume_unique=True))
            if common >= SIMILAR * (n + size - common):
                new, gone = np.setdiff1d(members, other, True), np.setdiff1d(other, members, True)
                overlap = known + self._count(new) - self._count(gone)
                break
        if overlap is None:
            if not self._any(members, n, own):
                return np.empty(0, np.int64)
            overlap = self._count(members)
            self.kept = [(members, n, overlap), *self.kept[:PIVOTS - 1]]
        return np.flatnonzero(100 * overlap >= SHARE * (n + self.n - overlap))


def _by_chunk(batches: Iterator[pa.RecordBatch], inner: bool) -> Iterator[tuple[Chunk, list[tuple[int, int, np.ndarray]]]]:
    """Per chunk its index, with the sets to look up (id, size, shingles) in
    pieces; rows come by chunk, the chunk's own sets first.  With ``inner``
    there are no others, and the chunk's own are meant."""
    name, own, chunk, asked = None, {}, None, []

    def piece() -> Iterator[tuple[Chunk, list]]:
        nonlocal chunk, asked
        if own and (asked or inner):
            chunk = chunk or Chunk(list(own), list(own.values()))
            yield chunk, asked
            asked = []

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("cand", "bucket", "salt", "asked", "node")), batch.column("members"), strict=True)
        for cand, bucket, salt, guest, node, members in rows:
            if name != (cand, bucket, salt):
                yield from piece()
                name, own, chunk, asked = (cand, bucket, salt), {}, None, []
            values = np.frombuffer(members.as_buffer(), np.uint64).copy()
            if not guest:
                own[node] = values
            else:
                asked.append((node, len(values), values))
                if len(asked) >= CHUNK_SETS:
                    yield from piece()
    yield from piece()


def _links(inner: bool):
    """Edges that join the linked sets of each chunk, or its guests to them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, asked in _by_chunk(batches, inner):
            x, y = [], []
            for node, n, values in asked:
                found = chunk.linked(chunk.local(values), n)
                x += [node] * len(found)
                y += [chunk.ids[i] for i in found.tolist()]
            label = np.arange(len(chunk.ids) if inner else 0)
            for i in range(len(label)):
                if (label == label[0]).all():
                    break                                       # nothing left to join
                found = chunk.linked(chunk.members[i], len(chunk.members[i]), i)
                joined = np.unique(label[found])
                if len(joined) > 1:
                    label[np.isin(label, joined)] = joined[0]
                    x += [chunk.ids[i]] * len(found)
                    y += [chunk.ids[j] for j in found.tolist()]
            a, b = forest(np.array(x, np.int64), np.array(y, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["x", "y"])

    return run


def _joined(rows: DataFrame, parts: int, inner: bool) -> DataFrame:
    laid = rows.select("cand", "bucket", "salt", "asked", "node", "members").repartition(parts, "cand", "bucket", "salt")
    return laid.sortWithinPartitions("cand", "bucket", "salt", "asked").mapInArrow(_links(inner), "x bigint, y bigint")


def groups(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, component_id) per row of ``docs``: the size of its
    set, and the least key reachable by links (its own included).

    Words are lower-cased (A-Z) and separated by ASCII white space; a text of
    fewer than SIZE words is one shingle; a text without words, or a null
    text, has an empty set and links with nothing.  Repeated rows and equal
    texts link; rows with a null key link by their text, but give no
    component its id (null if all are so); an empty table gives no rows;
    other columns play no part.
    """
    named = _classes(docs, text, key)
    least = named.where("class IS NOT NULL").groupBy("class").agg(F.min("key.id").alias("least"))
    return named.join(least, "class", "left").select(F.col("key.id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("key.id")).alias("component_id"))


def _row_key(key: str, text: str) -> Column:
    """What tells rows apart: whether the key is null, the key, and a hash of
    the text (rows may share a key).  The least is a class's first row."""
    return F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("text"))


def _classes(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(key, n, node, class) per row of ``docs``: its row key, its set's size
    and id, and the class of linked sets (null for an empty set)."""
    rows = docs.select(_row_key(key, text).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    parts = partitions(rows)
    each = land(_survey(rows, kind, parts), "jaccard-survey")
    nodes = each.where("n > 0").groupBy("node").agg(F.min("key").alias("of"), *[F.first(c).alias(c) for c in ("n", "low", "lows")], F.sum("fresh").alias("places"))
    nodes = nodes.where(f"low > places OR lows < {100 - SHARE} * n div 100 + 1")      # the others have too many shingles alone
    nodes = land(nodes.select("node", F.col("of.id").alias("__id"), F.col("of.text").alias("__text"), "n"), "jaccard-chosen")
    some = land(_confirmed(_rows_of(_needed(rows, nodes), nodes)), "jaccard-texts")
    order = _order(some, _counters(some))
    group = connected(_candidates(some, order, parts), "jaccard-candidates")

    # chunks of the candidate groups; a group that fits is one chunk
    nodes = some.select("node", "n").distinct().join(group.select("node", F.col("root").alias("cand")), "node")
    fits = (F.col("sets") <= CHUNK_SETS) & (F.col("shingles") <= CHUNK_SHINGLES)
    totals = nodes.groupBy("cand").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles")).select("cand", fits.alias("fits"))
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / SHARE))).cast("int")
    # written, so that the join's skewed partitions can be split
    nodes = land(nodes.join(totals, "cand").withColumn("bucket", F.when(F.col("fits"), -1).otherwise(step)), "jaccard-nodes", ids=True)
    salts = F.ceil(F.greatest(F.count("*") / CHUNK_SETS, F.sum("n") / CHUNK_SHINGLES)).cast("int")
    salted = nodes.groupBy("cand", "bucket").agg(salts.alias("salts"))
    salt = F.when(F.col("fits"), 0).otherwise(F.pmod(F.xxhash64("node"), F.col("salts"))).cast("int")
    nodes = nodes.join(salted, ["cand", "bucket"]).select("cand", "bucket", salt.alias("salt"), "node")

    sets = land(_with_sets(some.join(nodes, "node")), "jaccard-sets")
    edges = land(_joined(sets.withColumn("asked", F.lit(False)), parts, True), "jaccard-links")
    large = sets.where("bucket >= 0")
    if large.limit(1).count():
        routes = land(_routes(large, order), "jaccard-routes", ids=True)
        first = land(_sent(large, routes, edges, True), "jaccard-sent", ids=True)
        edges = edges.unionByName(land(_across(large, routes, first, parts), "jaccard-links"))
        rest = land(_sent(large, routes, edges, False).join(first, first.columns, "left_anti"), "jaccard-sent", ids=True)
        if rest.limit(1).count():
            edges = edges.unionByName(land(_across(large, routes, rest, parts), "jaccard-links"))
    roots = connected(edges, "jaccard-components")

    return each.select("key", "n", "node").join(roots, "node", "left").withColumn("class", F.when(F.col("n") > 0, F.coalesce("root", "node")))


def _rows_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows with a ``key`` of ``wanted`` (its columns __id and __text)."""
    return rows.join(wanted, (F.col("key.text") == F.col("__text")) & F.col("key.id").eqNullSafe(F.col("__id")))


def _needed(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows with a ``key`` of ``wanted``, and some more: hashes of keys are
    cut to SLOTS slots, bits of a table that is broadcast, so that the join
    need not shuffle the texts of rows that it drops."""
    word, bit = (lambda h: F.floor(F.pmod(h, F.lit(SLOTS)) / 64)), (lambda h: F.pmod(h, F.lit(64)).cast("int"))
    mine, theirs = F.xxhash64("key.id", "key.text"), F.xxhash64("__id", "__text")
    table = wanted.groupBy(word(theirs).alias("__word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit(theirs))).alias("__bits"))
    return rows.join(F.broadcast(table), (word(mine) == F.col("__word")) & (F.getbit("__bits", bit(mine)) == 1), "left_semi")


def _confirmed(rows: DataFrame) -> DataFrame:
    """(node, n, text) where the text's set is the node's; another row with
    the same key may have another.  Of equal rows, each task keeps one (one
    of several tasks' is as good as the other, and they do no harm)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for block in blocks(batch, "text"):
                nodes = block.column("node").to_pylist()
                kept = [a == b and not (b in seen or seen.add(b)) for a, b in zip(shingles(block.column("text"))[1].tolist(), nodes, strict=True)]
                yield block.filter(pa.array(kept, pa.bool_()))

    return rows.select("node", "n", "text").mapInArrow(run, "node bigint, n bigint, text string")


def _with_sets(rows: DataFrame) -> DataFrame:
    """The shingles of each candidate set (cand, bucket, salt, node)."""
    kept = ["cand", "bucket", "salt", "node"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                members = pa.array([s.tobytes() for s in shingles(block.column("text"))[2]], pa.binary())
                yield pa.RecordBatch.from_arrays([*[block.column(c) for c in kept], members], [*kept, "members"])

    return rows.select(*kept, "text").mapInArrow(run, "cand bigint, bucket int, salt int, node bigint, members binary")


def _routes(sets: DataFrame, order: Broadcast) -> DataFrame:
    """(cand, token, bucket, salt, node): first shingles of the sets, but those
    that a candidate group has in one chunk only."""
    place = ["cand", "bucket", "salt", "node"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, CHUNK_SETS):
                some = batch.slice(i, CHUNK_SETS)
                tokens = [_first(np.frombuffer(m.as_buffer(), np.uint64), order.value).view(np.int64) for m in some.column("members")]
                at = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
                yield pa.RecordBatch.from_arrays([*[some.column(c).take(pa.array(at)) for c in place], pa.array(np.concatenate(tokens))], [*place, "token"])

    heads = sets.select(*place, "members").mapInArrow(run, "cand bigint, bucket int, salt int, node bigint, token bigint")
    same = Window.partitionBy("cand", "token")
    chunk = F.struct("bucket", "salt")
    return heads.select("*", F.min(chunk).over(same).alias("least"), F.max(chunk).over(same).alias("most")).where("least != most").drop("least", "most")


def _sent(sets: DataFrame, routes: DataFrame, edges: DataFrame, representatives: bool) -> DataFrame:
    """(cand, bucket, salt, node): chunks of a set's candidate group, of like
    sizes, to which it is sent.

    A set is sent to the other chunks that have one of its first shingles,
    unless its component is the one that prevails in the group: of two sets in
    different components, one at least is sent to the other's chunk.  With
    ``representatives``, only one set of each chunk and component is sent.
    """
    roots = connected(edges, "jaccard-across")
    place = ["cand", "bucket", "salt"]
    named = sets.select(*place, "node").join(roots, "node", "left").select(*place, "node", F.coalesce("root", "node").alias("class"))
    shares = named.groupBy(*place, "class").agg(F.count("*").alias("n"), F.min("node").alias("first"))
    prevails = shares.groupBy("cand", "class").agg(F.sum("n").alias("n")).groupBy("cand").agg(F.max_by("class", F.struct("n", "class")).alias("prevails"))
    if representatives:
        named = shares.select(*place, F.col("first").alias("node"), "class")
    senders = named.join(prevails, "cand").where(F.col("class") != F.col("prevails")).select("node")
    to = routes.select("cand", "token", F.col("bucket").alias("to_bucket"), F.col("salt").alias("to_salt")).distinct()
    other = (F.col("bucket") != F.col("to_bucket")) | (F.col("salt") != F.col("to_salt"))
    sent = routes.join(senders, "node", "left_semi").join(to, ["cand", "token"]).where((F.abs(F.col("bucket") - F.col("to_bucket")) <= 1) & other)
    return sent.select("cand", F.col("to_bucket").alias("bucket"), F.col("to_salt").alias("salt"), "node").distinct()


def _across(sets: DataFrame, routes: DataFrame, sent: DataFrame, parts: int) -> DataFrame:
    """Links of the sets that are sent with those of the chunks that they are
    sent to.  Of a chunk, only sets that have a first shingle of one sent go."""
    place = ["cand", "bucket", "salt"]
    tokens = routes.join(sent.select("node").distinct(), "node", "left_semi").select("cand", "token").distinct()
    hosts = routes.join(tokens, ["cand", "token"], "left_semi").join(sent.select(*place).distinct(), place, "left_semi").select(*place, "node").distinct()
    asked = hosts.withColumn("asked", F.lit(False)).unionByName(sent.withColumn("asked", F.lit(True)))
    asked = land(asked, "jaccard-asked", ids=True)
    return _joined(asked.join(sets.select("node", "members"), "node"), parts, False)


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group of linked rows, all columns as they
    are: the one of the least key, null keys last; of rows that share that
    key, one text's.  Rows are decided each for itself, so a key may lose one
    row and keep another; of rows equal in key and text one stays.  Rows
    without words all stay; an empty table gives no rows.
    """
    rows = _classes(docs, text, key)
    first = rows.where("n > 0").groupBy("class", "key").agg(F.count("*").alias("copies")).groupBy("class").agg(F.min(F.struct("key", "copies")).alias("f"))
    first = land(first.select(F.col("f.key.id").alias("__id"), F.col("f.key.text").alias("__text"), F.col("f.copies").alias("copies")), "jaccard-first")
    names = docs.columns
    marked = docs.select(F.struct(*names).alias("__row"), _row_key(key, text).alias("key"))
    single, several = first.where("copies = 1"), first.where("copies > 1")
    single, several = _rows_of(marked, single), _rows_of(_needed(marked, several), several).dropDuplicates(["key"])
    wordless = marked.where(~F.coalesce(F.col(f"__row.`{text}`"), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    return single.unionByName(several).select("__row.*").unionByName(wordless.select("__row.*")).select(*names)
