"""Byte-level BPE encoding and decoding on padded numpy matrices.

Texts are split by the tokenizer's pattern.  The distinct pieces of a block
that aren't tokens themselves go, by length, into matrices of token ids, one
piece a row.  In each round every row merges its leftmost pair of least rank;
pairs are looked up in a hash table of numpy arrays, rows are compacted, and
rows without a mergeable pair leave the matrix.  Decoding gathers the bytes
of each id from the vocabulary.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ledgerlake.llm.textarrays import blocks, ragged

NONE = np.int32(2**31 - 1)
LONG_PIECE = 512                # bytes; longer pieces are merged one by one
CACHE_PIECES = 200_000          # pieces that a task remembers between blocks
_CODECS: dict[tuple[str, str], Codec] = {}


class Codec:
    """Encodes and decodes by the ranks of a tiktoken file.

    Ranks are the ids.  Any two neighbours whose joined bytes are a token can
    merge; the least rank goes first, the leftmost among equals.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.known: dict[str, int] = {}
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self._hash(pairs)
        self._reset()

    def _hash(self, pairs: dict[int, int]) -> None:
        """Open addressing with linear probing, at most a quarter full."""
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slot_key = np.full(1 << bits, np.uint64(2**64 - 1))
        self.slot_rank = np.full(1 << bits, NONE, np.int32)
        keys = np.fromiter(pairs.keys(), np.uint64, len(pairs))
        ranks = np.fromiter(pairs.values(), np.int32, len(pairs))
        slot, self.probes = self._slot(keys), 0
        while len(keys):
            self.probes += 1
            free = self.slot_key[slot] == np.uint64(2**64 - 1)
            taken, first = np.unique(slot[free], return_index=True)
            chosen = np.flatnonzero(free)[first]
            self.slot_key[taken], self.slot_rank[taken] = keys[chosen], ranks[chosen]
            rest = np.ones(len(keys), bool)
            rest[chosen] = False
            keys, ranks, slot = keys[rest], ranks[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each joined pair; NONE where it is no token, or an id is -1."""
        keys = (left.astype(np.uint64) << np.uint64(32) | (right.astype(np.uint64) & np.uint64(0xFFFFFFFF))).ravel()
        slot = self._slot(keys)
        out = np.where(self.slot_key[slot] == keys, self.slot_rank[slot], NONE)
        open_ = np.flatnonzero((out == NONE) & (self.slot_key[slot] != np.uint64(2**64 - 1)))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & self.mask
            at = self.slot_key[slot[open_]]
            hit = at == keys[open_]
            out[open_[hit]] = self.slot_rank[slot[open_[hit]]]
            open_ = open_[~hit & (at != np.uint64(2**64 - 1))]
        return out.reshape(left.shape)

    def merge(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge every row of a padded (-1) id matrix to its end; also lengths."""
        done, length = np.full_like(rows, -1), (rows >= 0).sum(1)
        ids, live = rows.copy(), np.arange(len(rows))
        rank = self.pair_rank(ids[:, :-1], ids[:, 1:])
        rank[ids[:, 1:] < 0] = NONE
        while len(live):
            at = rank.argmin(1)                     # the first of equals
            row = np.arange(len(live))
            best = rank[row, at]
            over = best == NONE
            if over.any():
                done[live[over], :ids.shape[1]] = ids[over]
                keep = ~over
                width = max(2, int(length[live[keep]].max(initial=2)))
                ids, rank, live, at, best = ids[keep][:, :width], rank[keep][:, :width - 1], live[keep], at[keep], best[keep]
                row = np.arange(len(live))
                if not len(live):
                    break
            ids[row, at] = best
            column = np.arange(ids.shape[1])
            source = column + (column > at[:, None])        # drop the pair's right half
            ids = np.take_along_axis(np.pad(ids, ((0, 0), (0, 1)), constant_values=-1), source, 1)
            column = column[:-1]
            source = column + (column > at[:, None])
            rank = np.take_along_axis(np.pad(rank, ((0, 0), (0, 1)), constant_values=NONE), source, 1)
            length[live] -= 1
            for shift in (-1, 0):                            # the two pairs that changed
                j = at + shift
                some = (j >= 0) & (j < rank.shape[1])
                r, j = row[some], j[some]
                new = self.pair_rank(ids[r, j], ids[r, j + 1])
                rank[r, j] = np.where(ids[r, j + 1] < 0, NONE, new)
        return done, length

    def merge_long(self, piece: bytes) -> list[int]:
        """The same merges for one long piece, from a heap of its pairs."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        pieces = [bytes([b]) for b in piece]
        heap = [(r, i) for i in range(len(ids) - 1) if (r := self.ranks.get(pieces[i] + pieces[i + 1])) is not None]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if pieces[i] is None or j >= len(ids) or self.ranks.get(pieces[i] + pieces[j]) != rank:
                continue
            pieces[i], pieces[j], ids[i] = pieces[i] + pieces[j], None, rank
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else len(ids)
                if b < len(ids) and (r := self.ranks.get(pieces[a] + pieces[b])) is not None:
                    heappush(heap, (r, a))
        return [x for x, p in zip(ids, pieces, strict=True) if p is not None]

    def _reset(self) -> None:
        self.known, self.ids, self.first, self.count = {}, [], [], []
        self.total = 0

    def _add(self, pieces: list[str], ids: np.ndarray, count: np.ndarray) -> None:
        """Remember pieces whose ids lie in a row."""
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces)), strict=True))
        self.first.append(self.total + np.cumsum(count) - count)
        self.count.append(count)
        self.ids.append(ids.astype(np.uint32))
        self.total += len(ids)

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces that aren't known yet."""
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        whole, whole_id, ranks = [], [], self.ranks
        for piece in pieces:
            raw = piece.encode()
            rank = ranks.get(raw)
            if rank is not None:
                whole.append(piece)
                whole_id.append(rank)
            elif len(raw) > LONG_PIECE:
                ids = self.merge_long(raw)
                self._add([piece], np.array(ids), np.array([len(ids)]))
            else:
                buckets.setdefault(len(raw) + 3 >> 2, []).append((piece, raw))
        self._add(whole, np.array(whole_id, np.uint32), np.ones(len(whole), np.int64))
        for width, members in buckets.items():
            width *= 4
            step = max(1, (1 << 18) // width)
            for at in range(0, len(members), step):
                part, raw = zip(*members[at:at + step], strict=True)
                size = np.fromiter(map(len, raw), np.int64, len(raw))
                rows = np.full((len(part), width), -1, np.int32)
                rows[np.arange(width) < size[:, None]] = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
                merged, length = self.merge(rows)
                self._add(part, merged[merged >= 0], length)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (uint32), and the number of each text's."""
        split = [self.pattern.findall(t) for t in texts]
        if len(self.known) > CACHE_PIECES:
            self._reset()
        self.learn(set().union(*split) - self.known.keys())
        place = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64, sum(map(len, split)))
        for name in ("ids", "first", "count"):
            setattr(self, name, [np.concatenate(getattr(self, name))])
        table, first, count = self.ids[0], self.first[0], self.count[0]
        ids = table[ragged(first[place], count[place])]
        ends = np.concatenate([[0], np.cumsum(count[place])])
        cut = ends[np.cumsum([0] + [len(s) for s in split])]
        return ids, np.diff(cut)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids stand for."""
        return self.bytes[ragged(self.start[ids], self.size[ids])].tobytes()


def load(path: str, pattern: str) -> Codec:
    """The codec of a rank file; a Python worker keeps it between tasks."""
    if (path, pattern) not in _CODECS:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        _CODECS[path, pattern] = Codec(ranks, pattern)
    return _CODECS[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) per row of ``docs``.

    The first digest is of the ids as little-endian 32-bit integers, the
    second of the bytes that decoding gives back; ``with_ids`` adds the ids
    as a binary column.  ``path`` is the rank file, installed on every node.
    A null text counts as empty (no ids); repeated rows are encoded each; an
    empty table gives no rows; other columns play no part.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(path, pattern)
        for batch in batches:
            for block in blocks(batch, "text"):
                texts = block.column("text").fill_null("").to_pylist()
                ids, count = codec.encode(texts)
                ends = np.cumsum(count)
                rows = [ids[e - c:e] for c, e in zip(count.tolist(), ends.tolist(), strict=True)]
                raw = [r.astype("<u4").tobytes() for r in rows]
                columns = [block.column("key"), pa.array(count, pa.int64()),
                           pa.array([hashlib.sha256(r).hexdigest() for r in raw]),
                           pa.array([hashlib.sha256(codec.decode(r)).hexdigest() for r in rows])]
                names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(raw, pa.binary())] * with_ids, names + ["ids"] * with_ids)

    schema = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    return docs.selectExpr(f"`{key}` AS key", f"`{text}` AS text").mapInArrow(run, schema)
