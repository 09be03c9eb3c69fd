"""Arrow text columns as flat numpy arrays: words, word hashes, bounded blocks.

The text operators run inside ``mapInArrow``.  A batch's text column is one
UTF-8 buffer plus offsets; words are found and hashed for all of its
documents at once.  ``blocks`` cuts a batch so that the working arrays stay
bounded (a single text longer than the bound forms a block of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 21           # text bytes handled at once
_SPACE = bytes([0x20, 9, 10, 11, 12, 13])

_rng = np.random.default_rng(20240607)      # fixed: hashes agree on all tasks
_ROOT = np.uint64(int(_rng.integers(1 << 60, 1 << 62)) * 8 + 5)
_INVERSE = np.uint64(pow(int(_ROOT), -1, 1 << 64))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]      # A-Z folded
_POWERS = {"n": 0, "up": np.empty(0, np.uint64), "down": np.empty(0, np.uint64)}

#: bytes of a word: anything but ASCII white space
SPACED = np.array([b not in _SPACE for b in range(256)])
#: bytes of a word: ASCII letters and digits, and every non-ASCII byte
ALNUM = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (bijective)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POWERS["n"] < n:
        size = max(n, BLOCK_BYTES + 1)
        for key, root in (("up", _ROOT), ("down", _INVERSE)):
            steps = np.full(size, root, np.uint64)
            steps[0] = 1
            _POWERS[key] = np.multiply.accumulate(steps)
        _POWERS["n"] = size
    return _POWERS["up"], _POWERS["down"]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets (nulls are empty)."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first, last = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    return data[first:last], offsets - first


def blocks(batch: pa.RecordBatch, text: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most ``limit`` text bytes, or one row."""
    _, offsets = utf8(batch.column(text))
    row = 0
    while row < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), batch.num_rows)
        yield batch.slice(row, end - row)
        row = end


class Words:
    """The words of a block of texts, in order.

    start, end: byte positions; hash: 64 bits over the word with A-Z
    lower-cased; per_doc: number of words of each text; first: index of each
    text's first word (n + 1 entries).
    """

    def __init__(self, column: pa.Array, word_byte: np.ndarray = SPACED):
        self.data, self.offsets = utf8(column)
        inside = word_byte[self.data]
        n = len(inside)
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = self.offsets[:-1]
        before[edges[edges < n]] = False            # no word spans two texts
        edges = self.offsets[1:]
        after[edges[edges > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.per_doc = np.diff(self.first)
        up, down = _powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * up[:n], out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.per_doc)), self.per_doc)


def word_hash(word: str) -> int:
    """The hash that ``Words`` gives a single word."""
    return int(Words(pa.array([word]), np.ones(256, bool)).hash[0])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[0], .. , starts[0] + lengths[0] - 1, starts[1], .."""
    lengths = np.asarray(lengths, np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(np.asarray(starts, np.int64) - (ends - lengths), lengths)
