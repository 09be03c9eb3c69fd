"""Phrase collocations: multikey three-way quicksort of suffix pointers.

A suffix starts at each word of a piece of text; two or three of its words
count.  Suffixes of a stretch of text are counted where they stand, so a very
common phrase leaves a task once, and travel as arrays to the part that a
hash of their leading words names.  There, pointers to all suffixes are
partitioned by word after word: into less, equal and greater than a pivot,
the equal ones going on to the next word until the last.  A partition that
holds fewer occurrences than asked for is abandoned at once; the size of an
equal partition at the last word is a phrase's count.

Words are told apart by 64-bit hashes that also take in the language.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.store import land, partitions
from ledgerlake.llm.textarrays import Words, blocks, mix, ragged

LEAST = 10                  # occurrences of a candidate
LENGTHS = (2, 3)            # words of a candidate
HELD = 50                   # percent of its occurrences inside a longer one that drop a candidate
TOP = 2000
FLUSH = 1 << 20             # suffixes counted before they are sent
PART_BYTES = 32 << 20       # text whose suffixes one part takes

_BREAK = b".,;:!?\n\x0b\x0c\r"
BREAKS = np.array([b in _BREAK for b in range(256)])
WORD_BYTES = np.array([b not in _BREAK + b" \t" for b in range(256)])
FOLD = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def three_way(keys: np.ndarray, weight: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows of ``keys`` (a row per suffix, a column per word) that weigh
    ``least`` at least together: a pointer to one of them, and the weight.

    All partitions of one turn are split at once: segments of the pointer
    array, each with a pivot of its own and the word that it is compared by.
    """
    flat, depth = np.ascontiguousarray(keys.T).ravel(), keys.shape[1]
    dice = np.random.default_rng(1)
    pointer, size, level = np.arange(len(keys)), np.array([len(keys)] if len(keys) else [], np.int64), np.zeros(min(1, len(keys)), np.int64)
    found, total = [], []
    while len(size):
        begin = np.cumsum(size) - size
        own = np.repeat(np.arange(len(size)), size)
        key = flat[np.repeat(level * len(keys), size) + pointer]
        pivot = key[begin + (dice.random(len(size)) * size).astype(np.int64)][own]
        side = (key >= pivot).astype(np.int8) + (key > pivot)
        heavy = np.bincount(own * 3 + side, weight[pointer], 3 * len(size)).reshape(-1, 3)
        keep = heavy >= least
        done = keep[:, 1] & (level == depth - 1)
        equal = side == 1
        first = np.full(len(size), -1)
        first[own[equal]] = pointer[equal]
        found.append(first[done])
        total.append(heavy[done, 1])
        keep[done, 1] = False
        parts = [(side == s) & keep[own, s] for s in range(3)]
        size = np.concatenate([np.bincount(own[p], minlength=len(level))[keep[:, s]] for s, p in enumerate(parts)])
        level = np.concatenate([level[keep[:, s]] + (s == 1) for s in range(3)])
        pointer = np.concatenate([pointer[p] for p in parts])
    return (np.concatenate(found), np.concatenate(total).astype(np.int64)) if found else (np.empty(0, np.int64), np.empty(0, np.int64))


def _keyed(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, Words, np.ndarray]]:
    """(rows, words, hash of each word in its language) for bounded blocks."""
    for block in blocks(batch, "text"):
        words = Words(block.column("text"), WORD_BYTES)
        tongue = [int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "big") for s in block.column("lang").to_pylist()]
        yield block, words, mix(words.hash ^ np.repeat(mix(np.array(tongue, np.uint64)), words.per_doc))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, lang, text, n) for the distinct words of each block."""
    for batch in batches:
        for block, words, key in _keyed(batch):
            key, at, n = np.unique(key, return_index=True, return_counts=True)
            length = words.end[at] - words.start[at]
            offsets = np.concatenate([[0], np.cumsum(length)])
            letters = FOLD[words.data[ragged(words.start[at], length)]]
            text = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(letters)).cast(pa.string())
            lang = block.column("lang").take(pa.array(words.doc_of_word()[at]))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), lang.cast(pa.string()), text, pa.array(n)], ["word", "lang", "text", "n"])


def _send(parts: int):
    """Per task: suffixes counted over FLUSH words, as arrays per part."""

    def chunk(rows: np.ndarray, n: np.ndarray) -> bytes:
        return pa.compress(rows.T.tobytes() + n.astype(np.uint32).tobytes(), codec="zstd", asbytes=True)

    def flush(words: np.ndarray, goes_on: np.ndarray) -> Iterator[pa.RecordBatch]:
        for first in range(0, len(words), FLUSH):                   # one turn, but for a very long text
            last = first + FLUSH + max(LENGTHS) - 1
            yield from count(words[first:last], goes_on[first:last])

    def count(words: np.ndarray, goes_on: np.ndarray) -> Iterator[pa.RecordBatch]:
        names, number = np.unique(words, return_inverse=True)       # fewer than 2^21 numbers
        whole, lead = np.arange(len(words)) < FLUSH, number.astype(np.int64)
        for length in range(2, max(LENGTHS) + 1):
            whole = whole[:-1] & goes_on[length - 2:len(goes_on) - 1]
            lead = lead[:-1] << 21 | number[length - 1:]
            if length not in LENGTHS:
                continue
            code, n = np.unique(lead[whole], return_counts=True)
            rows = names[np.stack([code >> (21 * (length - 1 - k)) & (1 << 21) - 1 for k in range(length)], 1)]
            route = np.zeros(len(rows), np.uint64)
            for k in range(length):
                route = mix(route + rows[:, k])
            part = ((route >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))]).tolist()
            full = [p for p in range(parts) if ends[p] < ends[p + 1]]
            data = [chunk(rows[order[ends[p]:ends[p + 1]]], n[order[ends[p]:ends[p + 1]]]) for p in full]
            held = [ends[p + 1] - ends[p] for p in full]
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([length] * len(full), pa.int32()), pa.array(held, pa.int64()), pa.array(data, pa.binary())],
                                             ["part", "length", "n", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for _, words, key in _keyed(batch):
                breaks = np.concatenate([[0], np.cumsum(BREAKS[words.data], dtype=np.int32)])[words.start]
                doc = words.doc_of_word()
                goes_on = np.zeros(len(key), bool)
                goes_on[:-1] = (breaks[1:] == breaks[:-1]) & (doc[1:] == doc[:-1])
                held.append((key, goes_on))
                if sum(len(x) for x, _ in held) >= FLUSH:
                    yield from flush(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    held = []
        if any(len(x) for x, _ in held):
            yield from flush(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def _frequent(least: int):
    """Per part and length: the phrases that occur ``least`` times at least."""

    def sort(length: int, chunks: list[tuple[int, bytes]]) -> pa.RecordBatch:
        rows, weight = [], []
        for n, data in chunks:
            raw = pa.decompress(data, decompressed_size=n * (8 * length + 4), codec="zstd", asbytes=True)
            rows.append(np.frombuffer(raw, np.uint64, n * length).reshape(length, n).T)
            weight.append(np.frombuffer(raw, np.uint32, n, 8 * n * length))
        keys = np.concatenate(rows)
        first, total = three_way(keys, np.concatenate(weight), least)
        words = [pa.array(keys[first, k].view(np.int64)) if k < length else pa.nulls(len(first), pa.int64()) for k in range(max(LENGTHS))]
        return pa.RecordBatch.from_arrays([*words, pa.array(total)], [*(f"w{k + 1}" for k in range(max(LENGTHS))), "a"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, chunks = (-1, -1), []
        for batch in batches:
            for part, length, n, data in zip(*(batch.column(c).to_pylist() for c in ("part", "length", "n", "data")), strict=True):
                if (part, length) != now and chunks:
                    yield sort(now[1], chunks)
                    chunks = []
                now = (part, length)
                chunks.append((n, data))
        if chunks:
            yield sort(now[1], chunks)

    return run


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1,000,000 a^2 / (left right)), exact up to 38 digits."""
    wide = lambda c: c.cast("decimal(19,0)")        # noqa: E731
    over = (wide(a) * wide(a)).cast("decimal(31,0)") * F.lit(1000000).cast("decimal(7,0)")
    return F.call_function("div", over.cast("decimal(38,0)"), (wide(left) * wide(right)).cast("decimal(38,0)"))


def _top(rows: DataFrame, keys: list[str], order: list[Column], spread: Column, top: int) -> DataFrame:
    """The first ``top`` rows of each key, with ``rank``: first of many small
    groups, then of fewer, so that a key with very many rows isn't one group."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for groups in (n, isqrt(n), 1):
        part = Window.partitionBy(*keys, F.pmod(F.xxhash64(spread), F.lit(groups))).orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(part).cast("long")).where(F.col("rank") <= top)
    return rows


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All candidates of two words, all of three, and (lang, n): the words of
    each language.

    Two words: w1, w2 (hashes), lang, text1, text2, a, l, r.  Three words: w1,
    w2, w3, lang, phrase, a, and l1, r1, l2, r2 of the cuts after the first and
    the second word, and the counts front and back of its two inner phrases.
    """
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    counted = rows.mapInArrow(_count_words, "word bigint, lang string, text string, n bigint").groupBy("word", "lang", "text").agg(F.sum("n").alias("n"))
    counted = land(counted, "phrase-words")
    words = counted.where(F.col("n") >= least)
    parts = partitions(rows, part_bytes=PART_BYTES)
    sent = rows.mapInArrow(_send(parts), "part int, length int, n bigint, data binary")
    laid = sent.repartitionById(parts, "part").sortWithinPartitions("part", "length")
    found = land(laid.mapInArrow(_frequent(least), "w1 bigint, w2 bigint, w3 bigint, a bigint"), "phrases")
    first = words.select(F.col("word").alias("w1"), "lang", F.col("text").alias("text1"), F.col("n").alias("l"))
    second = words.select(F.col("word").alias("w2"), F.col("text").alias("text2"), F.col("n").alias("r"))
    pairs = land(found.where(F.col("w3").isNull()).select("w1", "w2", "a").join(first, "w1").join(second, "w2"), "phrase-pairs")
    front = pairs.select("w1", "w2", "lang", "text1", "text2", F.col("a").alias("l2"), F.col("l").alias("l1"))
    back = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("text2").alias("text3"), F.col("a").alias("r1"), F.col("r").alias("r2"))
    triples = found.where(F.col("w3").isNotNull()).join(front, ["w1", "w2"]).join(back, ["w2", "w3"])
    triples = triples.select("w1", "w2", "w3", "lang", F.concat_ws(" ", "text1", "text2", "text3").alias("phrase"), "a", "l1", "r1", "l2", "r2")
    return pairs, land(triples, "phrase-triples"), counted.groupBy("lang").agg(F.sum("n").alias("n"))


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, held: int = HELD, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of
    each language by score, then occurrences, then the phrase.

    A null text is empty, a null language is ``und``; rows are counted as
    often as they are repeated; equal scores and counts go by the phrase's
    bytes.  A language without phrases, and an empty table, give no rows.  No
    text is too long, and other columns play no part.
    """
    pairs, triples, totals = phrases(docs, text, lang, least)
    inside = triples.select(F.explode(F.array(F.struct("w1", "w2", "a", F.col("l2").alias("own")),
                                              F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a", F.col("r1").alias("own")))).alias("s")).select("s.*")
    dropped = inside.where(100 * F.col("a") >= held * F.col("own")).select("w1", "w2").distinct()
    two = pairs.join(dropped, ["w1", "w2"], "left_anti").select("lang", F.concat_ws(" ", "text1", "text2").alias("phrase"), "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r")).alias("score"))
    cuts = triples.withColumn("s1", _score(F.col("a"), F.col("l1"), F.col("r1"))).withColumn("s2", _score(F.col("a"), F.col("l2"), F.col("r2")))
    later = F.col("s2") < F.col("s1")
    three = cuts.select("lang", "phrase", "a", F.when(later, F.col("l2")).otherwise(F.col("l1")).alias("l"), F.when(later, F.col("r2")).otherwise(F.col("r1")).alias("r"), F.least("s1", "s2").alias("score"))
    ranked = _top(two.unionByName(three), ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], F.col("phrase"), top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
