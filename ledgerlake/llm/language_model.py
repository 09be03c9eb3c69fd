"""Language-model scoring by a weighted backoff automaton.

Words and n-grams of up to ORDER words are counted over all training
documents.  All words count; an n-gram of two words or more is kept if it
occurs ``least`` times.  A kept n-gram is an arc from the state of its first
words, at a discounted probability, and a state itself if it is shorter than
ORDER words.  Each state has a failure arc to the state of one word less,
weighted so that probabilities sum to 1; the root reads any word, unknown ones
share what the discounts leave.

The automaton grows with the corpus and is never in one place.  Texts are cut
into blocks of bounded size, written once as word numbers.  A block sends its
distinct words to the parts of the key space with its own counts, and gets
their counts over all blocks; then the n-grams of one word more, as far as
their first and last words are kept; at last its states, with its share of
the probability that their arcs leave and of these arcs' lower probability, for
the weights of failure arcs.  So it ends up with exactly the states and arcs that its own
texts can reach, and reads its texts on them from left to right, carrying the
state from token to token.

What goes to a part is one binary row per block and part; a word that is in
every text is one entry per block.  Words and n-grams are told apart by 64-bit
hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerlake.llm.store import land, partitions
from ledgerlake.llm.textarrays import Words, blocks, mix

ORDER = 3
LEAST = 2                   # occurrences of a kept n-gram of two words or more
DISCOUNT = 0.5              # of the counts of n-grams of two words or more
FOLDS, HELD_OUT = 7, 2
BLOCK_TOKENS = 1 << 20      # tokens of a block, or one text
PART_BYTES = 32 << 20       # text bytes for each part of the key space
SEGMENT = 256               # tokens of a text that are read one after the other
END = np.uint64(0x656E64206F662074)         # the end token's hash


def tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and end token of each text in a row, and the n + 1
    places where texts begin."""
    n = len(words.per_doc)
    first = words.first + np.arange(n + 1)
    out = np.full(int(first[-1]), END)
    inner = np.ones(len(out), bool)
    inner[first[1:] - 1] = False
    out[inner] = words.hash
    return out, first


def joined(prefix: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Keys of n-grams by the keys of their first and of their last words."""
    return mix(mix(prefix) * np.uint64(0xD1342543DE82EF95) + suffix)


def packed(numbers: np.ndarray) -> bytes:
    """Values compressed byte by byte: all first bytes, all second ones, ..;
    high bytes are mostly zero."""
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T)
    return planes.nbytes.to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpacked(raw: bytes, kind=np.uint64) -> np.ndarray:
    planes = pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), "zstd", asbytes=True)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, -1).T).view(kind).ravel()


def steps(keys: np.ndarray) -> np.ndarray:
    """Ascending keys as differences."""
    return np.diff(keys, prepend=np.uint64(0))


@dataclass
class Level:
    """A block's n-grams of one length: its distinct keys in order, the number
    of each token's n-gram among them (-1: none ends here), occurrences in the
    block's training texts and, once known, in all of them (0: not kept)."""

    keys: np.ndarray
    at: np.ndarray
    local: np.ndarray
    count: np.ndarray | None = None
    log: np.ndarray | None = None       # log10 probability of the arc
    back: np.ndarray | None = None      # log10 weight of the failure arc

    def kept(self) -> np.ndarray:
        """Whether a kept n-gram ends at each token."""
        return (self.at >= 0) & (np.append(self.count, 0)[self.at] > 0)

    def of(self, values: np.ndarray, places=slice(None)) -> np.ndarray:
        """Values of the n-grams that end at these places."""
        return values[self.at[places]]


def level(keys: np.ndarray, where: np.ndarray, train: np.ndarray) -> Level:
    """The n-grams that end at these places."""
    distinct, number = np.unique(keys, return_inverse=True)
    at = np.full(len(train), -1, np.int64)
    at[where] = number
    return Level(distinct, at, np.bincount(number[train[where]], minlength=len(distinct)))


@dataclass(frozen=True)
class Corpus:
    """Figures of all training tokens."""

    total: int = 0              # N
    kinds: int = 0              # V
    discount: float = 0.5       # of unigram counts

    def unigram(self, count: np.ndarray) -> np.ndarray:
        """Probability of words with these counts (0: unknown)."""
        if not self.total:
            return np.ones(len(count))
        return np.where(count > 0, (count - self.discount) / self.total, self.discount * self.kinds / self.total)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.total + self.kinds + 1))


class Block:
    """A block's texts, and the part of the automaton that they reach, as far
    as it is known."""

    def __init__(self, row: dict, corpus: Corpus):
        self.corpus = corpus
        words = np.cumsum(unpacked(row["word"]), dtype=np.uint64)
        frequent = unpacked(row["rank"], np.uint32)             # words, the most frequent first
        number = frequent[unpacked(row["token"], np.uint32)]
        size = np.frombuffer(row["size"], np.int64)
        self.first = np.append(0, np.cumsum(size))
        self.train = np.repeat(~np.frombuffer(row["held"], bool), size)
        self.since = np.arange(len(number)) - np.repeat(self.first[:-1], size)
        self.levels = [Level(words, number.astype(np.int64), np.bincount(number[self.train], minlength=len(words)))]

    def learn(self, count: np.ndarray) -> None:
        """Take the last level's counts; its arcs' probabilities follow."""
        last = self.levels[-1]
        last.count = count
        if len(self.levels) == 1:
            chance = self.corpus.unigram(count)
        else:
            lower = self.levels[-2]
            ends = np.flatnonzero(last.at >= 0)
            before = np.ones(len(count))
            before[last.at[ends]] = lower.count[lower.at[ends - 1]]
            chance = np.where(count > 0, (count - DISCOUNT) / before, 1.0)
        last.log = np.log10(chance)

    def extend(self, least: int) -> None:
        """One word more, where the first and the last words are kept and
        occur ``least`` times."""
        last = self.levels[-1]
        kept = (last.at >= 0) & (np.append(last.count, 0)[last.at] >= least)
        where = np.flatnonzero(kept[1:] & kept[:-1] & (self.since[1:] >= len(self.levels))) + 1
        self.levels.append(level(joined(last.of(last.keys, where - 1), last.of(last.keys, where)), where, self.train))

    def states(self, n: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The n-grams of n words that occur ``least`` times: their numbers,
        and this block's shares of the probability that their arcs leave, and
        of what these arcs' last words have by the state of one word less.

        Both are sums of positive numbers, sent in 32 bits."""
        state, arc = self.levels[n - 1], self.levels[n]
        share = np.zeros(len(arc.keys))
        np.divide(arc.local, arc.count, out=share, where=arc.count > 0)
        ends = np.flatnonzero(arc.at >= 0)
        of, less = np.zeros(len(arc.keys), np.int64), np.zeros(len(arc.keys))
        of[arc.at[ends]] = state.at[ends - 1]
        less[arc.at[ends]] = state.of(state.log, ends)
        inner = np.flatnonzero((state.at >= 0) & self.train & np.append(self.since[1:] > 0, False))     # another token follows
        left = np.bincount(state.at[inner], minlength=len(state.keys)) - np.bincount(of, np.where(arc.count > 0, arc.local, 0), len(state.keys))
        left = left + DISCOUNT * np.bincount(of, share, len(state.keys))
        known = np.bincount(of, share * np.power(10.0, less), len(state.keys))
        some = np.flatnonzero(state.count >= least)
        return some, (left[some] / state.count[some]).astype(np.float32), known[some].astype(np.float32)

    def read(self) -> np.ndarray:
        """log10 probability of each token, read from left to right.

        Segments of the texts advance together, a token each a step.  A
        segment starts ORDER - 1 tokens early at the root, which brings it to
        the state that the text before it leads to.
        """
        order, total = len(self.levels), len(self.since)
        size = np.diff(self.first)
        count = -(-size // SEGMENT)
        within = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        begin = np.repeat(self.first[:-1], count) + within * SEGMENT
        end = np.minimum(begin + SEGMENT, np.repeat(self.first[1:], count))
        place = np.maximum(begin - (order - 1), np.repeat(self.first[:-1], count))
        by = np.argsort(place - end, kind="stable")             # longest first
        begin, end, place = begin[by], end[by], place[by]
        kept = [one.kept() for one in self.levels]
        out = np.zeros(total)
        depth = np.zeros(len(place), np.int64)                  # of each segment's state: the words that it stands for
        longest = int((end - place).max()) if len(place) else 0
        for _ in range(longest):
            going = int(np.searchsorted(place - end, 0)) if len(place) else 0
            place, end, begin, depth = place[:going], end[:going], begin[:going], depth[:going]
            gained, now = np.zeros(going), np.zeros(going, np.int64)
            left = np.arange(going)
            for d in range(order - 1, -1, -1):
                here = left[depth[left] == d]
                arc = kept[d][place[here]] | (d == 0)
                took, failed = here[arc], here[~arc]
                gained[took] += self.levels[d].of(self.levels[d].log, place[took])
                now[took] = np.where(kept[d][place[took]], min(d + 1, order - 1), 0)
                if d:
                    gained[failed] += self.levels[d - 1].of(self.levels[d - 1].back, place[failed] - 1)
                    depth[failed] -= 1
                    left = left[depth[left] < d]
            counted = place >= begin
            out[place[counted]] = gained[counted]
            depth, place = now, place + 1
        return out


def cut(rows: DataFrame) -> DataFrame:
    """(block, keys, held, size, word, rank, token): the texts of ``rows`` (key,
    text, held) in blocks of BLOCK_TOKENS tokens, or of one text."""
    kind, key_type = rows.schema["key"].dataType.simpleString(), to_arrow_type(rows.schema["key"].dataType)
    most = BLOCK_TOKENS

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held, has = TaskContext.get().partitionId() << 32, [], 0

        def send() -> pa.RecordBatch:
            keys = pa.concat_arrays([x[0].cast(key_type) for x in held])
            words, number, times = np.unique(np.concatenate([x[3] for x in held]), return_inverse=True, return_counts=True)
            frequent = np.argsort(-times, kind="stable").astype(np.uint32)
            rank = np.empty(len(words), np.uint32)
            rank[frequent] = np.arange(len(words))
            raw = [np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held]).astype(np.int64)]
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys), *[pa.array([x.tobytes()], pa.binary()) for x in raw],
                 *[pa.array([packed(x)], pa.binary()) for x in (steps(words), frequent, rank[number])]],
                ["block", "keys", "held", "size", "word", "rank", "token"])

        for batch in batches:
            for one in blocks(batch, "text"):
                h, first = tokens(Words(one.column("text")))
                if held and has + len(h) > most:
                    yield send()
                    name, held, has = name + 1, [], 0
                held.append((one.column("key"), one.column("held").to_numpy(zero_copy_only=False).astype(bool), np.diff(first), h))
                has += len(h)
        if held:
            yield send()

    return rows.mapInArrow(make, f"block bigint, keys array<{kind}>, held binary, size binary, word binary, rank binary, token binary")


def _gathered(texts: DataFrame, answers: list[DataFrame], homes: int, work: Callable, schema: str) -> DataFrame:
    """``work(row, answers by round)`` for each block, where its answers of all
    rounds meet its texts."""
    columns = [f.name for f in texts.schema if f.name != "block"]
    names = ["block", "round", "part", "answer", *columns]
    laid = texts.select("block", F.lit(-1).alias("round"), F.lit(-1).alias("part"), F.lit(None).cast("binary").alias("answer"), *columns)
    for k, one in enumerate(answers):
        laid = laid.unionByName(one.where("block >= 0").select("block", F.lit(k).alias("round"), "part", "answer"), allowMissingColumns=True)
    laid = laid.select(names).repartitionById(homes, F.pmod(F.xxhash64("block"), F.lit(homes)).cast("int")).sortWithinPartitions("block", "round", "part")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((b, i) for b in batches for i in range(b.num_rows))
        for _, group in groupby(rows, key=lambda x: x[0].column("block")[x[1]].as_py()):
            row, found = None, {}
            for b, i in group:
                turn = b.column("round")[i].as_py()
                if turn < 0:
                    row = {c: b.column(c)[i] for c in columns}
                    row = {c: v if c == "keys" else v.as_py() for c, v in row.items()} | {"block": b.column("block")[i].as_py()}
                else:
                    found.setdefault(turn, []).append(b.column("answer")[i].as_py())
            yield from work(row, found)

    return laid.mapInArrow(each, schema)


def _sent(block: int, keys: np.ndarray, columns: list[np.ndarray], parts: int, piece: int = 0, pieces: int = 1) -> Iterator[pa.RecordBatch]:
    """Ascending keys and what belongs to them, one row for each part of this
    piece (every ``pieces``-th part)."""
    part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
    if pieces > 1:
        some = part % pieces == piece
        part, keys, columns = part[some], keys[some], [c[some] for c in columns]
    found, at = np.unique(part, return_index=True)
    ends = [*at[1:].tolist(), len(keys)]
    raw = [[packed(c[i:j]) for i, j in zip(at.tolist(), ends, strict=False)] for c in columns]
    coded = [packed(steps(keys[i:j])) for i, j in zip(at.tolist(), ends, strict=False)]
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(np.full(len(found), block, np.int64)), pa.array(coded, pa.binary()), *[pa.array(x, pa.binary()) for x in raw]],
                                     ["part", "block", "keys", *[f"sum{k}" for k in range(len(columns))]])


def _summed(sent: DataFrame, parts: int, kind, answer: Callable, figures: bool = False, pieces: int = 1) -> DataFrame:
    """(block, part, answer, ..): for each row sent, what ``answer`` makes of
    the sums of its keys over all blocks."""
    sums = [c for c in sent.columns if c.startswith("sum")]
    names = ["block", "part", "answer", "total", "kinds", "ones", "twos"]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            held += zip(*[batch.column(c).to_pylist() for c in ("block", "part", "keys", *sums)], strict=True)
        if not held:
            return
        held.sort(key=lambda x: x[:2])              # sums don't depend on the order of arrival
        keys = [np.cumsum(unpacked(x[2]), dtype=np.uint64) for x in held]
        ends = np.cumsum([len(k) for k in keys]).tolist()
        distinct, number = np.unique(np.concatenate(keys), return_inverse=True)
        del keys
        total = [np.bincount(number, np.concatenate([unpacked(x[3 + k], kind) for x in held]), len(distinct)) for k in range(len(sums))]
        result = answer(*total)
        for (block, part, *_), i, j in zip(held, [0, *ends], ends, strict=False):
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([part], pa.int32()), pa.array([packed(result[number[i:j]])], pa.binary()), *[pa.nulls(1, pa.int64())] * 4], names)
        if figures:
            count = total[0]
            of_all = [int(count.sum()), int((count > 0).sum()), int((count == 1).sum()), int((count == 2).sum())]
            yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([held[0][1]], pa.int32()), pa.nulls(1, pa.binary()), *[pa.array([x]) for x in of_all]], names)

    return sent.repartitionById(-(-parts // pieces), F.floor(F.col("part") / pieces).cast("int")).mapInArrow(whole, "block bigint, part int, answer binary, total bigint, kinds bigint, ones bigint, twos bigint")


def _joined(found: list[bytes], kind) -> np.ndarray:
    """A block's answers of a round, in the order of its keys."""
    return np.concatenate([np.empty(0, kind), *[unpacked(x, kind) for x in found]])


def _rebuilt(row: dict, found: dict[int, list[bytes]], corpus: Corpus, order: int, least: int) -> Block:
    """A block with all that earlier rounds have answered."""
    block = Block(row, corpus)
    for n in range(1, order + 1):
        if n > 1:
            block.extend(least)
        if n - 1 in found or not len(block.levels[-1].keys):
            block.learn(_joined(found.get(n - 1, []), np.int64))
        else:
            break
    for n in range(1, order):
        one = block.levels[n - 1] if n <= len(block.levels) else None
        if one is not None and one.count is not None:
            one.back = np.zeros(len(one.keys))
            if order + n - 1 in found:
                one.back[np.flatnonzero(one.count >= least)] = _joined(found[order + n - 1], np.float32)
    return block


def _weight(left: np.ndarray, known: np.ndarray) -> np.ndarray:
    """log10 weights of failure arcs; 1 for states without arcs."""
    return np.where(known > 0, np.log10(np.maximum(left, 1e-12) / np.maximum(1 - known, 1e-12)), 0.0).astype(np.float32)


def fit(texts: DataFrame, parts: int, order: int = ORDER, least: int = LEAST) -> tuple[Corpus, list[DataFrame]]:
    """The corpus' figures, and the answers of all rounds to the blocks of
    ``texts``: counts of words and n-grams by length, then weights of the
    failure arcs of states by length."""
    corpus, answers = Corpus(), []
    kinds = "part int, block bigint, keys binary, sum0 binary"

    for n in range(1, order + 1):
        def ask(row: dict, found: dict, n=n, corpus=corpus) -> Iterator[pa.RecordBatch]:
            last = _rebuilt(row, found, corpus, n, least).levels[-1] if n > 1 else Block(row, corpus).levels[0]
            yield from _sent(row["block"], last.keys, [last.local.astype(np.int64)], parts)

        fewest = 1 if n == 1 else least

        def total(count: np.ndarray, fewest=fewest) -> np.ndarray:
            return np.where(count >= fewest, count, 0).astype(np.int64)

        answers.append(land(_summed(_gathered(texts, answers, parts, ask, kinds), parts, np.int64, total, n == 1), f"lm-counts{n}"))
        if n == 1:
            sums = answers[0].where("block < 0").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "kinds", "ones", "twos")]).head()
            discount = sums.ones / (sums.ones + 2 * sums.twos) if sums.ones and sums.twos else 0.5
            corpus = Corpus(sums.total, sums.kinds, discount)
    counts = list(answers)
    for n in range(1, order):
        landed = []
        for piece in range(n):                      # longer states are more: one piece after the other, so that shuffle files stay small
            def offer(row: dict, found: dict, n=n, piece=piece) -> Iterator[pa.RecordBatch]:
                block = _rebuilt(row, found, corpus, n + 1, least)
                some, left, known = block.states(n, least)
                yield from _sent(row["block"], block.levels[n - 1].keys[some], [left, known], parts, piece, n)

            sent = _gathered(texts, counts[:n + 1], parts, offer, f"{kinds}, sum1 binary")
            landed.append(land(_summed(sent, parts, np.float32, _weight, pieces=n), f"lm-weights{n}"))
        answers.append(reduce(DataFrame.unionByName, landed))
    return corpus, answers


def score(docs: DataFrame, text: str = "text", key: str = "doc_id", order: int = ORDER, least: int = LEAST) -> DataFrame:
    """One row per row of ``docs``: key, held_out, n_tokens, n_known,
    train_tokens, base_score (add-one unigrams), score (by the automaton).

    Documents whose crc32 of the key's text leaves HELD_OUT modulo FOLDS are
    held out, all others are learnt from.  A null text counts as empty (its
    end token alone), a null key as the empty text's; repeated rows are
    counted and scored each; an empty table gives no rows; a text longer than
    a block is a block of its own; other columns play no part.
    """
    kind = docs.schema[key].dataType.simpleString()
    held = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), held.alias("held"))
    parts = partitions(rows, part_bytes=PART_BYTES)
    texts = land(cut(rows), "lm-texts")
    corpus, answers = fit(texts, parts, order, least)

    def read(row: dict, found: dict) -> Iterator[pa.RecordBatch]:
        block = _rebuilt(row, found, corpus, order, least)
        words, size = block.levels[0], np.diff(block.first)
        doc, count = np.repeat(np.arange(len(size)), size), words.of(words.count)
        base, known, log = (np.bincount(doc, w, len(size)) for w in (corpus.base(count), count > 0, block.read()))
        yield pa.RecordBatch.from_arrays(
            [row["keys"].values, pa.array(np.frombuffer(row["held"], bool)), pa.array(size, pa.int64()),
             pa.array(known.astype(np.int64)), pa.array(np.full(len(size), corpus.total, np.int64)), pa.array(base), pa.array(log)],
            [key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return _gathered(texts, answers, parts, read, f"`{key}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
