"""Quality classifier by co-training.

Two views of a document are classified apart: its content (distinct words,
selected by chi-square, and shares of letters, symbols and repeats) and its
page metadata (language, source, recorded length, layout in lines).  Both are
logistic regressions over yes/no features.  Over some rounds each labels the
unlabelled documents that it is surest of, for the other to learn from.  A
held-out part of the labelled rows then calibrates the two views together.

Fitting uses a bounded sample of labelled documents (SAMPLE_LABELLED, the
first by a hash of the key).  Pseudo-labels come from all unlabelled
documents: each round scores every one, and each view labels those it is
surest of for each class (SHARE of all, PSEUDO at most), equal documents once.
Every document is scored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.store import land
from ledgerlake.llm.textarrays import ALNUM, Words, blocks

SAMPLE_LABELLED = 8000
ROUNDS = 4
SURE = 0.97                 # least probability of a pseudo-label
SHARE, PSEUDO = 0.05, 200   # unlabelled documents that a view labels in a round for each class: a share, and at most
KEEP_GOOD = 0.995           # share of good held-out documents that the cut must keep
CUT = 0.5                   # highest cut
WORD_BITS = 18
SELECTED = 4096             # words that the content view uses
_STATS = 12                 # content statistics, 16 steps each
_META = 1 << 12

_CLASSES = np.zeros((5, 256), bool)
_CLASSES[0, ord("A"):ord("Z") + 1] = True
_CLASSES[1, ord("0"):ord("9") + 1] = True
_CLASSES[2] = [b < 128 and not chr(b).isalnum() and b > 32 for b in range(256)]
_CLASSES[3, 10] = True
_CLASSES[4, [ord("|"), ord("{"), ord("}"), ord("<"), ord(">"), ord("\\"), ord("#"), ord("$"), ord("%"), ord("&"), ord("*")]] = True


def _steps(share: np.ndarray) -> np.ndarray:
    """0..15 by size of a share, finer near 0."""
    return np.clip(np.sqrt(np.clip(share, 0, 1)) * 16, 0, 15).astype(np.int64)


def _log_steps(x: np.ndarray) -> np.ndarray:
    return np.clip(np.log2(np.maximum(x, 0) + 1) * 2, 0, 63).astype(np.int64)


def _name(kind: str, value) -> int:
    return zlib.crc32(f"{kind}={value}".encode()) % _META


class Views:
    """Features of a block of documents: (document, feature) pairs, sorted.

    words: hashed words (as they are, before any selection); stats: steps of
    content statistics; meta: hashed metadata.
    """

    def __init__(self, block: pa.RecordBatch):
        words = Words(block.column("text"), ALNUM)
        n = self.n = block.num_rows
        doc = words.doc_of_word()
        code = doc.astype(np.uint64) << np.uint64(WORD_BITS) | words.hash >> np.uint64(64 - WORD_BITS)
        code = np.sort(code.astype(np.uint32) if n < 1 << (32 - WORD_BITS) else code).astype(np.int64)
        code = code[np.append(code[1:] != code[:-1], True)] if len(code) else code
        self.word_doc, self.word = code >> WORD_BITS, code & ((1 << WORD_BITS) - 1)
        size = np.maximum(1, np.diff(words.offsets))
        n_words = np.maximum(1, words.per_doc)
        shares = [np.diff(np.searchsorted(np.flatnonzero(c[words.data]), words.offsets)) / size for c in _CLASSES]
        lines = shares[3] * size
        again = np.bincount(doc[1:][(words.hash[1:] == words.hash[:-1]) & (doc[1:] == doc[:-1])], minlength=n) / n_words
        after = np.bincount(doc[7:][(words.hash[7:] == words.hash[:-7])], minlength=n) / n_words if len(doc) > 7 else np.zeros(n)
        distinct = np.bincount(self.word_doc, minlength=n) / n_words
        mean = size / n_words
        stats = [_steps(s) for s in (shares[0], shares[1], shares[2], shares[4], again, after, distinct, shares[0] * 4, shares[2] * 4)]
        stats += [np.clip(mean, 0, 15).astype(np.int64), np.clip(np.log2(n_words), 0, 15).astype(np.int64), (words.per_doc == 0).astype(np.int64)]
        self.stats = np.stack([i * 16 + s for i, s in enumerate(stats)], 1)
        chars = block.column("n_chars").cast(pa.int64()).to_pylist()
        lang, source = block.column("lang").to_pylist(), block.column("source").to_pylist()
        rows, per_line = _log_steps(lines).tolist(), _log_steps(size / (lines + 1)).tolist()
        recorded = _log_steps(np.array([c or 0 for c in chars], np.float64)).tolist()
        self.meta = np.array([[_name("lang", a), _name("source", b), _name("chars", "none" if x is None else c), _name("lines", r), _name("line", p), _name("pair", f"{a},{b}")]
                              for a, b, x, c, r, p in zip(lang, source, chars, recorded, rows, per_line, strict=True)], np.int64).reshape(n, 6)


def _prepared(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Columns that the views read; metadata that ``docs`` lacks is null."""
    types = {"lang": "string", "source": "string", "n_chars": "bigint"}
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text"),
                       *[(F.col(c) if c in docs.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()])


def _fit(doc: np.ndarray, feature: np.ndarray, n: int, size: int, y: np.ndarray, weight: np.ndarray, steps: int = 200, ridge: float = 1e-3) -> np.ndarray:
    """Logistic regression on yes/no features by gradient steps (Adam); the
    last number is the intercept."""
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    total = max(weight.sum(), 1e-9)
    for t in range(1, steps + 1):
        z = np.bincount(doc, w[feature], n) + w[-1]
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / total
        g = np.append(np.bincount(feature, error[doc], size), error.sum()) + ridge * w / size
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return w


@dataclass
class Model:
    """The two views' weights, the calibration and the cut."""

    select: np.ndarray          # hashed word -> content feature, -1 if unused
    content: np.ndarray
    metadata: np.ndarray
    mixed: np.ndarray           # weights of the two scores, intercept
    cut: float

    def scores(self, views: Views) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good by content, by metadata, and calibrated."""
        doc, feature = _content(views, self.select)
        a = np.bincount(doc, self.content[feature], views.n) + self.content[-1]
        b = self.metadata[views.meta].sum(1) + self.metadata[-1] if views.n else np.zeros(0)
        both = self.mixed[0] * a + self.mixed[1] * b + self.mixed[2]
        return tuple(1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (a, b, both))


def _content(views: Views, select: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    chosen = select[views.word]
    used = chosen >= 0
    return (np.concatenate([views.word_doc[used], np.repeat(np.arange(views.n), _STATS)]),
            np.concatenate([chosen[used] + _STATS * 16, views.stats.ravel()]))


def labelled(labels: DataFrame) -> DataFrame:
    """(key, good): good is quality 1 and not toxic; rows without a quality
    or key don't count, and one bad label makes a document bad."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) != 1)
    rows = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    return rows.groupBy(F.col("doc_id").alias("key")).agg(F.min(good.cast("int")).alias("good"))


def _features(rows: DataFrame, select: np.ndarray | None = None) -> pa.Table:
    """name, good, word, stats, meta of ``rows`` (name, good and what the
    views read), in order of the name's hash; with ``select``, only those
    words that the content view uses.  The caller bounds the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                views = Views(block)
                cut = np.searchsorted(views.word_doc, np.arange(views.n + 1))
                words = [views.word[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                if select is not None:
                    words = [w[select[w] >= 0] for w in words]
                yield pa.RecordBatch.from_arrays(
                    [block.column("name").cast(pa.string()), block.column("good"), *[pa.array([r.astype("<i4").tobytes() for r in x], pa.binary()) for x in (words, views.stats, views.meta)]],
                    ["name", "good", "word", "stats", "meta"])

    got = rows.mapInArrow(run, "name string, good int, word binary, stats binary, meta binary").toArrow()
    names = got["name"].to_pylist()
    return got.take(np.array(sorted(range(len(names)), key=lambda i: (zlib.crc32(names[i].encode()), names[i])), np.int64))


def _views(got: pa.Table) -> Views:
    words = [np.frombuffer(x, "<i4") for x in got["word"].to_pylist()]
    views = Views.__new__(Views)
    views.n, views.word_doc, views.word = len(words), np.repeat(np.arange(len(words)), [len(w) for w in words]), np.concatenate([np.empty(0, "<i4"), *words]).astype(np.int64)
    views.stats = np.stack([np.frombuffer(x, "<i4") for x in got["stats"].to_pylist()]).astype(np.int64)
    views.meta = np.stack([np.frombuffer(x, "<i4") for x in got["meta"].to_pylist()]).astype(np.int64)
    return views


def surest(rows: DataFrame, marks: DataFrame, model: Model, taken: list[set[int]], pseudo: int) -> list[tuple[int, int, int]]:
    """(view, good, row) of the pseudo-labels that the other view gives.

    ``rows`` has key, row (a hash of what the views read) and what the views
    read; rows whose key is in ``marks`` are labelled and get none, nor do
    those in ``taken`` for the view.  Each view labels, of all others, the
    ``pseudo`` surest of each class, by probability to three decimals and then
    by a hash; a probability under SURE is no label.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)        # its size is fixed
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                a, b, _ = shared.value.scores(Views(block))
                sure = pa.array(np.maximum(np.abs(a - 0.5), np.abs(b - 0.5)) >= SURE - 0.5)
                yield pa.RecordBatch.from_arrays([block.column("key"), block.column("row"), pa.array(a), pa.array(b)], ["key", "row", "p0", "p1"]).filter(sure)

    scored = rows.mapInArrow(run, f"key {kind}, row bigint, p0 double, p1 double").join(marks.select("key"), "key", "left_anti")
    scored = land(scored.groupBy("row").agg(F.max("p0").alias("p0"), F.max("p1").alias("p1")), "quality-sure")
    out = []
    for mine, other in ((0, 1), (1, 0)):
        for good in (1, 0):
            p = F.col(f"p{mine}") if good else 1 - F.col(f"p{mine}")
            free = scored.where((p >= SURE) & ~F.col("row").isin(list(taken[other]))) if taken[other] else scored.where(p >= SURE)
            some = free.orderBy(F.desc(F.round(p, 3)), F.xxhash64("row"), "row").limit(pseudo).select("row")
            out += [(other, good, r.row) for r in some.collect()]
    return out


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """Fit on the bounded sample of labelled rows and on pseudo-labels of the
    others.  Without labels of both classes the model keeps every document
    (score: the share of good labels, 1 if none)."""
    read = ["text", "lang", "source", "n_chars"]
    rows, marks = _prepared(docs, key, text), labelled(labels)
    ids = rows.select("key").where(F.col("key").isNotNull())
    some = ids.distinct().join(marks, "key").orderBy(F.xxhash64("key"), "key").limit(SAMPLE_LABELLED)
    every = rows.join(F.broadcast(some), "key").withColumnRenamed("key", "name")        # of rows with one key, the first by hash
    got = _features(every.groupBy("name").agg(F.min_by(F.struct("good", *read), F.xxhash64(*read)).alias("r")).select("name", "r.*"))
    y = np.array(got["good"].to_pylist(), np.int64)
    none = Model(np.full(1 << WORD_BITS, -1), np.zeros(_STATS * 16 + 1), np.zeros(_META + 1), np.zeros(3), 0.0)
    if not (y == 1).any() or not (y == 0).any():
        share = ((y == 1).sum() + 1) / (len(y) + 1)
        none.mixed[2] = np.log(share / max(1 - share, 1e-9))
        return none
    views, known = _views(got), np.arange(len(y))
    held = known[known % 4 == 0]                                # a quarter calibrates
    fit = np.setdiff1d(known, held)
    if any(len(np.unique(y[part])) < 2 for part in (held, fit)):
        held = fit = known                                      # too few labels to part them
    teach = np.zeros(len(y), bool)
    teach[fit] = True
    model = none
    model.select = _select(views, teach, y)
    pool = rows.withColumn("row", F.xxhash64(*read))
    most = max(1, min(PSEUDO, int(SHARE * rows.select("key").join(marks, "key", "left_anti").count())))
    given: list[dict[int, int]] = [{}, {}]                      # pseudo-labels of each view by row
    extra = got.slice(0, 0)                                     # features of the rows that have one
    for round_ in range(ROUNDS + 1):
        seen = _views(pa.concat_tables([got, extra]))
        names = [int(x) for x in extra["name"].to_pylist()]
        target = [np.concatenate([y, [g.get(x, 0) for x in names]]).astype(float) for g in given]
        weight = [np.concatenate([teach, [0.5 * (x in g) for x in names]]).astype(float) for g in given]
        doc, feature = _content(seen, model.select)
        model.content = _fit(doc, feature, seen.n, _STATS * 16 + SELECTED, target[0], weight[0])
        model.metadata = _fit(np.repeat(np.arange(seen.n), seen.meta.shape[1]), seen.meta.ravel(), seen.n, _META, target[1], weight[1])
        if round_ == ROUNDS:
            break
        new = surest(pool, marks, model, [set(g) for g in given], most)
        for view, good, row in new:
            given[view][row] = good
        wanted = sorted({row for _, _, row in new} - set(names))
        if not new:
            break
        if wanted:                                              # 4 * PSEUDO rows at most
            few = pool.where(F.col("row").isin(wanted)).groupBy(F.col("row").alias("name")).agg(F.first(F.struct(*read)).alias("r"))
            extra = pa.concat_tables([extra, _features(few.select("name", F.lit(-1).alias("good"), "r.*"), model.select)])
    model.mixed = _calibrate(model, views, held, y)
    good = np.sort(model.scores(views)[2][held][y[held] == 1])
    model.cut = float(min(CUT, good[int((1 - KEEP_GOOD) * len(good))]))
    return model


def _select(views: Views, teach: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The SELECTED hashed words that tell the classes apart best."""
    size, mine = 1 << WORD_BITS, teach[views.word_doc]
    seen = np.bincount(views.word[mine], minlength=size).astype(float)
    good = np.bincount(views.word[mine & (y[views.word_doc] == 1)], minlength=size).astype(float)
    n, share = teach.sum(), (y[teach] == 1).mean()
    expected = seen * share
    chi = np.where(seen >= 5, (good - expected) ** 2 / np.maximum(expected * (1 - share) * (1 - seen / (n + 1)), 1e-9), 0)
    best = np.argsort(-chi, kind="stable")[:SELECTED]
    best = best[chi[best] > 6.63]                               # the 1 % point
    out = np.full(size, -1)
    out[best] = np.arange(len(best))
    return out


def _calibrate(model: Model, views: Views, held: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the two views' log-odds, not negative, and an intercept."""
    odds = [np.log(p[held] / (1 - p[held])) for p in model.scores(views)[:2]]
    x, w = np.stack([*odds, np.ones(len(held))], 1), np.array([1.0, 0.0, 0.0])
    for _ in range(400):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.eye(3)
        w = w - 0.3 * np.linalg.solve(h, x.T @ (p - y[held]) + 1e-2 * (w - [1, 0, 0]))
        w[:2] = np.maximum(w[:2], 0)
    return w


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", model: Model | None = None) -> DataFrame:
    """(key, content_score, metadata_score, score, keep) per row of ``docs``.

    Scores are probabilities of "good"; keep is false below the model's cut.
    A null text counts as empty; null or absent metadata is a value of its
    own; repeated rows are scored each; an empty table gives no rows.
    """
    model = train(docs, labels, key, text) if model is None else model
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)        # its size is fixed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                a, b, both = shared.value.scores(Views(block))
                yield pa.RecordBatch.from_arrays([block.column("key"), pa.array(a), pa.array(b), pa.array(both), pa.array(both >= shared.value.cut)],
                                                 [key, "content_score", "metadata_score", "score", "keep"])

    return _prepared(docs, key, text).mapInArrow(run, f"`{key}` {kind}, content_score double, metadata_score double, score double, keep boolean")


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns."""
    model = train(docs, labels, key, text)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    ready = _prepared(docs.select(F.col(key), *[F.col(c) for c in names if c != key]), key, text)
    row = F.struct(*[F.col(c) for c in names])
    wide = docs.select(row.alias("row"), F.col(text).alias("text"), *[(F.col(c) if c in names else F.lit(None)).cast(ready.schema[c].dataType).alias(c) for c in ("lang", "source", "n_chars")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                keep = shared.value.scores(Views(block))[2] >= shared.value.cut
                yield block.select(["row"]).filter(pa.array(keep))

    return wide.mapInArrow(run, wide.select("row").schema).select("row.*")
