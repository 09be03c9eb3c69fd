"""Vector codes, collocations and mixing, against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import collocations, mixing, vector_codes

VECTORS = "vec_id bigint, embedding array<double>, label int, id string, vector int, code int"
DOCS = "doc_id bigint, text string, lang string, source string, size int, words string, n int"


# vector codes

def expected_codes(rows, rounds=6):
    """{(id, vector, label): (code, error)}, digest; rows: (id, vector, label) of one length."""
    kept = [(i, [math.floor(4096 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    wide = len(kept[0][1]) // 8
    cut = lambda v, k: v[wide * k:wide * (k + 1)]       # noqa: E731
    books = [[cut(v, k) for _, v, _ in kept[:16]] for k in range(8)]
    near = lambda p, book: min((sum((a - b) ** 2 for a, b in zip(p, c, strict=True)), e) for e, c in enumerate(book))      # noqa: E731
    for _ in range(rounds):
        for k in range(8):
            took = defaultdict(list)
            for _, v, _ in kept:
                took[near(cut(v, k), books[k])[1]].append(cut(v, k))
            books[k] = [[sum(x) // len(took[e]) for x in zip(*took[e], strict=True)] if e in took else c for e, c in enumerate(books[k])]
    out = []
    for i, v, lab in kept:
        best = [near(cut(v, k), books[k]) for k in range(8)]
        out.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), lab))
    errors = Counter()
    for _, _, e, lab in out:
        errors[lab] += e
    digest = hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    return sorted(((i, c, e, errors[lab], digest) for i, c, e, lab in out), key=repr)


def coded(spark, rows):
    df = spark.createDataFrame([(i, v, lab, "x", 1, 2) for i, v, lab in rows], VECTORS).repartition(3)
    return sorted((tuple(r) for r in vector_codes.compress(df).collect()), key=repr)


def vectors(n, dim, scale=1.0, seed=5):
    dice = random.Random(seed)
    rows = [(i * 3 % n, [dice.choice([-1, 0, 0.5, dice.gauss(0, 1)]) * scale for _ in range(dim)], dice.choice([1, 2, None])) for i in range(n)]
    return [*rows, rows[0], rows[0], (rows[3][0], rows[4][1], 1), (None, rows[2][1], 2), (900, None, 1), (901, [float("nan"), *[0.0] * (dim - 1)], 1), (902, [None, *[0.0] * (dim - 1)], 1), (903, [float("inf"), *[0.0] * (dim - 1)], 1)]


@pytest.mark.parametrize("n, dim, scale", [(60, 16, 1.0), (6, 8, 1.0), (40, 8, 1e6)])
def test_codes_as_by_plain_integers(spark, n, dim, scale):
    rows = vectors(n, dim, scale)
    assert coded(spark, rows) == expected_codes(rows)


def test_codes_of_odd_tables(spark):
    assert coded(spark, [(1, None, 1)]) == []
    assert coded(spark, []) == []
    [one] = coded(spark, [(1, [], None)])
    assert one[:4] == (1, "00" * 8, 0, 0)
    mixed = coded(spark, [(1, [1.0] * 8, 1), (2, [1.0] * 16, 1), (3, [2.0] * 5, 1), (4, [1.0] * 8, 1)])
    assert [r[:3] for r in mixed] == [(k, "00" * 8, 0) for k in (1, 2, 3, 4)]
    with pytest.raises(ValueError):
        coded(spark, [(1, [1e300] * 8, 1)])


def test_limb_products_are_exact():
    dice = np.random.default_rng(3)
    for bits, kind in ((5, np.int64), (20, np.int64), (28, np.int64), (50, object)):
        x, y = (dice.integers(-(1 << bits), 1 << bits, (n, 13)) for n in (7, 4))
        exact = [[sum(a * b for a, b in zip(r, c, strict=True)) for c in y.tolist()] for r in x.tolist()]
        assert vector_codes.products(x, y, kind).tolist() == exact


# collocations

def expected_phrases(rows, top=2000):
    counts, total = Counter(), Counter()
    for text, lang in rows:
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for k in (1, 2, 3):
                counts.update((lang or "und", tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    found = {g: a for g, a in counts.items() if len(g[1]) >= 2 and a >= 10}
    dropped = {(lang, g[i:i + 2]) for (lang, g), a in found.items() if len(g) == 3 for i in (0, 1) if 100 * a >= 50 * found[lang, g[i:i + 2]]}
    out = defaultdict(list)
    for (lang, g), a in found.items():
        if (lang, g) not in dropped:
            cuts = [(1000000 * a * a // (counts[lang, g[:k]] * counts[lang, g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(g).encode(), counts[lang, g[:k]], counts[lang, g[k:]]))
    return sorted((lang, rank, p.decode(), -a, left, right, total[lang], -s) for lang, found in out.items() for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1))


def prose(n, seed=2):
    dice = random.Random(seed)
    names = ["the", "The", "of", "new", "york", "city", "état", "ÉTAT", "x" * 300, "a-b"]
    text = lambda k: "".join(dice.choice(names) + dice.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "\x0b"]) for _ in range(k))      # noqa: E731
    rows = [(text(dice.randint(0, 60)), dice.choice(["en", "EN", None, "und", "de"])) for _ in range(n)]
    return [*rows, *[("new york city hall", "en")] * 40, *[("hot pair", "fr")] * 9, (None, "en"), ("", None), (" \t\n", "en"), ("one", "it"), (text(20000), "es")]


def test_phrases_as_by_plain_counting(spark):
    rows = prose(200)
    df = spark.createDataFrame([(i, t, lang, "s", 1, "w", 7) for i, (t, lang) in enumerate(rows)], DOCS).repartition(5)
    got = [tuple(r) for r in collocations.mine(df).collect()]
    assert sorted(got) == expected_phrases(rows)
    few = [tuple(r) for r in collocations.mine(df, top=7).collect()]
    assert sorted(few) == expected_phrases(rows, 7)
    assert collocations.mine(df.limit(0)).count() == 0


def test_long_texts_are_counted_in_turns(monkeypatch):
    monkeypatch.setattr(collocations, "FLUSH", 64)
    rows = prose(30)
    batch = pa.RecordBatch.from_pydict({"text": [t or "" for t, _ in rows], "lang": [lang or "und" for _, lang in rows]})
    sent = pa.Table.from_batches(collocations._send(3)(iter([batch]))).combine_chunks().sort_by([("part", "ascending"), ("length", "ascending")])
    found = pa.Table.from_batches(collocations._frequent(10)(iter(sent.to_batches())))
    monkeypatch.setattr(collocations, "FLUSH", 1 << 20)
    sent = pa.Table.from_batches(collocations._send(1)(iter([batch]))).combine_chunks().sort_by([("part", "ascending"), ("length", "ascending")])
    whole = pa.Table.from_batches(collocations._frequent(10)(iter(sent.to_batches())))
    key = lambda r: repr(sorted(r.items()))     # noqa: E731
    assert found.num_rows > 20 and sorted(found.to_pylist(), key=key) == sorted(whole.to_pylist(), key=key)


def test_three_way_partitions_are_counts():
    dice = np.random.default_rng(4)
    keys = dice.zipf(1.4, (5000, 3)).clip(max=40).astype(np.uint64)
    weight = dice.integers(1, 4, 5000)
    counts = Counter()
    for row, w in zip(keys.tolist(), weight.tolist(), strict=True):
        counts[tuple(row)] += w
    first, total = collocations.three_way(keys, weight, 10)
    assert {tuple(k): t for k, t in zip(keys[first].tolist(), total.tolist(), strict=True)} == {k: c for k, c in counts.items() if c >= 10}
    assert len(first) == len({tuple(k) for k in keys[first].tolist()})
    assert not len(collocations.three_way(keys[:0], weight[:0], 10)[0])


def test_scores_beyond_64_bits(spark):
    big = [(9 * 10 ** 12, 10 ** 13, 9 * 10 ** 12 + 7), (10 ** 13 - 1, 10 ** 13, 10 ** 13), (10, 10, 10), (10, 10 ** 13, 3)]
    got = spark.createDataFrame(big, "a bigint, l bigint, r bigint").select(collocations._score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert [r.s for r in got] == [1000000 * a * a // (left * right) for a, left, right in big]


# mixing

def expected_targets(sizes, share=1.5, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, free, rest = {}, list(order), share * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / total > 2 * sizes[s]]
        if not over:
            target.update({s: rest * weight[s] / total for s in free})
            break
        target.update({s: 2.0 * sizes[s] for s in over})
        rest -= sum(2 * sizes[s] for s in over)
        free = [s for s in free if s not in over]
    return target


def mixture(seed=1):
    dice = random.Random(seed)
    text = lambda k: "".join(dice.choice(["a", "bé", "c𝔘d"]) + dice.choice([" ", "\n", "  ", "  "]) for _ in range(k))        # noqa: E731
    rows = [(i, text(dice.choice([0, 1, 7, 300, 900])), dice.choice(["a", "a", "a", "b", "ü", "Z", "", "tiny", None])) for i in range(120)]
    return [*rows, (5, "w " * 4000, "a"), (None, "x y", "b"), (None, "x y", "b"), (7, None, "none"), (8, "  ", None), (9, "v", "tiny2"), (9, "v", "tiny2")]


def table(spark, rows, parts=4):
    return spark.createDataFrame([(i, t, "en", s, 5, "w", 1) for i, t, s in rows], DOCS).repartition(parts)


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("block", [256, 16])
def test_shares_meet_targets(spark, block):
    rows = mixture()
    got = mixing.shares(table(spark, rows), block=block).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size_of(t)
    assert sorted((r.size, r.doc_id) for r in got if r.doc_id is not None) == sorted((size_of(t), i) for i, t, _ in rows if i is not None)
    assert len(got) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in got)
    want = expected_targets(sizes)
    assert sorted({(r.source_size, round(r.target, 6)) for r in got}) == sorted({(sizes[s], round(t, 6)) for s, t in want.items()})
    again = mixing.shares(table(spark, rows[::-1], 9), block=block).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_mix_holds_what_shares_count(spark):
    rows = [(i, t, s) for i, (_, t, s) in enumerate(mixture())]
    df = table(spark, rows)
    taken = {r.doc_id: r.taken for r in mixing.shares(df).collect()}
    got, words = Counter(), {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t, _ in rows}
    made = mixing.mix(df).collect()
    for r in made:
        piece = r.text.split(" ")
        assert piece == words[r.doc_id][r.first_word:r.first_word + len(piece)]
        got[r.doc_id] += len(piece)
    assert {i: n for i, n in taken.items() if n} == dict(got)
    source = {i: s for i, _, s in rows}
    want, sums = expected_targets(Counter({s: sum(size_of(t) for _, t, x in rows if x == s) for s in set(source.values())})), Counter()
    for i, n in got.items():
        sums[source[i]] += n
    assert all(abs(sums[s] - t) <= 0.5 for s, t in want.items())


def test_shards_draw_their_counts(spark):
    sources = spark.createDataFrame([(1, 200000, 300000.0), (2, 100000, 100000.0), (3, 0, 0.0)], "rank bigint, source_size bigint, target double")
    made = mixing.slots(sources, block=16, shard_slots=1000)
    drawn = mixing.shard_counts(made).collect()
    assert sum(r.words for r in drawn) == 400000 and len({r.shard for r in drawn}) == 25
    first = [r.slots for r in drawn if r["rank"] == 1]          # 18750 slots over 25 shards
    assert abs(np.mean(first) - 750) < 1e-9 and 10 < np.std(first) < 50
    assert made.groupBy("rank", "block").count().where("count > 2").count() == 0


def test_permutations(spark):
    for n in (1, 2, 3, 10, 257, 1000):
        at = spark.range(n).select(F.col("id"), mixing.permute(F.col("id"), F.lit(n), F.lit(7)).alias("to"))
        back = at.select("id", "to", mixing.permute(F.col("to"), F.lit(n), F.lit(7), inverse=True).alias("back")).collect()
        assert sorted(r.to for r in back) == list(range(n)) and all(r.id == r.back for r in back)
    assert sum(abs(r.id - r.to) < 10 for r in back) < 60        # of 1000; nothing near the identity


def test_mix_of_nothing(spark):
    empty = table(spark, mixture()).limit(0)
    assert mixing.shares(empty).count() == 0 and mixing.mix(empty).count() == 0
    blank = mixing.shares(table(spark, [(1, None, None), (2, "", "a")])).collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in blank) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    with pytest.raises(ValueError):
        mixing.shares(empty, share=3.0)
