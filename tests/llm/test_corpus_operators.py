"""Operators that compare documents with each other, against plain Python."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from ledgerlake.llm import components, jaccard, language_model, nearest, quality
from ledgerlake.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, n int, root int, score double, lang string"
ASCII = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def corpus():
    """Random texts, edited copies of some, exact copies, short and empty texts."""
    dice = random.Random(8)
    word = lambda: dice.choice("the of and to in a is".split()) if dice.random() < 0.3 else "".join(dice.choice(["th", "er", "on", "an", "re"]) for _ in range(3))
    out = []
    for _ in range(25):
        text = [word() for _ in range(dice.randint(8, 90))]
        out.append(" ".join(text))
        for _ in range(dice.choice([0, 1, 6])):
            copy = list(text)
            for _ in range(dice.randint(0, 4)):
                copy[dice.randrange(len(copy))] = word()
            out.append("  ".join(copy).upper() if dice.random() < 0.2 else "\n".join(copy))
    return [*out, "", None, "  ", "a b", "A  b", "a b c", "one", " ", "ÀB x", "àB x", out[0], out[0]]


def docs(spark, texts):
    return spark.createDataFrame([(i + 10, t, 1, 2, 0.5, "en") for i, t in enumerate(texts)], SCHEMA)


def shingle_set(text):
    words = ASCII.findall(lower(text))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def expected_groups(texts):
    sets = [shingle_set(t) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both) and both:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return sets, label


@pytest.mark.parametrize("chunk", [512, 2])
def test_jaccard_groups(spark, monkeypatch, chunk):
    monkeypatch.setattr(jaccard, "CHUNK_SETS", chunk)
    texts = corpus()
    sets, label = expected_groups(texts)
    got = {r.doc_id: r for r in jaccard.groups(docs(spark, texts)).collect()}
    for i in range(len(texts)):
        assert got[i + 10].n_shingles == len(sets[i])
        assert got[i + 10].component_id == label[i] + 10, texts[i]
    if chunk == 512:
        kept = sorted(r.doc_id for r in jaccard.keep_one(docs(spark, texts)).collect())
        assert kept == sorted({x + 10 for x in label})


def test_jaccard_null_keys_and_empty(spark):
    rows = spark.createDataFrame([(None, "a b c d e f"), (5, "a b c d e f"), (5, "other words are in here"), (None, "alone is this one text")], "doc_id bigint, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in jaccard.groups(rows).collect())
    assert got == [(0, 1, 0), (0, 2, 5), (5, 1, 5), (5, 2, 5)]
    assert jaccard.groups(rows.limit(0)).count() == 0


def test_components(spark):
    dice = random.Random(4)
    pairs = [(dice.randrange(400), dice.randrange(400)) for _ in range(250)] + [(1000, 1000 + i) for i in range(300)] + [(i, i + 1) for i in range(2000, 2040)]
    label = {x: x for p in pairs for x in p}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            least = min(label[a], label[b])
            changed |= label[a] != least or label[b] != least
            label[a] = label[b] = least
    got = {r.node: r.root for r in components.connected(spark.createDataFrame(pairs, "x bigint, y bigint"), "test").collect()}
    assert all(got.get(x, x) == root for x, root in label.items())
    x, y = components.forest(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    assert {a: b for a, b in zip(x.tolist(), y.tolist(), strict=True)} == {x: r for x, r in label.items() if x != r}


def test_language_model_base(spark):
    texts = corpus() * 3
    rows = docs(spark, texts)
    got = {r.doc_id: r for r in language_model.score(rows).collect()}
    held = {i: zlib.crc32(str(i + 10).encode()) % 7 == 2 for i in range(len(texts))}
    tokens = {i: [*ASCII.findall(lower(t)), None] for i, t in enumerate(texts)}
    count = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    total, kinds = sum(count.values()), len(count)
    for i, words in tokens.items():
        row = got[i + 10]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held[i], len(words), sum(w in count for w in words), total)
        assert row.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (total + kinds + 1)) for w in words))
    outside = [i for i in held if held[i]]
    assert sum(got[i + 10].score for i in outside) > sum(got[i + 10].base_score for i in outside)


def plain_model(texts, held, order=3, least=2):
    """Tokens of the texts, counts of words, and the backoff model's chance of
    an n-gram's last word, by dictionaries."""
    tokens = [[*ASCII.findall(lower(t)), None] for t in texts]
    count = [Counter(tuple(ws[i:i + n]) for ws, h in zip(tokens, held, strict=True) if not h for i in range(len(ws) - n + 1)) for n in range(1, order + 1)]
    total, ones, twos = sum(count[0].values()), sum(c == 1 for c in count[0].values()), sum(c == 2 for c in count[0].values())
    discount = ones / (ones + 2 * twos) if ones and twos else 0.5
    kept = [count[0], *({g: c for g, c in grams.items() if c >= least} for grams in count[1:])]
    more = {}
    for grams in kept[1:]:
        for g in grams:
            more.setdefault(g[:-1], []).append(g)

    def chance(g):
        if len(g) == 1:
            return (count[0][g] - discount) / total if g in count[0] else discount * len(count[0]) / total
        if g in kept[len(g) - 1]:
            return (kept[len(g) - 1][g] - 0.5) / count[len(g) - 2][g[:-1]]
        rest = more.get(g[:-1], [])
        return chance(g[1:]) * max(1 - sum(map(chance, rest)), 1e-12) / max(1 - sum(chance(x[1:]) for x in rest), 1e-12)

    return tokens, count[0], chance


def plain_scores(texts, held, order=3, least=2):
    tokens, _, chance = plain_model(texts, held, order, least)
    return [sum(math.log10(chance(tuple(ws[max(0, i - order + 1):i + 1]))) for i in range(len(ws))) for ws in tokens]


def held_out(texts):
    return [zlib.crc32(str(i + 10).encode()) % 7 == 2 for i in range(len(texts))]


def test_language_model_probabilities_sum_to_one():
    """Of the model that the scores below are held against."""
    texts = corpus()
    tokens, words, chance = plain_model(texts, held_out(texts))
    for context in ((), tuple(tokens[0][:1]), tuple(tokens[0][:2]), tuple(tokens[1][3:5]), ("no", "such")):
        assert sum(chance((*context, *w)) for w in words) + chance((*context, "unknown!")) == pytest.approx(1)


@pytest.mark.parametrize(("size", "segment"), [(1 << 20, 256), (300, 4), (1, 1)])
def test_language_model_is_the_plain_model(spark, monkeypatch, size, segment):
    """However the texts are cut into blocks and segments."""
    monkeypatch.setattr(language_model, "BLOCK_TOKENS", size)
    monkeypatch.setattr(language_model, "SEGMENT", segment)
    texts = corpus()
    got = {r.doc_id: r.score for r in language_model.score(docs(spark, texts)).collect()}
    assert [got[i + 10] for i in range(len(texts))] == pytest.approx(plain_scores(texts, held_out(texts)))


@pytest.mark.parametrize(("order", "least"), [(1, 2), (2, 1), (3, 1), (4, 2)])
def test_language_model_orders(spark, order, least):
    texts = corpus()
    got = {r.doc_id: r.score for r in language_model.score(docs(spark, texts), order=order, least=least).collect()}
    assert [got[i + 10] for i in range(len(texts))] == pytest.approx(plain_scores(texts, held_out(texts), order, least))


def test_language_model_edges(spark):
    """Null keys, clashing names, repeated rows, a very long text, a table
    without training texts, an empty one."""
    long = " ".join(f"w{i % 997}" for i in range(60000))
    rows = spark.createDataFrame([(None, "a b c", 1), (None, None, 2), (7, "a b c", 3), (7, "a b c", 3), (8, long, 4)], "key bigint, text string, block int")
    got = language_model.score(rows, key="key").collect()
    assert sorted((r.key or 0, r.n_tokens) for r in got) == [(0, 1), (0, 4), (7, 4), (7, 4), (8, 60001)]
    assert len({r.score for r in got if r.n_tokens == 4}) == 1
    only = [k for k in range(50) if zlib.crc32(str(k).encode()) % 7 == 2]
    got = language_model.score(spark.createDataFrame([(k, "a b") for k in only], "doc_id bigint, text string")).collect()
    assert len(got) == len(only) and all((r.held_out, r.n_known, r.train_tokens, r.base_score) == (True, 0, 0, 0.0) for r in got)
    assert language_model.score(rows.limit(0), key="key").count() == 0


def test_nearest(spark):
    dice = np.random.default_rng(6)
    table = [(i, (v / np.linalg.norm(v)).astype(np.float32).tolist(), 1.0, 2) for i, v in enumerate(dice.standard_normal((600, 16)))]
    table += [(1000 + i, table[40][1], 1.0, 2) for i in range(60)]                 # a very common vector
    odd = [(2000, None, 1.0, 2), (2020, [], 1.0, 2), (2040, [0.0] * 16, 1.0, 2), (2060, [float("nan")] * 16, 1.0, 2), (None, table[0][1], 1.0, 2), (2080, [1.0, 2.0], 1.0, 2)]
    rows = spark.createDataFrame(table + odd, "vec_id bigint, embedding array<float>, score double, rank int")
    got = {}
    for r in nearest.search(rows).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    x, ids = np.array([r[1] for r in table], np.float32).astype(float), np.array([r[0] for r in table])
    found = wanted = 0
    for q in [i for i in ids.tolist() if i % 20 == 0]:
        score = x @ x[ids.tolist().index(q)]
        order = [i for i in np.lexsort((ids, -score.round(10))).tolist() if ids[i] != q][:20]
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 21))
        found, wanted = found + len({m[1] for m in mine} & set(ids[order].tolist())), wanted + 20
    assert found >= 0.9 * wanted
    assert [m[1] for m in sorted(got[40])] == list(range(1000, 1020)) and not set(got) & {2000, 2020, 2040, 2060, 2080}
    assert nearest.search(rows.limit(0)).count() == 0


def test_nearest_few_rows(spark):
    rows = spark.createDataFrame([(20, [1.0, 0.0]), (3, [0.5, 1.0]), (4, [0.5, 1.0])], "vec_id bigint, embedding array<float>")
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in nearest.search(rows).orderBy("rank").collect()] == [(20, 1, 3, 0.5), (20, 2, 4, 0.5)]


def test_quality_on_held_out_rows(spark):
    docs_, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    learn = labels.where("doc_id % 3 <> 0")
    got = quality.score(docs_, learn).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    good = [r.keep for r in got if r.quality == 1 and r.toxic == 0]
    bad = [r.keep for r in got if r.quality == 0]
    assert len(good) > 90 and np.mean(good) >= 0.95 and np.mean(bad) <= 0.4        # some 270 labels to learn from
    assert quality.keep_good(docs_, learn).columns == docs_.columns


def test_quality_without_labels(spark):
    rows = spark.createDataFrame([(1, None, None), (None, "some text", 3), (1, "", 0)], "doc_id bigint, text string, keep int")
    none = spark.createDataFrame([(1, None, None), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = quality.score(rows, none).collect()
    assert len(got) == 3 and all(r.keep for r in got)
    assert quality.keep_good(rows, none).columns == rows.columns and quality.keep_good(rows, none).count() == 3
    assert quality.score(rows.limit(0), none).count() == 0


def test_pipeline_stages(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    kept, names = table, []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in kept.select("doc_id").collect()}
        result = stage(spark, kept, SF).cache()
        after = {r.doc_id for r in result.select("doc_id").collect()}
        assert after <= before
        names.append(name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert result.columns == table.columns
            kept = result
    whole = {(r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).select("doc_id", "ids_sha256").collect()}
    assert whole == {(r.doc_id, r.ids_sha256) for r in result.collect()}
    texts = {r.doc_id: r.text for r in table.collect()}
    _, label = expected_groups([r.text for r in kept.collect()])
    assert len(set(label)) == len(label)                # no near copies are left
    items = [re.sub(r"[\x09-\x0D]", " ", lower(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(i in re.sub(r"[\x09-\x0D]", " ", lower(texts[r.doc_id])) for r in kept.collect() for i in items)


def test_every_query_runs(spark):
    assert [f"op{n}" for n in range(1, 14)] == sorted((q.split("_")[0] for q in QUERIES), key=lambda x: int(x[2:]))
    for name in QUERIES:
        assert QUERIES[name](spark, SF).count() >= 0
