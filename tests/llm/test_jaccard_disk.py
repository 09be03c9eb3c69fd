"""What the near-copy join sends and shuffles."""

import random
from types import SimpleNamespace

import pyarrow as pa

from ledgerlake.llm import jaccard

SCHEMA = "doc_id bigint, text string"


class Steps:
    """Stands for a table: keeps the functions that are mapped over it."""

    def __init__(self):
        self.kept = []

    def mapInArrow(self, step, schema):     # noqa: N802
        self.kept.append(step)
        return self

    def repartition(self, *_):
        return self


def words(i, n):
    return " ".join(f"w{i}x{j}" for j in range(n))


def test_many_parts_add_little_to_a_shingle(monkeypatch):
    texts = [words(i, 60) for i in range(300)]
    steps = Steps()
    jaccard._survey(steps, "struct<none:boolean,id:bigint,text:bigint>", 400)
    monkeypatch.setattr(jaccard, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    keys = pa.array([{"none": False, "id": i, "text": i} for i in range(300)], pa.struct([("none", pa.bool_()), ("id", pa.int64()), ("text", pa.int64())]))
    out = list(steps.kept[0](iter([pa.RecordBatch.from_arrays([keys, pa.array(texts)], ["key", "text"])])))
    arrays = [c for b in out for c, f in zip(b.columns, b.schema, strict=True) if f.type == pa.binary()]
    size = sum(len(v) for c in arrays for v in c.to_pylist() if v is not None)
    assert 4 * 56 * 300 <= size < 9 * 56 * 300       # four bytes are the hash


def test_sets_are_sent_only_where_one_may_link(spark, monkeypatch):
    """A chain of texts, each of which shares a half with the next: one
    candidate group, but few pairs that have a first shingle in common."""
    texts = [(i, f"{words(i, 30)} {words(i + 1, 30)}") for i in range(14)]
    texts += [(100, texts[3][1] + " more"), (101, "more " + texts[11][1])]
    sent, joined = [], jaccard._joined
    monkeypatch.setattr(jaccard, "CHUNK_SETS", 2)
    monkeypatch.setattr(jaccard, "_joined", lambda rows, parts, inner: (inner or sent.append(rows.where("asked").count()), joined(rows, parts, inner))[1])
    got = {r.doc_id: r.component_id for r in jaccard.groups(spark.createDataFrame(texts, SCHEMA)).collect()}
    assert got == {i: {100: 3, 101: 11}.get(i, i) for i, _ in texts}
    assert sent and 0 < sum(sent) <= 4 * len(texts)


def test_rows_that_no_join_needs_go_before_it(spark):
    rows = spark.createDataFrame([((i is None, i, t),) for i, t in [(None, 7), (None, 8), *((i, i * 31) for i in range(1000))]], "key struct<none:boolean,id:bigint,text:bigint>")
    wanted = spark.createDataFrame([(None, 7), (5, 155), (6, 186), (7, 1)], "__id bigint, __text bigint")
    some = jaccard._needed(rows, wanted)
    found = [r.key.id for r in jaccard._rows_of(some, wanted).collect()]
    assert sorted(found, key=repr) == [5, 6, None] and some.count() <= 10
    assert jaccard._needed(rows, wanted.limit(0)).count() == 0


def test_copies_in_several_blocks_are_one_set(spark, monkeypatch):
    """Exact copies in many blocks don't hide that a set has its shingles alone."""
    monkeypatch.setattr(jaccard, "FLUSH", 50)
    dice = random.Random(2)
    rows = [(i, words(0, 40)) for i in range(6)] + [(6, words(0, 40)), (6, words(0, 40)), (None, words(0, 40))] + [(20 + i, words(20 + i, dice.randint(3, 30))) for i in range(9)]
    near = [(40 + i, words(50, 40) + " more" * i) for i in range(3)] + [(43, words(50, 40)), (None, words(50, 40))]
    seen, land = {}, jaccard.land

    def kept(df, name, **more):
        seen[name] = land(df, name, **more)
        return seen[name]

    monkeypatch.setattr(jaccard, "land", kept)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.groups(spark.createDataFrame(rows + near, SCHEMA).repartition(5)).collect()}
    expected = {(i, 36, 0) for i in [*range(7), None]} | {(i, max(1, len(t.split()) - 4), i) for i, t in rows[9:]}
    assert got == expected | {(40, 36, 40), (41, 37, 40), (42, 38, 40), (43, 36, 40), (None, 36, 40)}
    assert seen["jaccard-chosen"].count() == 3       # the sets of ``near`` alone
