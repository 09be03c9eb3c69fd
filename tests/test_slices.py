"""Versioned slices: one commit, old and new columns, keyed buckets."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.sources import slices as S

D1, D2, D3 = (dt.date(2026, 3, d) for d in (1, 2, 3))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def days(spark, data, schema="k int, day date"):
    return spark.createDataFrame(data, schema)


def test_a_reload_is_one_commit_empty_days_included(spark, tmp_path):
    path = str(tmp_path / "t")
    assert S.numbers(spark, path) == [] and S.version(spark, path).loads == {}
    S.replace(days(spark, [(1, D1), (2, D2), (3, D3), (4, None)]), path, "day")
    before = S.read(spark, path)                                    # a reader that planned before the reload
    S.replace(days(spark, [(9, D1)]), path, "day", slices=[D1, D2])
    assert rows(before) == rows(S.read(spark, path, number=1)) == sorted([(1, D1), (2, D2), (3, D3), (4, None)], key=repr)
    assert rows(S.read(spark, path)) == sorted([(9, D1), (3, D3), (4, None)], key=repr)
    S.replace(days(spark, []), path, "day", slices=[D3, None])
    assert rows(S.read(spark, path)) == [(9, D1)]
    S.replace(days(spark, []), path, "day", slices=[D1])
    assert rows(S.read(spark, path)) == [] and S.read(spark, path).columns == ["k", "day"]
    assert [(r.version, r.slices) for r in S.history(spark, path).orderBy("version").collect()] == [(1, 4), (2, 3), (3, 1), (4, 0)]


def test_a_killed_reload_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    S.replace(days(spark, [(1, D1), (2, D2)]), path, "day")
    with monkeypatch.context() as m:                                # killed between the rows and the version
        m.setattr(S, "_commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            S.replace(days(spark, [(7, D1)]), path, "day", slices=[D1, D2])
    assert rows(S.read(spark, path)) == [(1, D1), (2, D2)]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):          # killed while rows are written
        S.replace(days(spark, [(7, D1)]).withColumn("k", (F.col("k") / F.lit(0)).cast("int")), path, "day")
    (tmp_path / "t" / "_versions" / "0000000002").mkdir()           # killed while the version is written
    assert S.numbers(spark, path) == [1] and rows(S.read(spark, path)) == [(1, D1), (2, D2)]
    S.replace(days(spark, [(7, D1)]), path, "day")
    assert rows(S.read(spark, path)) == [(2, D2), (7, D1)]
    assert len(S.drop_unused(spark, path, keep=1)) == 2 and rows(S.read(spark, path)) == [(2, D2), (7, D1)]


def test_only_the_days_asked_for_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    S.replace(days(spark, [(1, D1), (2, D2), (3, D3)]), path, "day")
    S.replace(days(spark, [(5, D2)]), path, "day")
    one = S.read(spark, path, slices=[D2])
    assert rows(one) == [(5, D2)] and len(one.inputFiles()) == 1
    plan = S.read(spark, path).where(F.col("day") == D3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    with pytest.raises(ValueError, match="sliced by"):
        S.replace(days(spark, [(5, D2)]), path, "k")


def test_columns_are_added_and_widened_without_a_rewrite(spark, tmp_path):
    path = str(tmp_path / "t")
    S.replace(days(spark, [(1, D1, 5)], "k int, day date, n int"), path, "day")
    files = set(S.read(spark, path).inputFiles())
    S.replace(days(spark, [(2, D2, 2 ** 40, "x")], "k int, day date, n bigint, note string"), path, "day")
    assert rows(S.read(spark, path)) == [(1, D1, 5, None), (2, D2, 2 ** 40, "x")]
    assert files < set(S.read(spark, path).inputFiles())
    S.replace(days(spark, [(3, D3)]), path, "day")                  # an old export again: nothing is dropped
    assert rows(S.read(spark, path)) == [(1, D1, 5, None), (2, D2, 2 ** 40, "x"), (3, D3, None, None)]
    S.replace(days(spark, [(4, D1, 6)], "k int, day date, n int"), path, "day")
    assert S.read(spark, path).schema["n"].dataType.simpleString() == "bigint" and (4, D1, 6, None) in rows(S.read(spark, path))
    with pytest.raises(ValueError, match="column n"):
        S.replace(days(spark, [(5, D1, "6")], "k int, day date, n string"), path, "day")
    assert [r.columns for r in S.history(spark, path).orderBy("version").collect()][0] == ["k", "day", "n"]


def test_an_upsert_reads_and_writes_its_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    S.create_keyed(spark.range(2000).selectExpr("id", "'old' AS v"), path, ["id"], 64)
    before = S.version(spark, path).loads
    src = spark.createDataFrame([(5, "a", 1), (5, "b", 2), (5000, "new", 1)], "id bigint, v string, pos int")
    after = S.upsert(src, path, ["id"], "pos", 64).loads
    hit = {str(r[0]) for r in src.select(S.bucket(["id"], 64)).collect()}
    assert {s for s in before if after[s] != before[s]} == hit and len(hit) <= 2
    got = {r.id: r.v for r in S.read_keyed(spark, path).collect()}
    assert len(got) == 2001 and got[5] == "b" and got[5000] == "new" and sum(v == "old" for v in got.values()) == 1999
    assert S.upsert(src.limit(0), path, ["id"], "pos", 64).loads == after
