"""The load ledger and the key sample."""

import hashlib

from pyspark.sql import functions as F

from ledgerlake.plans import quality as Q
from ledgerlake.sources import ledger as L
from ledgerlake.sources import split_files as SF


def test_a_file_is_loaded_once_and_a_changed_one_replaced(spark, tmp_path):
    src, table, book = tmp_path / "in", str(tmp_path / "ods"), str(tmp_path / "ledger")
    (src / "d1").mkdir(parents=True)
    (src / "d2").mkdir()
    (src / "d1" / "账 单+.csv").write_text("k,v\n1,a\n2,b\n")
    (src / "d2" / "账 单+.csv").write_text("k,v\n3,c\n")
    (src / "d2" / "empty.csv").write_text("")

    def load(when):
        got = L.load(spark, str(src), table, book, lambda paths: SF.read_csv(spark, paths), "t", when, "*.csv")
        return sorted((r.source_path.rsplit("/", 2)[1], r.rows) for r in got.collect())

    def rows():
        return sorted((r.k, r.v, str(r._load_time)) for r in L.loaded(spark, table, book).collect())

    assert load("2026-03-25 08:00:00") == [("d1", 2), ("d2", 1)]
    first = rows()
    assert [r[:2] for r in first] == [("1", "a"), ("2", "b"), ("3", "c")]
    assert load("2026-03-26 08:00:00") == [] and rows() == first
    (src / "d1" / "账 单+.csv").write_text("k,v\n2,b\n1,a\n")              # same lines and size in another order
    assert load("2026-03-27 08:00:00") == [("d1", 2)]
    assert [r[2][:10] for r in rows()] == ["2026-03-27", "2026-03-27", "2026-03-25"]
    assert L.read_ledger(spark, book).count() == 3 and L.current(L.read_ledger(spark, book)).count() == 2


def test_nothing_to_load(spark, tmp_path):
    (tmp_path / "in").mkdir()
    got = L.load(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "l"), lambda paths: None, "t")
    assert got.count() == 0 and L.read_ledger(spark, str(tmp_path / "l")).count() == 0


def test_key_sample_is_the_same_for_any_partitioning(spark):
    rows = [(i % 3, i % 50) for i in range(400)] + [(None, 1), (0, None), (7, None)]
    df = spark.createDataFrame(rows, "day int, key int")
    first = lambda keys: ",".join(str(k) for k in sorted(keys, key=lambda k: hashlib.md5(str(k).encode()).hexdigest())[:5])      # noqa: E731
    want = {d: first({k for x, k in rows if x == d and k is not None}) for d in (0, 1, 2, None)}
    for parts in (1, 7):
        got = {r.day: r["sample"] for r in Q.key_sample(df.repartition(parts), "day", "key", 5).collect()}
        assert got == want
    summary = {r.day: (r["rows"], r["sample"]) for r in Q.dq_load_summary(df.withColumn("x", F.lit(1)), "x", "day", "key").collect()}
    assert summary[7] == (1, None) and summary[None] == (1, "1")
