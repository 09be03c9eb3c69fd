"""availableNow file stream → day-partition replace (late finance lines)."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.streaming.incremental import ingest_available


def test_late_file_adds_to_its_day(spark, tmp_path):
    src, table, ck = tmp_path / "in", tmp_path / "ods", tmp_path / "ck"
    src.mkdir()
    (src / "a.csv").write_text("order_no,amount,dt\n1,5.00,2026-03-25\n2,6.00,2026-03-25\n", encoding="utf-8")
    schema = T.StructType([T.StructField("order_no", T.StringType()), T.StructField("amount", T.StringType()),
                           T.StructField("dt", T.DateType())])
    seen = []
    ingest_available(spark, str(src), schema, str(table), str(ck), on_days=seen.extend,
                     options={"header": "true"})
    assert spark.read.parquet(str(table)).count() == 2
    # a late file for the same day keeps what the first one loaded
    (src / "b.csv").write_text("order_no,amount,dt\n3,7.00,2026-03-25\n", encoding="utf-8")
    ingest_available(spark, str(src), schema, str(table), str(ck), on_days=seen.extend,
                     options={"header": "true"})
    rows = spark.read.parquet(str(table)).collect()
    assert sorted(r.order_no for r in rows) == ["1", "2", "3"]
    assert [str(d) for d in seen] == ["2026-03-25", "2026-03-25"]


def test_equal_names_in_two_folders_and_the_days_of_late_lines(spark, tmp_path):
    src, table, ck = tmp_path / "in", tmp_path / "ods", tmp_path / "ck"
    schema = T.StructType([T.StructField("order_no", T.StringType()), T.StructField("dt", T.DateType())])
    orders = spark.createDataFrame([("old\t", "2025-12-15"), ("a", "2026-03-24"), ("b", "2026-03-25"), ("far", "2026-12-01"), (None, "2026-01-01")],
                                   "order_no string, dt string").withColumn("dt", F.col("dt").cast("date"))
    seen = []

    def load(folder, rows):
        (src / folder).mkdir(parents=True)
        (src / folder / "fin.csv").write_text("order_no,dt\n" + "".join(f"{o},2026-03-25\n" for o in rows))
        ingest_available(spark, str(src), schema, str(table), str(ck), on_days=seen.append, options={"header": "true"}, orders=lambda: orders)

    load("d1", ["a", "b", "a"])
    load("d2", ["old", "far", ""])              # placed 100 days before; placed too long after the line; no number
    rows = spark.read.parquet(str(table)).collect()
    assert sorted(r.order_no or "" for r in rows) == ["", "a", "a", "b", "far", "old"]
    assert len({r.source_path for r in rows}) == 2
    assert [[str(d) for d in days] for days in seen] == [["2026-03-24", "2026-03-25"], ["2025-12-15"]]


def test_reload_of_an_empty_day_empties_it(spark, tmp_path):
    import datetime as dt

    from ledgerlake.sources.sinks import replace_partition
    day = [dt.date(2026, 3, 25), dt.date(2026, 3, 26)]
    table = str(tmp_path / "t")
    rows = spark.createDataFrame([("1", day[0]), ("2", day[1])], "order_no string, dt date")
    replace_partition(rows, table)
    replace_partition(rows.where("order_no = 'none'"), table, slices=[day[0]])
    assert [r.order_no for r in spark.read.parquet(table).collect()] == ["2"]
