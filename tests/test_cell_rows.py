"""Cell rows: read in ranges, laid out and packed one by one."""

import gzip
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.session import shuffles_removed
from ledgerlake.sources import export_fixtures as X
from ledgerlake.sources import files as FL
from ledgerlake.sources import split_files as SF
from ledgerlake.sources import tag_rows as TR

ROWS = "file string, sheet string, row int, cols array<int>, values array<string>"


def read_in_ranges(kind, columns, text, cuts):
    """A file's rows, read from ranges that end at these ``>``."""
    pieces = text.encode().split(b">")[:-1]
    ranges, parts, whole = [], {}, {}
    before = [0, 0, 0]
    for block, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(pieces)])):
        batch = pa.RecordBatch.from_arrays([pa.array(["f"] * (b - a), pa.string()), pa.array([block] * (b - a), pa.int64()), pa.array(pieces[a:b], pa.binary())], ["file", "block", "value"])
        ranges.append([r for out in TR.scanner(kind)([batch]) for r in out.to_pylist()])
    for found in ranges:
        for r in found:
            at = (before[0] + r["region"], before[1] + r["closed"], before[2] + r["row"])
            if r["kind"] == TR.WHOLE:
                whole[at] = r["texts"]
            elif r["kind"] == TR.PART:
                parts.setdefault(at, []).append(r)
        total = next((r for r in found if r["kind"] == TR.TOTAL), None)
        if total:
            before = [before[0] + total["region"], before[1] + total["closed"], before[2] + total["row"]]
    types = pa.schema([("file", pa.string()), ("row", pa.int64()), ("parts", pa.list_(pa.struct([TR._TYPES.field(n) for n in ("block", "seq", "began", "open", "lead", "cells", "moved")])))])
    for at, some in parts.items():
        batch = pa.RecordBatch.from_pylist([{"file": "f", "row": 0, "parts": [{k: r[k] for k in ("block", "seq", "began", "open", "lead", "cells", "moved")} for r in some]}], types)
        for out in TR.joiner(columns)([batch]):
            whole.update({at: r["texts"] for r in out.to_pylist()})
    return whole


@pytest.mark.parametrize("kind,columns,text", [
    (TR.Html, TR.html_row, "<html><table><tr><th>a</th></tr>" + "".join(f"<tr><td>{i}</td><td> x<b>y</b> &amp; {i} > 0</td></tr>\n<tr><td>nan</td><td>z</td></tr>" for i in range(20)) + "</table></html>"),
    (TR.SpreadsheetMl, TR.xml_row, "<Workbook><Worksheet><Table>" + "".join(
        f'<Row><Cell><Data ss:Type="String">{i} &lt;</Data></Cell><Cell/><Cell ss:Index="5"><ss:Data>x</ss:Data></Cell></Row>\n<Row><Cell><Data>p</Data></Cell></Row>' for i in range(20)) + "</Table></Worksheet></Workbook>")])
def test_ranges_join_to_the_same_rows(kind, columns, text):
    dice, n = random.Random(4), text.count(">")
    want = read_in_ranges(kind, columns, text, [])
    assert len(want) >= 40 and any("&" in (x or "") or "<" in (x or "") for v in want.values() for x in v)
    for _ in range(30):
        assert read_in_ranges(kind, columns, text, sorted(dice.sample(range(1, n), dice.choice([1, 3, 40])))) == want


def test_compressed_files_are_read_as_plain_ones(spark, tmp_path):
    page = "<table><tr><td>a</td><td>b</td></tr>" + "".join(f"<tr><td>{i}</td><td>é</td></tr>" for i in range(50)) + "</table>"
    book = "<Worksheet><Row><Cell><Data>a</Data></Cell></Row><Row><Cell><Data>1</Data></Cell></Row></Worksheet>"
    (tmp_path / "two").mkdir()
    half = len(page) // 2
    (tmp_path / "p.txt.gz").write_bytes(gzip.compress(page[:half].encode()) + gzip.compress(page[half:].encode()))
    (tmp_path / "two" / "b.txt.gz").write_bytes(gzip.compress(book.encode()))
    rows = SF.html_cells(spark, str(tmp_path / "p.txt.gz"), by_row=True)
    assert sorted(map(tuple, FL.cells_to_rows(rows, FL.header_names(rows, 0), 1).select("row", "a", "b").collect())) == [(i + 1, str(i), "é") for i in range(50)]
    assert [(r.row, r.col, r.value) for r in SF.spreadsheetml_cells(spark, str(tmp_path / "two")).orderBy("row").collect()] == [(0, 0, "a"), (1, 0, "1")]


def test_rows_of_one_layout_are_laid_out_without_a_shuffle(spark):
    rows = [("f", "s", 0, None, ["x", "y"]), ("f", "s", 1, None, ["1", "2"]), ("f", "s", 2, [1], ["3"]), ("f", "s", 3, [0, 1], [None, None]), ("f", "s", 4, [1, 1], ["4", "5"])]
    cells = spark.createDataFrame(rows, ROWS)
    out = FL.cells_to_rows(cells, FL.header_names(cells, 0), 1)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, out.select("row", "x", "y").collect())) == [(1, "1", "2"), (2, None, "3"), (4, None, "4")]
    two = spark.createDataFrame([*rows, ("g", "s", 0, None, ["y", "z"]), ("g", "s", 1, None, ["6", "7"])], ROWS)
    got = FL.cells_to_rows(two, FL.header_names(two, 0), 1).select("file", "row", "x", "y", "z").collect()
    assert sorted(map(tuple, got)) == [("f", 1, "1", "2", None), ("f", 2, None, "3", None), ("f", 4, None, "4", None), ("g", 1, None, "6", "7")]


def test_cell_rows_are_packed_as_they_come(spark):
    df = spark.createDataFrame([(s, i, None if i % 3 == 0 else f"a&{i}") for s in "pq" for i in range(30)], "shop string, n int, v string")
    make = lambda by_row: X.sheet_cells(df, F.col("shop"), {"n": "N", "v": ""}, ["n"], title_rows=1, group_row={"n": "G"}, blank_every=4, by_row=by_row)     # noqa: E731
    books = X.workbooks(make(True), {"Sheet1": ["A2:B2"]})
    plan = books._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") == 1
    plain = FL.workbook_cells(X.workbooks(make(False), {"Sheet1": ["A2:B2"]}), header_rows=3)
    got = FL.unpacked(FL.workbook_cells(books, header_rows=3, by_row=True))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_rows_that_come_again_are_one_row(spark):
    cells = [("f", "s", r, c, f"{r}{c}") for r, c in ((0, 0), (2, 0), (1, 0), (2, 1), (0, 1))]
    assert [(x[2], x[3], x[5]) for x in FL.rows_of_cells(cells, 1)] == [(2, [0], False), (1, [0], True), (2, [1], True), (0, [0, 1], False)]


def test_compressed_files_are_routed_by_the_name_within(spark):
    files = spark.createDataFrame([("/x/csv/a.csv.gz",), ("/x/csv/a.csv",), ("/x/a.tmp.gz",), ("/x/a.gzip",)], "path string")
    got = {r.path: (r.rule, r.status) for r in FL.route_files(files, [("any", "*.csv", "t")], skip=["*.tmp"]).collect()}
    assert got == {"/x/csv/a.csv.gz": ("any", "routed"), "/x/csv/a.csv": ("any", "routed"), "/x/a.tmp.gz": (None, "skipped"), "/x/a.gzip": (None, "unmatched")}


def test_documents_are_shuffled_once_and_compressed(spark, tmp_path):
    df = spark.createDataFrame([(k, str(i % 7), i) for k in "ab" for i in range(50)], "key string, o string, i int")
    parted = X.in_parts(df, ["key"], ["i"], rows=30)
    assert "Exchange hashpartitioning" not in parted._jdf.queryExecution().executedPlan().toString()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    X._write_documents(parted, ["o"], F.concat(F.lit("-"), F.col("o")), str(tmp_path / "d"), F.lit("head"), F.lit("tail"))
    assert spark.conf.get(key, None) == old
    files = sorted((tmp_path / "d").glob("*/*/*.txt.gz"))
    assert len(files) == 4
    lines = [gzip.open(f, "rt").read().split("\n") for f in files]
    assert all(x[0] == "head" and x[-2] == "tail" and x[1:-2] == sorted(x[1:-2]) for x in lines) and sum(len(x) - 3 for x in lines) == 100


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    ids = lambda: {str(x) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") for x in [d] if "/shuffle_" in x}      # noqa: E731
    before = ids()
    with shuffles_removed(spark):
        spark.range(1000).repartition(3, "id").write.parquet(str(tmp_path / "t"))
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    import time
    for _ in range(50):
        if not ids() - before:
            break
        time.sleep(0.2)
    assert not ids() - before
