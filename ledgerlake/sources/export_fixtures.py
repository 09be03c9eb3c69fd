"""Write the raw export views as the files a daily load receives.

Used by the ingestion queries and tests: Spark writes the test-table-derived
exports (CSV in UTF-8 and GBK, HTML tables, SpreadsheetML workbooks) into a
fresh folder under the shared checkpoint location, a shop's export as files
of a bounded number of rows; the loaders then read them back.  Spreadsheet
layouts are derived as cell tables (``sheet_cells``) and packed into workbooks
(``workbooks``).
"""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Iterable
from functools import cache
from itertools import groupby
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path, shuffles_removed, stored

# Export header names of the order export (as in the platform files).
ORDER_HEADERS = {"order_no": "订单编号", "order_seq": "订单序号", "shop_name": "门店名称（全称）",
                 "status": "订单状态", "refund_status": "退款状态", "placed_at": "下单时间",
                 "receivable": "商户应收金额 (元)", "receivable_fmt": "金额/展示"}
COURIER_HEADERS = {"order_no": "订单编号", "store": "配送门店", "status": "状态", "placed_on": "下单日期",
                   "dist_km": "距离", "fee": "总配送费"}
BILL_HEADERS = {"order_no": "订单号", "shop_name": "门店名称", "bill_date": "账单日期", "order_type": "订单类型",
                "settlement": "结算金额", "receivable": "订单应收", "voucher": "代金券"}


def new_root(spark) -> str:
    return scratch_path(spark, f"exports/{uuid.uuid4().hex}")


ROWS_PER_FILE = 100_000


def in_parts(df: DataFrame, keys: list[str], spread: list[str], rows: int = ROWS_PER_FILE) -> DataFrame:
    """``df`` with ``part``: the file of its shop that a row goes to.  A shop
    has as many files as it has ``rows`` rows, the rows dealt by hash, so that
    no file, task or window group grows with a large shop.  The counts, a row
    a shop, are stored first: their size is known then, and rows need no
    shuffle to meet them."""
    with shuffles_removed(df.sparkSession):
        count = stored(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).coalesce(1))
    parts = F.ceil(F.col("_n") / rows)
    return df.join(count, keys).withColumn("part", F.pmod(F.xxhash64(*spread), parts)).drop("_n")


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def export_csv(v, root: str, narrow: tuple[str, ...] = (), compression: str = "none") -> str:
    """Order export as CSV, a folder per platform and shop; MT files in GBK.
    The platforms in ``narrow`` lack the display column."""
    from .files import enable_charsets
    enable_charsets(v.spark)
    o = in_parts(v.order_export, ["platform", "shop_id"], ["order_no", "order_seq"])
    base = f"{root}/csv"
    for plats, enc in ((["mt"], "GBK"), (["el", "jd"], "UTF-8")):
        left_out = "金额/展示" if set(plats) <= set(narrow) else None
        rows = o.where(F.col("platform").isin(*plats)).repartition(_tasks(o), "platform", "shop_id", "part")
        rows = rows.select("platform", "shop_id", *[F.col(c).alias(h) for c, h in ORDER_HEADERS.items() if h != left_out])
        with shuffles_removed(v.spark):
            (rows.write.mode("append").option("header", True).option("encoding", enc).option("compression", compression)
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
             .partitionBy("platform", "shop_id").csv(base))
    return base


def _xml_text(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _write_documents(rows: DataFrame, order: list[str], line: Column, path: str, head: Column, tail: Column) -> None:
    """Rows with ``key`` and ``part`` → one compressed text file for each of
    both, a line a row by ``order``: the header is put before the first line
    and the footer after the last.  Rows are shuffled and sorted once; their
    lines are made after that."""
    w = Window.partitionBy("key", "part")
    seq = F.row_number().over(w.orderBy(*order))
    rows = rows.repartition(_tasks(rows), "key", "part")
    body = rows.withColumns({"_seq": seq, "_n": F.count(F.lit(1)).over(w)})
    text = F.concat(F.when(F.col("_seq") == 1, F.concat(head, F.lit("\n"))).otherwise(F.lit("")), line,
                    F.when(F.col("_seq") == F.col("_n"), F.concat(F.lit("\n"), tail)).otherwise(F.lit("")))
    # in the order that the window has already: no second sort
    body = body.select("key", "part", *[F.col(c).alias(f"_{i}") for i, c in enumerate(order)], text.alias("line")).sortWithinPartitions("key", "part", *[f"_{i}" for i in range(len(order))])
    with shuffles_removed(rows.sparkSession):
        (body.select("key", "part", "line").write.mode("overwrite").option("compression", "gzip").partitionBy("key", "part").text(path))


def export_html(v, root: str) -> str:
    """Courier deliveries as HTML pages with a table each, a folder per store."""
    c = in_parts(v.courier.withColumn("key", F.regexp_replace(F.col("store"), r"[^A-Za-z0-9_]", "_")), ["key"], ["order_no", "fee"])
    cells = [F.concat(F.lit("<td>"), F.coalesce(_xml_text(F.col(k)), F.lit("nan")), F.lit("</td>"))
             for k in COURIER_HEADERS]
    line = F.concat(F.lit("<tr>"), *cells, F.lit("</tr>"))
    head = F.lit("<html><body><table border=\"1\"><tr>"
                 + "".join(f"<th>{h}</th>" for h in COURIER_HEADERS.values()) + "</tr>")
    path = f"{root}/html"
    _write_documents(c, ["order_no", "fee", "dist_km", "placed_on", "status"], line, path, head, F.lit("</table></body></html>"))
    return path


def export_spreadsheetml(v, root: str) -> str:
    """EL bill lines as SpreadsheetML workbooks, a folder per shop; empty cells are
    omitted and the next cell carries ``ss:Index``; one unknown entity is
    planted per file."""
    b = in_parts(v.fin_bill.where(F.col("platform") == "el").withColumn("key", F.col("shop_id")), ["key"], ["order_no", "line_no"])
    cols = list(BILL_HEADERS)
    parts = []
    for i, c in enumerate(cols):
        val = F.col(c)
        prev_blank = F.lit(False) if i == 0 else (F.coalesce(F.col(cols[i - 1]), F.lit("")) == "")
        open_tag = F.when(prev_blank, F.lit(f'<Cell ss:Index="{i + 1}">')).otherwise(F.lit("<Cell>"))
        parts.append(F.when(F.coalesce(val, F.lit("")) == "", F.lit("")).otherwise(
            F.concat(open_tag, F.lit('<Data ss:Type="String">'), _xml_text(val), F.lit("</Data></Cell>"))))
    line = F.concat(F.lit("<Row>"), *parts, F.lit("</Row>"))
    header_row = "<Row>" + "".join(f'<Cell><Data ss:Type="String">{h}</Data></Cell>'
                                   for h in BILL_HEADERS.values()) + "</Row>"
    head = F.lit('<?xml version="1.0"?><Workbook xmlns="urn:schemas-microsoft-com:office:spreadsheet" '
                 'xmlns:ss="urn:schemas-microsoft-com:office:spreadsheet"><Worksheet ss:Name="明细&nbsp;">'
                 '<Table>' + header_row)
    path = f"{root}/xml"
    _write_documents(b, ["order_no", "line_no", "dt", "settlement", "receivable"], line, path, head, F.lit("</Table></Worksheet></Workbook>"))
    return path


def sheet_cells(df: DataFrame, file_col: Column, columns: dict[str, str], order: list[str],
                sheet: str = "Sheet1", title_rows: int = 0, group_row: dict[str, str] | None = None,
                blank_every: int = 0, by_row: bool = False) -> DataFrame:
    """A worksheet per file as a cell table: optional title rows, an optional
    group header row (merged two-row header), the header row, then data rows.
    ``blank_every`` inserts an all-blank row after every n-th data row.

    ``by_row``: as cell rows, those of a file together and in order, from one
    pass over ``df``."""
    names = list(columns)
    hdr_rows = title_rows + (2 if group_row else 1)
    w = Window.partitionBy("file").orderBy(*order)
    d = df.select(file_col.alias("file"), *[F.col(c) for c in set(names + order)])
    d = d.withColumn("_n", F.row_number().over(w) - 1)
    row = F.col("_n") + hdr_rows
    if blank_every:
        row = row + F.floor(F.col("_n") / blank_every)
    arr = F.array(*[F.struct(F.lit(i).alias("col"), F.col(c).cast("string").alias("value"))
                    for i, c in enumerate(names)])
    if by_row:
        above = ([{0: f"报表标题{t + 1}"} for t in range(title_rows)] + ([{i: group_row.get(c) for i, c in enumerate(names)}] if group_row else [])
                 + [dict(enumerate(columns.values()))])
        record = lambda r, cells: F.struct(r.cast("int").alias("row"), F.filter(cells, lambda c: c["value"].isNotNull()).alias("cells"))      # noqa: E731
        head = [record(F.lit(r), F.array(*[F.struct(F.lit(i).alias("col"), F.lit(x).cast("string").alias("value")) for i, x in cells.items()])) for r, cells in enumerate(above)]
        own = F.array(record(row, arr))
        d = d.select("file", F.explode(F.when(F.col("_n") == 0, F.concat(F.array(*head), own)).otherwise(own)).alias("r"))
        return d.where(F.size("r.cells") > 0).select("file", F.lit(sheet).alias("sheet"), "r.row", F.col("r.cells.col").alias("cols"), F.col("r.cells.value").alias("values"))
    data = d.select("file", row.cast("int").alias("row"), F.explode(arr).alias("c")).select(
        "file", "row", "c.col", "c.value")
    files = d.select("file").distinct()
    extra = []
    for t in range(title_rows):
        extra.append(files.select("file", F.lit(t).alias("row"), F.lit(0).alias("col"),
                                  F.lit(f"报表标题{t + 1}").alias("value")))
    if group_row:
        r = title_rows
        extra.append(files.select("file", F.lit(r).alias("row"), F.explode(F.array(*[
            F.struct(F.lit(i).alias("col"), F.lit(group_row.get(c)).alias("value"))
            for i, c in enumerate(names)])).alias("c")).select("file", "row", "c.col", "c.value"))
    extra.append(files.select("file", F.lit(hdr_rows - 1).alias("row"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("col"), F.lit(h).alias("value")) for i, h in enumerate(columns.values())]))
        .alias("c")).select("file", "row", "c.col", "c.value"))
    out = data
    for e in extra:
        out = out.unionByName(e)
    return out.select("file", F.lit(sheet).alias("sheet"), F.col("row").cast("int"), F.col("col").cast("int"),
                      "value").where(F.col("value").isNotNull())


@cache
def _letters(col: int) -> str:
    """Column letters of a 0-based column."""
    out = ""
    while col >= 0:
        out, col = chr(65 + col % 26) + out, col // 26 - 1
    return out


_MARKUP = re.compile(r"[&<>\t]")


def _escaped(x: str) -> str:
    return escape(x, {"\t": "&#9;"}) if _MARKUP.search(x) else x


class _Book:
    """A minimal workbook: inline strings, sheets and rows one after the other."""

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"

    def __init__(self, merges: dict[str, list[str]]):
        self.merges, self.names, self.bytes, self.out = merges, [], io.BytesIO(), None
        self.zip = zipfile.ZipFile(self.bytes, "w", zipfile.ZIP_DEFLATED)

    def add(self, sheet: str, row: int, cells: Iterable[tuple[int, str]]) -> None:
        if self.out is None or sheet != self.names[-1]:
            if sheet in self.names:
                raise ValueError(f"rows of sheet {sheet} are not together")
            self._end_sheet()
            self.names.append(sheet)
            self.out = self.zip.open(f"xl/worksheets/sheet{len(self.names)}.xml", "w")
            self.lines = [f'<worksheet xmlns="{self.main}"><sheetData>']
        self.lines.append(f'<row r="{row + 1}">' + "".join([
            f'<c r="{_letters(c)}{row + 1}" t="inlineStr"><is><t xml:space="preserve">{_escaped(x)}</t></is></c>' for c, x in cells]) + "</row>")
        if len(self.lines) >= 1000:
            self._write()

    def _write(self) -> None:
        self.out.write("".join(self.lines).encode())
        self.lines = []

    def _end_sheet(self) -> None:
        if self.out is not None:
            merged = "".join(f'<mergeCell ref="{ref}"/>' for ref in self.merges.get(self.names[-1], ()))
            self.lines.append("</sheetData>" + (f"<mergeCells>{merged}</mergeCells>" if merged else "") + "</worksheet>")
            self._write()
            self.out.close()

    def content(self) -> bytes:
        self._end_sheet()
        self.zip.writestr("xl/workbook.xml", f'<workbook xmlns="{self.main}" xmlns:r="{self.office}"><sheets>' + "".join(
            f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(self.names, 1)) + "</sheets></workbook>")
        self.zip.writestr("xl/_rels/workbook.xml.rels",
                          '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(
                              f'<Relationship Id="r{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(self.names) + 1))
                          + "</Relationships>")
        self.zip.close()
        return self.bytes.getvalue()


def _pack(sheets: dict[str, list[tuple[int, int, str]]], merges: dict[str, list[str]]) -> bytes:
    """A workbook with its sheets in name order."""
    book = _Book(merges)
    for n in sorted(sheets):
        for r, cells in groupby(sorted(sheets[n]), lambda x: x[0]):
            book.add(n, r, [(c, x) for _, c, x in cells])
    return book.content()


def workbooks(cells: DataFrame, merges: dict[str, list[str]] | None = None) -> DataFrame:
    """A cell table as (path, content): the bytes of one xlsx workbook per
    file, as the binary file source gives them.  ``merges``: merged ranges of
    each sheet.  Cell rows, as ``sheet_cells`` gives them, are packed as they
    come: a task holds one compressed workbook, not a file's cells."""
    import pandas as pd
    import pyarrow as pa

    def pack_rows(batches):
        file, book, done = None, None, set()
        result = lambda: pa.RecordBatch.from_arrays([pa.array([file], pa.string()), pa.array([book.content()], pa.binary())], ["path", "content"])      # noqa: E731
        for b in batches:
            for of, sheet, row, cols, values in zip(*(b.column(n).to_pylist() for n in ("file", "sheet", "row", "cols", "values"))):
                if book is None or of != file:
                    if book is not None:
                        yield result()
                    if of in done:
                        raise ValueError(f"rows of {of} are not together")
                    done.add(of)
                    file, book = of, _Book(merges or {})
                book.add(sheet, row, zip(cols, values))
        if book is not None:
            yield result()

    if "values" in cells.columns:
        return cells.mapInArrow(pack_rows, "path string, content binary")

    def pack(batches):
        for b in batches:
            for file, rows in zip(b["file"], b["cells"]):
                sheets: dict[str, list] = {}
                for x in rows:
                    sheets.setdefault(x["sheet"], []).append((x["row"], x["col"], x["value"]))
                yield pd.DataFrame([(file, _pack(sheets, merges or {}))], columns=["path", "content"])

    per_file = cells.repartition(_tasks(cells), "file").groupBy("file").agg(F.collect_list(F.struct("sheet", "row", "col", "value")).alias("cells"))
    return per_file.mapInPandas(pack, "path string, content binary")
