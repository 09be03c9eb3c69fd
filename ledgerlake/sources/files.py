"""Ingestion of daily export files: routing, decoding, header rules, stamping.

Everything after decoding works on one intermediate shape, the **cell table**
``(file, sheet, row, col, value)`` (all text, 0-based row/col), so every
format (CSV, xlsx, HTML table, SpreadsheetML) shares the same header logic:

* files are listed with the ``binaryFile`` source (content not read unless
  a decoder needs it) and routed by ordered glob rules, first match wins;
* CSV, HTML tables and SpreadsheetML are read in byte ranges by
  ``split_files``;
* xlsx is unzipped per file inside ``mapInPandas`` (stdlib ``zipfile`` +
  ``ElementTree``) and emitted as cells — one task per file, no driver hop;
* a reader may give **cell rows** instead, a record ``(file, sheet, row, cols,
  values)`` a row: ``cols`` names the values' columns, null stands for the
  first ones in order.  They need no grouping to become table rows;
* header rows become column names with Column expressions (sanitise,
  de-duplicate, merged two-row headers) and the data rows are pivoted on
  the (small, known) list of names.
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterable
from functools import cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored

CELL_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("sheet", T.StringType()),
    T.StructField("row", T.IntegerType()), T.StructField("col", T.IntegerType()),
    T.StructField("value", T.StringType())])

# What is left of latin-1 text when its GBK pairs, or its GB18030 pairs and
# quadruples, are taken out has no high byte if the bytes are in that encoding.
_GBK_CHARS = r"[\x81-\xFE][\x40-\x7E\x80-\xFE]"
_GB18030_CHARS = r"[\x81-\xFE](?:[\x40-\x7E\x80-\xFE]|[0-9][\x81-\xFE][0-9])"


# ---------------------------------------------------------------------------
# listing, routing, guards
# ---------------------------------------------------------------------------
def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Files under ``folder`` (recursive): path, file name, size.  The
    ``content`` column is pruned away, so nothing is read."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
          .option("pathGlobFilter", pattern).load(folder))
    return df.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
                     F.col("length").alias("bytes"))


#: suffixes by which Spark's readers know a compressed file
COMPRESSED = r"\.(gz|bz2|deflate|lz4|snappy|zst)$"


def route_files(files: DataFrame, rules: list[tuple[str, str, str]], skip: Iterable[str] = (),
                on: str = "path") -> DataFrame:
    """Attach (rule, target) to every file: ``rules`` = ordered (name, glob,
    target); the first matching glob wins; files matching a ``skip`` glob or
    no rule get a null target (reported, not loaded).  A compressed file may
    also match by its name without the suffix that says so."""
    key = F.col(on)
    inner = F.regexp_replace(key, COMPRESSED, "")
    rule = target = None
    for name, glob, tgt in rules:
        cond = key.rlike(fnmatch.translate(glob)) | inner.rlike(fnmatch.translate(glob))
        rule = F.when(cond, F.lit(name)) if rule is None else rule.when(cond, F.lit(name))
        target = F.when(cond, F.lit(tgt)) if target is None else target.when(cond, F.lit(tgt))
    skipped = F.lit(False)
    for g in skip:
        skipped = skipped | key.rlike(fnmatch.translate(g)) | inner.rlike(fnmatch.translate(g))
    return files.select("*", F.when(~skipped, rule).alias("rule"),
                        F.when(~skipped, target).alias("target"),
                        F.when(skipped, F.lit("skipped")).when(rule.isNull(), F.lit("unmatched"))
                        .otherwise(F.lit("routed")).alias("status"))


def require_files(routed: DataFrame, expected: list[str], on: str = "file_name") -> None:
    """Explicit-list mode: raise when a listed file did not arrive."""
    present = {r[0] for r in routed.where(F.col(on).isin(expected)).select(on).distinct().collect()}
    missing = [e for e in expected if e not in present]
    if missing:
        raise FileNotFoundError(f"expected files missing: {missing}")


def completeness(routed: DataFrame, min_files: dict[str, int]) -> DataFrame:
    """Files per target against the required minimum (ok flag per target)."""
    need = routed.sparkSession.createDataFrame(list(min_files.items()), "target string, min_files int")
    have = routed.where(F.col("status") == "routed").groupBy("target").agg(F.count(F.lit(1)).alias("files"))
    return (need.join(have, "target", "left")
            .select("target", F.coalesce("files", F.lit(0)).cast("bigint").alias("files"), "min_files")
            .withColumn("ok", F.col("files") >= F.col("min_files")))


def completeness_guard(routed: DataFrame, min_files: dict[str, int]) -> DataFrame:
    """Fail the load when a target received fewer than its minimum files."""
    c = completeness(routed, min_files)
    short = c.where(~F.col("ok")).collect()    # at most one row per target
    if short:
        raise RuntimeError(f"incomplete load: {[tuple(r) for r in short]}")
    return c


def filename_tag(name: Column | str, pattern: str, default: str) -> Column:
    """Group 1 of ``pattern`` in the file name, else ``default``."""
    c = F.col(name) if isinstance(name, str) else name
    g = F.regexp_extract(c, pattern, 1)
    return F.when(g == "", F.lit(default)).otherwise(g)


# ---------------------------------------------------------------------------
# CSV
# ---------------------------------------------------------------------------
def enable_charsets(spark: SparkSession) -> None:
    """GBK / GB18030 exports need the Java charsets beyond the default CSV
    whitelist; enabled on the session that reads or writes them."""
    if spark.conf.get("spark.sql.legacy.javaCharsets", "false").lower() != "true":
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")


# ---------------------------------------------------------------------------
# xlsx → cells (per-file decoder inside mapInPandas)
# ---------------------------------------------------------------------------
_REF = re.compile(r"([A-Z]+)(\d+)")
_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_RNS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


@cache
def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


# Fixed values of the format: built-in number formats that show a date or time.
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def _date_styles(styles) -> set[int]:
    """Cell styles (by index) whose number format shows a date or time."""
    custom = {int(f.get("numFmtId")): f.get("formatCode", "") for f in styles.iter(f"{_NS}numFmt")}

    def dated(number: int) -> bool:
        code = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]|General', "", custom.get(number, ""), flags=re.I)
        return number in _DATE_FORMATS if number not in custom else bool(re.search(r"[ymdhs]", code, re.I))

    formats = styles.find(f"{_NS}cellXfs")
    return {i for i, x in enumerate(formats if formats is not None else ()) if dated(int(x.get("numFmtId", 0)))}


def _serial_text(serial: str, epoch_1904: bool) -> str:
    """An Excel date number as text; one below 1 is a time of day."""
    from datetime import datetime, timedelta
    days = float(serial)
    day0 = datetime(1904, 1, 1) if epoch_1904 else datetime(1899, 12, 30) if days >= 60 else datetime(1899, 12, 31)
    moment = day0 + timedelta(seconds=round(days * 86400))
    return str(moment.time() if days < 1 else moment)


def _closing(stream, *tags: str):
    """The elements of these names as they end.  What has been read goes at
    once, rows and their parents included."""
    import xml.etree.ElementTree as ET
    above: list = []
    for event, e in ET.iterparse(stream, ("start", "end")):
        if event == "start":
            above.append(e)
            continue
        above.pop()
        if e.tag in tags:
            yield e
        if not any(x.tag in tags for x in above):       # a part of a wanted one stays until that ends
            e.clear()
            if above:
                above[-1].remove(e)


def _sheet_elements(stream):
    """(is it a merged range, attributes, text of ``v``, text of all ``t``) of
    a sheet's cells and merged ranges as they end; nothing else is kept."""
    from xml.parsers import expat

    cell_tag, merge_tag, v_tag, t_tag = (_NS[1:] + x for x in ("c", "mergeCell", "v", "t"))
    found, cell, v, t, into, depth = [], None, None, "", 0, 0

    def start(name, attributes):
        nonlocal cell, v, t, into, depth
        if cell is not None:
            depth += 1
            into = 0
            if name == t_tag:
                into = 2
            elif name == v_tag and depth == 1 and v is None:
                v, into = "", 1
        elif name == cell_tag:
            cell, v, t, into, depth = attributes, None, "", 0, 0
        elif name == merge_tag:
            found.append((True, attributes, None, ""))

    def end(name):
        nonlocal cell, into, depth
        if cell is None:
            return
        into = 0
        if depth:
            depth -= 1
        else:
            found.append((False, cell, v, t))
            cell = None

    def text(x):
        nonlocal v, t
        if into == 2:
            t += x
        elif into:
            v += x

    parser = expat.ParserCreate(namespace_separator="}")
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, text
    while piece := stream.read(1 << 16):
        parser.Parse(piece)
        yield from found
        found.clear()
    parser.Parse(b"", True)
    yield from found


def decode_xlsx(path: str, data: bytes, sheets: list[str] | None = None, header_rows: int = 2):
    """One workbook → cell tuples (file, sheet, row, col, text), sheet by sheet.

    Shared and inline strings are resolved and dates given as text.  A merged
    range repeats its top-left value within the first ``header_rows`` rows
    only: in data rows the other cells stay empty.
    """
    import io
    import xml.etree.ElementTree as ET
    import zipfile

    z = zipfile.ZipFile(io.BytesIO(data))
    names = set(z.namelist())
    shared: list[str] = []
    if "xl/sharedStrings.xml" in names:
        for si in _closing(z.open("xl/sharedStrings.xml"), f"{_NS}si"):
            shared.append("".join(t.text or "" for t in si.iter(f"{_NS}t")))
    dates = _date_styles(ET.fromstring(z.read("xl/styles.xml"))) if "xl/styles.xml" in names else set()
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    epoch_1904 = any(p.get("date1904") in ("1", "true") for p in wb.iter(f"{_NS}workbookPr"))
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    target = {r.get("Id"): r.get("Target") for r in rels}
    for sh in wb.iter(f"{_NS}sheet"):
        name = sh.get("name")
        t = target.get(sh.get(f"{_RNS}id"), "")
        member = t.lstrip("/") if t.startswith("/") else f"xl/{t}"
        if (sheets is not None and name not in sheets) or member not in names:
            continue
        top: dict[tuple[int, int], str] = {}                    # cells of the header rows
        for merge, c, v, inline in _sheet_elements(z.open(member)):
            if merge:
                a, _, b = c.get("ref", "").partition(":")
                ma, mb = _REF.match(a), _REF.match(b or a)
                if not (ma and mb):
                    continue
                r0, c0 = int(ma.group(2)) - 1, _col_index(ma.group(1))
                r1, c1 = int(mb.group(2)) - 1, _col_index(mb.group(1))
                for r in range(r0, min(r1 + 1, header_rows)):
                    for cc in range(c0, c1 + 1):
                        if (r, cc) not in top and (r0, c0) in top:
                            yield path, name, r, cc, top[r0, c0]
                continue
            m = _REF.match(c.get("r", ""))
            if not m:
                continue
            kind, text = c.get("t"), v
            if kind == "inlineStr":
                text = inline
            elif kind == "s" and text is not None:
                text = shared[int(text)]
            elif kind in (None, "n") and text and int(c.get("s", 0)) in dates:
                text = _serial_text(text, epoch_1904)
            if text is not None:
                row, col = int(m.group(2)) - 1, _col_index(m.group(1))
                if row < header_rows:
                    top[row, col] = text
                yield path, name, row, col, text


CELLS_AT_ONCE = 20_000


def workbook_cells(files: DataFrame, sheets: list[str] | None = None, header_rows: int = 2, by_row: bool = False) -> DataFrame:
    """Workbooks given as (path, content) → cell table, in pieces of bounded
    size; missing sheets are skipped silently.  ``by_row``: → cell rows,
    stored."""
    from itertools import chain, islice

    def decode(batches):
        for b in batches:
            cells = chain.from_iterable(decode_xlsx(p, bytes(content), sheets, header_rows)
                                        for p, content in zip(b["path"], b["content"]))
            while rows := list(islice(cells, CELLS_AT_ONCE)):
                yield pd.DataFrame(rows, columns=["file", "sheet", "row", "col", "value"])

    if by_row:
        return _workbook_rows(files, sheets, header_rows)
    return files.select("path", "content").mapInPandas(decode, CELL_SCHEMA)


def rows_of_cells(cells: Iterable[tuple], header_rows: int):
    """One workbook's cells, in the order of ``decode_xlsx`` → (file, sheet,
    row, cols, values, again).  Header rows, which merged ranges add to, come
    at their sheet's end; ``again``: the sheet is not in the order of its rows,
    so that there may be more of this row."""
    from itertools import groupby

    for (file, sheet), own in groupby(cells, lambda c: (c[0], c[1])):
        held, last = {}, -1
        for row, some in groupby(own, lambda c: c[2]):
            cols, values = map(list, zip(*((c[3], c[4]) for c in some)))
            if row < header_rows:
                for kept, x in zip(held.setdefault(row, ([], [])), (cols, values)):
                    kept += x
            else:
                yield file, sheet, row, cols, values, row <= last
                last = max(row, last)
        for row, (cols, values) in sorted(held.items()):
            yield file, sheet, row, cols, values, False


def _workbook_rows(files: DataFrame, sheets: list[str] | None, header_rows: int) -> DataFrame:
    import pyarrow as pa
    from itertools import islice

    types = pa.schema([("file", pa.string()), ("sheet", pa.string()), ("row", pa.int32()), ("cols", pa.list_(pa.int32())),
                       ("values", pa.list_(pa.string())), ("again", pa.bool_())])

    def decode(batches):
        for b in batches:
            for p, content in zip(b.column("path"), b.column("content")):
                found = rows_of_cells(decode_xlsx(p.as_py(), content.as_py(), sheets, header_rows), header_rows)
                while rows := list(islice(found, CELLS_AT_ONCE // 5)):
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), types)], schema=types)

    rows = stored(files.select("path", "content").mapInArrow(decode, "file string, sheet string, row int, cols array<int>, values array<string>, again boolean"))
    mixed = rows.where("again").select("file", "sheet").distinct()
    if mixed.isEmpty():
        return rows.drop("again")
    whole = (rows.join(mixed, ["file", "sheet"], "left_semi").groupBy("file", "sheet", "row")
             .agg(F.flatten(F.collect_list(F.arrays_zip("cols", "values"))).alias("c"))
             .select("file", "sheet", "row", F.col("c.cols").alias("cols"), F.col("c.values").alias("values")))
    return rows.join(mixed, ["file", "sheet"], "left_anti").drop("again").unionByName(whole)


def xlsx_cells(spark: SparkSession, paths: list[str] | str, sheets: list[str] | None = None,
               header_rows: int = 2) -> DataFrame:
    """Workbook files → cell table."""
    return workbook_cells(spark.read.format("binaryFile").load(paths), sheets, header_rows)


# ---------------------------------------------------------------------------
# entities
# ---------------------------------------------------------------------------
def _code_point(hex_digits: Column) -> Column:
    """One Unicode character from its code point in hex (UTF-32 big-endian)."""
    return F.decode(F.unhex(F.lpad(hex_digits, 8, "0")), "UTF-32")


def _unescape(c: Column) -> Column:
    """HTML entities → text: numeric (decimal and hex) first, then the named
    ones, ``&amp;`` last so escaped entities stay literal."""
    c = F.aggregate(F.regexp_extract_all(c, F.lit(r"&#([0-9]+);"), 1), c,
                    lambda acc, n: F.replace(acc, F.concat(F.lit("&#"), n, F.lit(";")),
                                             _code_point(F.hex(n.cast("int")))))
    c = F.aggregate(F.regexp_extract_all(c, F.lit(r"&#[xX]([0-9a-fA-F]+);"), 1), c,
                    lambda acc, h: F.replace(F.replace(acc, F.concat(F.lit("&#x"), h, F.lit(";")), _code_point(h)),
                                             F.concat(F.lit("&#X"), h, F.lit(";")), _code_point(h)))
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                 ("&amp;", "&")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


# ---------------------------------------------------------------------------
# header rules on the cell table
# ---------------------------------------------------------------------------
def sanitize_name(c: Column) -> Column:
    """Header text → column name: trim; full/half-width '(' → '_', ')' dropped;
    【】 dropped; '/' → '_'; whitespace runs → '_'; '_' runs collapsed and
    stripped at the ends; empty → 'unnamed'."""
    x = F.trim(c)
    x = F.translate(x, "（(", "__")
    x = F.translate(x, "）)【】", "")
    x = F.replace(x, F.lit("/"), F.lit("_"))
    x = F.regexp_replace(x, r"\s+", "_")
    x = F.regexp_replace(x, r"_+", "_")
    x = F.regexp_replace(x, r"^_+|_+$", "")
    return F.when(x.isNull() | (x == ""), F.lit("unnamed")).otherwise(x)


def dedupe_names(headers: DataFrame) -> DataFrame:
    """Repeated names within a sheet get ``_1``, ``_2``… in column order."""
    w = Window.partitionBy("file", "sheet", "name").orderBy("col")
    rn = F.row_number().over(w) - 1
    return headers.withColumn("name", F.when(rn == 0, F.col("name"))
                              .otherwise(F.concat_ws("_", "name", rn.cast("string"))))


def unpacked(rows: DataFrame) -> DataFrame:
    """Cell rows as a cell table."""
    place = F.coalesce("cols", F.sequence(F.lit(0), F.size("values") - 1))
    cells = rows.where(F.size("values") > 0).select("file", "sheet", "row", F.explode(F.arrays_zip(place.alias("col"), F.col("values").alias("value"))).alias("c"))
    return cells.select("file", "sheet", "row", "c.col", "c.value").to(CELL_SCHEMA)


def _cells(cells: DataFrame) -> DataFrame:
    return unpacked(cells) if "values" in cells.columns else cells


def _all_columns(cells: DataFrame) -> DataFrame:
    """(file, sheet, col) for every column up to the last used one of a sheet."""
    last = F.coalesce(F.array_max("cols"), F.size("values") - 1) if "values" in cells.columns else F.col("col")
    return (cells.groupBy("file", "sheet").agg(F.max(last).alias("_m"))
            .select("file", "sheet", F.explode(F.sequence(F.lit(0), F.col("_m"))).alias("col")))


def header_names(cells: DataFrame, header_row: int = 0, numbered: bool = False) -> DataFrame:
    """(file, sheet, col, name) from one header row, sanitised and de-duplicated,
    for every column present anywhere in the sheet.  A missing header cell is
    'unnamed', or 'col_<i>' if ``numbered`` (as in SpreadsheetML exports)."""
    v = (_cells(cells.where(F.col("row") == header_row)).groupBy("file", "sheet", "col")
         .agg(F.max("value").alias("v")))
    h = (_all_columns(cells).join(v, ["file", "sheet", "col"], "left")
         .select("file", "sheet", "col", sanitize_name(
             F.coalesce(F.nullif("v", F.lit("")), F.concat(F.lit("col_"), F.col("col").cast("string")))
             if numbered else F.col("v")).alias("name")))
    return dedupe_names(h)


def merged_header_names(cells: DataFrame, header_row: int = 0) -> DataFrame:
    """Two-row header → ``group_sub``: the group carries forward across
    columns; an empty sub becomes ``col_<i>``; no prefix when group == sub."""
    two = (_cells(cells.where(F.col("row").isin(header_row, header_row + 1))).groupBy("file", "sheet", "col")
           .agg(F.max(F.when(F.col("row") == header_row, F.trim("value"))).alias("g"),
                F.max(F.when(F.col("row") == header_row + 1, F.trim("value"))).alias("s")))
    pair = _all_columns(cells).join(two, ["file", "sheet", "col"], "left")
    w = Window.partitionBy("file", "sheet").orderBy("col").rowsBetween(Window.unboundedPreceding, 0)
    group = F.last(F.nullif("g", F.lit("")), ignorenulls=True).over(w)
    sub = F.coalesce(F.col("s"), F.concat(F.lit("col_"), F.col("col").cast("string")))
    pair = pair.withColumn("_group", group).withColumn("_sub", sub)
    name = F.when(F.col("_group").isNotNull() & (F.col("_group") != F.col("_sub")),
                  F.concat_ws("_", "_group", "_sub")).otherwise(F.col("_sub"))
    return dedupe_names(pair.select("file", "sheet", "col", sanitize_name(name).alias("name")))


def _rows_laid_out(rows: DataFrame, headers: DataFrame) -> tuple[DataFrame, list[str]]:
    """Cell rows → (file, sheet, row, a column for each header name), and the
    names.  Only distinct layouts (names in column order) come to the driver;
    files that all have the same need no join."""
    headers = stored(headers)
    names = [r[0] for r in headers.select("name").distinct().orderBy("name").collect()]
    of_sheet = headers.groupBy("file", "sheet").agg(F.sort_array(F.collect_list(F.struct("col", "name"))).alias("layout"))
    layouts = of_sheet.select("layout").distinct().limit(2).collect()
    if len(layouts) == 1:
        place = {n: F.lit(next((c for c, x in layouts[0][0] if x == n), None)).cast("int") for n in names}
    else:
        place = {n: F.col(f"_at{i}") for i, n in enumerate(names)}
        where = headers.groupBy("file", "sheet").agg(F.lit(1).alias("_one"), *[F.min(F.when(F.col("name") == n, F.col("col"))).alias(f"_at{i}") for i, n in enumerate(names)])
        rows = rows.join(stored(where), ["file", "sheet"])
    index = {n: F.when(F.col("cols").isNull(), p).otherwise(F.array_position("cols", p).cast("int") - 1) for n, p in place.items()}
    known = [F.coalesce((i >= 0) & (i < F.size("values")), F.lit(False)) for i in index.values()]
    rows = rows.where(reduce(Column.__or__, known, F.lit(False)))
    return rows.select("file", "sheet", "row", *[F.get("values", i).alias(n) for n, i in index.items()]), names


def cells_to_rows(cells: DataFrame, headers: DataFrame, first_data_row: int,
                  drop_blank: bool = True) -> DataFrame:
    """Data rows of the cell table pivoted into named text columns.

    The pivot list is the distinct header names (metadata: one value per
    column).  Rows with every business cell blank are dropped when
    ``drop_blank``.  Columns missing in some files stay null for them
    (union by name).  Cell rows are laid out one by one, without a shuffle.
    """
    if "values" in cells.columns:
        wide, names = _rows_laid_out(cells.where(F.col("row") >= first_data_row), headers)
        return wide.na.drop(how="all", subset=names) if drop_blank and names else wide
    names = [r[0] for r in headers.select("name").distinct().orderBy("name").collect()]
    data = cells.where(F.col("row") >= first_data_row).join(headers, ["file", "sheet", "col"], "inner")
    wide = data.groupBy("file", "sheet", "row").pivot("name", names).agg(F.first("value"))
    if drop_blank and names:
        wide = wide.na.drop(how="all", subset=names)
    return wide


# ---------------------------------------------------------------------------
# cross-file column alignment (metadata only)
# ---------------------------------------------------------------------------
_COL_I = re.compile(r"^col_\d+$")


def _segments(cols: list[str]) -> tuple[list[str], list[list[str]]]:
    """Named anchors and the unnamed ``col_i`` runs before/between/after them."""
    anchors, runs, cur = [], [], []
    for c in cols:
        if _COL_I.match(c):
            cur.append(c)
        elif c.startswith("_"):
            continue
        else:
            anchors.append(c)
            runs.append(cur)
            cur = []
    runs.append(cur)
    return anchors, runs


def align_plans(headers: dict[str, list[str]]) -> dict[str, dict[str, str | None]]:
    """Per file: {column → new name, or None to drop}.

    The narrowest header is the reference.  When a file has the same named
    anchors, each run of unnamed ``col_i`` columns between two anchors is
    mapped onto the reference run: surplus columns at the start of a run are
    dropped, the rest take the reference names in order.  Files whose
    anchors differ are left unchanged.
    """
    if len(headers) <= 1 or len({len(c) for c in headers.values()}) == 1:
        return {f: {} for f in headers}
    ref_file = min(headers, key=lambda f: len(headers[f]))
    ref_anchors, ref_runs = _segments(headers[ref_file])
    plans: dict[str, dict[str, str | None]] = {}
    for f, cols in headers.items():
        plan: dict[str, str | None] = {}
        anchors, runs = _segments(cols)
        if f != ref_file and cols != headers[ref_file] and anchors == ref_anchors:
            for run, ref_run in zip(runs, ref_runs):
                surplus = len(run) - len(ref_run)
                if surplus < 0:
                    continue
                for c in run[:surplus]:
                    plan[c] = None
                for c, r in zip(run[surplus:], ref_run):
                    if c != r:
                        plan[c] = r
        plans[f] = plan
    return plans


def apply_plan(df: DataFrame, plan: dict[str, str | None]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(plan.get(c) or c) for c in df.columns
                       if not (c in plan and plan[c] is None)])


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Outer union of the columns of several files of one table."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def stamp(df: DataFrame, dt: str, extra: dict[str, str] | None = None,
          source_col: str | None = None) -> DataFrame:
    """Load metadata: partition day, source file, load time, constant tags."""
    cols = {"dt": F.lit(dt).cast("date"),
            "_source_file": F.col(source_col) if source_col else F.col("_metadata.file_name"),
            "_load_time": F.current_timestamp()}
    for k, v in (extra or {}).items():
        cols[k] = F.lit(v)
    return df.withColumns(cols)


def whitelist(df: DataFrame, wanted: list[str]) -> tuple[DataFrame, list[str]]:
    """Keep the whitelisted columns present (by exact name); report the missing."""
    present = [c for c in wanted if c in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in present]), [c for c in wanted if c not in df.columns]
