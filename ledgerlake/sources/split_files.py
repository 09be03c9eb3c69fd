"""Large text files read by many tasks: quoted CSV, HTML tables, SpreadsheetML.

Spark's text source cuts a file into byte ranges at a separator.  The pieces
of a range come in order, and the range's start is part of the metadata, so
(file, block, id) orders the pieces of a file, whichever task read them.  Two
scans over that order make up for what a byte range can't know by itself:

* ``states``: is a piece inside something that an earlier piece opened (a
  quoted field, a table cell)?  Each piece says where it leads from outside
  and from inside; ranges are summed up to one such rule each, rules are
  followed from range to range, and every piece gets the state before it.
* ``running``: running sums over a file (record, row and cell numbers).

Both work within ranges first and then on one row per range.  So no task holds
a whole file, and a file of any size is the work of as many tasks as it has
ranges.  HTML tables and SpreadsheetML, which have many more tags than lines,
are read by ``tag_rows`` in one pass over a range's bytes.
"""

from __future__ import annotations

import csv
import io
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, stored
from . import tag_rows as TR
from .files import CELL_SCHEMA, _GB18030_CHARS, _GBK_CHARS, enable_charsets, unpacked

ORDER = ["file", "block", "id"]


def pieces(spark: SparkSession, paths: list[str] | str, separator: str) -> DataFrame:
    """(file, block, id, value): the files cut at ``separator`` (not part of
    the values, whose bytes are as in the file)."""
    text = spark.read.option("lineSep", separator).text(paths)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("id"), "value")


def states(rows: DataFrame, outside: Column, inside: Column, name: str) -> DataFrame:
    """``rows`` with the state before each (true: inside); files begin outside.

    ``outside`` and ``inside`` are the states after a row if the state before
    is outside and inside.  A row keeps the state, swaps it, or sets it; so
    the state follows from the last row that set one and the number of swaps
    since.
    """
    r = rows.withColumns({"_set": F.when(outside == inside, outside), "_swap": (outside & ~inside).cast("long")})
    before = Window.partitionBy("file", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("_swaps", F.coalesce(F.sum("_swap").over(before), F.lit(0)))
    r = r.withColumn("_last", F.last(F.when(F.col("_set").isNotNull(), F.struct("_swaps", "_set")), ignorenulls=True).over(before))
    rule = (r.groupBy("file", "block").agg(F.sum("_swap").alias("_swap"), F.max(F.when(F.col("_set").isNotNull(), F.struct("id", "_swaps", "_set"))).alias("_last"))
            .withColumn("_set", F.col("_last._set") != ((F.col("_swap") - F.col("_last._swaps")) % 2 == 1)))
    # from range to range; a range that sets a state counts no swaps of its own
    rule = rule.withColumn("_swap", F.when(F.col("_set").isNull(), F.col("_swap")).otherwise(0))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rule = rule.withColumn("_swaps", F.coalesce(F.sum("_swap").over(earlier), F.lit(0)))
    rule = rule.withColumn("_last", F.last(F.when(F.col("_set").isNotNull(), F.struct("_swaps", "_set")), ignorenulls=True).over(earlier))
    follow = lambda start: start != ((F.col("_swaps") - F.coalesce("_last._swaps", F.lit(0))) % 2 == 1)     # noqa: E731
    rule = rule.select("file", "block", follow(F.coalesce("_last._set", F.lit(False))).alias("_start"))
    out = r.join(rule, ["file", "block"]).withColumn(name, follow(F.coalesce("_last._set", "_start")))
    return out.drop("_set", "_swap", "_swaps", "_last", "_start")


def running(rows: DataFrame, values: dict[str, Column], greatest: bool = False) -> DataFrame:
    """``rows`` with running sums of ``values`` over each file, this row
    included, or their running maxima (``greatest``; nulls don't count)."""
    add, over = (F.max, F.greatest) if greatest else (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
    r = rows.withColumns({f"_{k}": c.cast("long") for k, c in values.items()})
    here = Window.partitionBy("file", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = r.groupBy("file", "block").agg(*[add(f"_{k}").alias(f"_{k}") for k in values])
    blocks = blocks.select("file", "block", *[add(f"_{k}").over(earlier).alias(f"_before_{k}") for k in values])
    out = r.withColumns({k: add(f"_{k}").over(here) for k in values}).join(blocks, ["file", "block"])
    return out.withColumns({k: over(F.col(k), F.col(f"_before_{k}")) for k in values}).drop(*[f"_{k}" for k in values], *[f"_before_{k}" for k in values])


# ---------------------------------------------------------------------------
# CSV
# ---------------------------------------------------------------------------
_OUT, _IN, _CLOSED, _FIELD = 0, 1, 2, 3


def _after_quotes(line: Column, start: int, separator: str) -> Column:
    """Whether a field is open at the end of a line that begins at the start
    of a field (``_FIELD``) or inside one (``_IN``).

    Followed from quote to quote by the text between them: a quote opens a
    field only at the field's start, one inside closes it, and one right after
    a closing quote was a doubled quote and opens it again.
    """
    between = F.split(line, '"')

    def step(state: Column, text: Column) -> Column:
        opens = F.when(text != "", text.endswith(separator)).otherwise(state.isin(_CLOSED, _FIELD))
        return F.when(state == _IN, F.lit(_CLOSED)).when(opens, F.lit(_IN)).otherwise(F.lit(_OUT))

    return F.aggregate(F.slice(between, F.lit(1), F.size(between) - 1), F.lit(start), step) == _IN


def csv_records(spark: SparkSession, paths: list[str] | str, separator: str = ",") -> DataFrame:
    """(file, number, record): the records of the files, numbered from 1, as
    bytes (binary).  Records end at line ends outside quoted fields; a line
    inside one goes on with the record.  Blank lines are no records."""
    lines = pieces(spark, paths, "\n")
    line = F.decode(F.col("value").cast("binary"), "ISO-8859-1")        # a character for each byte
    quoted = F.instr("value", '"') > 0
    lines = states(lines, F.when(quoted, _after_quotes(line, _FIELD, separator)).otherwise(False),
                   F.when(quoted, _after_quotes(line, _IN, separator)).otherwise(True), "goes_on")
    ends = F.when(F.col("goes_on"), F.when(quoted, ~_after_quotes(line, _IN, separator)).otherwise(False)).otherwise(
        F.when(quoted, ~_after_quotes(line, _FIELD, separator)).otherwise(True))
    lines = lines.select(*ORDER, F.col("value").cast("binary").alias("bytes"), "goes_on", ends.alias("ends"))
    bare = F.when(F.substring("bytes", -1, 1) == F.lit(b"\r"), F.expr("substring(bytes, 1, octet_length(bytes) - 1)")).otherwise(F.col("bytes"))
    blank = ~F.col("goes_on") & (F.octet_length(bare) == 0)
    numbered = materialize(running(lines.where(~blank), {"number": ~F.col("goes_on")}).withColumn("bare", F.when(F.col("ends"), bare).otherwise(F.col("bytes"))).drop("bytes"))
    alone = ~F.col("goes_on") & F.col("ends")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("block", "id", "bare"))), lambda x: x["bare"])
    several = numbered.where(~alone).groupBy("file", "number").agg(parts.alias("parts"))
    joined = F.aggregate(F.slice("parts", F.lit(2), F.size("parts")), F.col("parts")[0], lambda a, b: F.concat(a, F.lit(b"\n"), b))
    return numbered.where(alone).select("file", "number", F.col("bare").alias("record")).unionByName(
        several.select("file", "number", joined.alias("record")))


def csv_files(records: DataFrame, declared: str | None = None) -> DataFrame:
    """(file, encoding, header): UTF-8 when all of a file's bytes are valid
    UTF-8; else the declared encoding, for GBK only if they are valid GBK;
    else GB18030, which holds all of GBK, if they are valid in it; else
    ISO-8859-1.  ``header`` is the first record."""
    latin = F.decode("record", "ISO-8859-1")

    def valid(characters: str) -> Column:
        return F.bool_and(~F.regexp_replace(latin, characters, "").rlike(r"[\x80-\xFF]"))

    named = F.lit(False)
    if declared:
        named = valid(_GBK_CHARS) if declared.upper() == "GBK" else F.lit(True)
    found = records.groupBy("file").agg(
        F.bool_and(F.expr("is_valid_utf8(cast(record AS string))")).alias("utf8"), named.alias("named") if declared and declared.upper() == "GBK" else F.max(named).alias("named"),
        valid(_GB18030_CHARS).alias("gb18030"), F.max(F.when(F.col("number") == 1, F.col("record"))).alias("first"))
    encoding = (F.when(F.col("utf8"), F.lit("utf-8")).when(F.col("named"), F.lit(declared))
                .when(F.col("gb18030"), F.lit("GB18030")).otherwise(F.lit("ISO-8859-1")))
    return found.select("file", encoding.alias("encoding"), _decoded(F.col("first"), encoding, declared).alias("header"))


def _decoded(record: Column, encoding: Column, declared: str | None) -> Column:
    text = F.when(encoding == "utf-8", F.regexp_replace(record.cast("string"), "^\ufeff", ""))
    for other in dict.fromkeys([declared or "GB18030", "GB18030", "ISO-8859-1"]):
        text = text.when(encoding == other, F.decode(record, other))
    return text


def read_csv(spark: SparkSession, paths: list[str] | str, declared: str | None = None, separator: str = ",") -> DataFrame:
    """All-text rows of CSV files with a header record, outer union of their
    columns by name, and ``_source_file`` (the file's name) and ``_path``.

    Encodings are found per file.  Quoted fields may hold separators, doubled
    quotes and line breaks; a quote elsewhere stands for itself.  An unquoted
    empty field is null.  Short records leave the last columns null, fields
    beyond the header are dropped; a name that a header repeats gets ``_1``,
    ``_2``.  Only the distinct headers come to the driver.
    """
    enable_charsets(spark)
    records = csv_records(spark, paths, separator)
    files = materialize(csv_files(records, declared))
    layouts = []
    for row in files.select("header").distinct().orderBy("header").collect():
        seen: Counter[str] = Counter()
        names = []
        for name in next(csv.reader(io.StringIO(row.header), delimiter=separator), []):
            names.append(f"{name}_{seen[name]}" if seen[name] else name)
            seen[name] += 1
        layouts.append((row.header, names))
    width = max((len(names) for _, names in layouts), default=1)
    number = F.coalesce(*[F.when(F.col("header") == header, F.lit(i)) for i, (header, _) in enumerate(layouts)], F.lit(-1))
    files = files.select("file", "encoding", number.alias("layout"))
    options = {"sep": separator, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows = records.where(F.col("number") > 1).join(files, "file")
    fields = F.from_csv(_decoded(F.col("record"), F.col("encoding"), declared), ", ".join(f"_c{i} string" for i in range(max(1, width))), options)
    rows = rows.select("file", "layout", fields.alias("r"))
    columns = list(dict.fromkeys(n for _, names in layouts for n in names))
    taken = [F.coalesce(*[F.when(F.col("layout") == i, F.col("r")[f"_c{names.index(c)}"]) for i, (_, names) in enumerate(layouts) if c in names], F.lit(None).cast("string")).alias(c) for c in columns]
    return rows.select(*taken, F.regexp_extract("file", r"([^/]+)$", 1).alias("_source_file"), F.col("file").alias("_path"))


# ---------------------------------------------------------------------------
# tags: HTML tables and SpreadsheetML
# ---------------------------------------------------------------------------
#: bytes of a file that a task may hold
WHOLE_FILE = 32 << 20


def _range_bytes(spark: SparkSession) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))


def _scanned(spark: SparkSession, paths: list[str] | str, kind: type) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The files' ranges as ``tag_rows`` reads them: their complete rows, the
    other records, of which each range has a few, and what comes before each
    range in its file: (file, block, regions, closings, rows, ahead).

    A file that fits a range is read as it is; of the others, a row for each
    ``>``, only the names come to the driver."""
    files = spark.read.format("binaryFile").load(paths)
    one_range = (F.col("length") <= min(WHOLE_FILE, _range_bytes(spark))) & ~F.col("path").rlike(r"\.(deflate|lz4|snappy|zst)$")
    scan = files.where(one_range).select(F.col("_metadata.file_path").alias("file"), "content").mapInArrow(TR.whole_files(kind), TR.SCANNED)
    if large := [r[0] for r in files.where(~one_range).select("path").collect()]:
        cut = pieces(spark, [re.sub(r"([\\*?\[\]{}])", r"\\\1", x) for x in large], ">")
        scan = scan.unionByName(cut.select("file", "block", F.col("value").cast("binary").alias("value")).mapInArrow(TR.scanner(kind), TR.SCANNED))
    scan = stored(scan)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))       # noqa: E731
    few = stored(scan.where(F.col("kind") != TR.WHOLE).coalesce(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    ranges = few.where(F.col("kind") == TR.TOTAL).select(
        "file", "block", before("region").alias("regions"), before("closed").alias("closings"), before("row").alias("rows"))
    # of the first worksheet: how far a row's place is ahead of its number
    sheets = few.where(F.col("kind") == TR.SHEET).join(ranges, ["file", "block"]).where(F.col("regions") + F.col("region") == 1)
    ahead = sheets.groupBy("file", "block").agg(F.max(F.col("moved") - F.col("rows")).alias("ahead"))
    ranges = ranges.join(ahead, ["file", "block"], "left")
    return scan.where(F.col("kind") == TR.WHOLE), few, stored(ranges.withColumn("ahead", F.max("ahead").over(earlier)))


def _joined(parts: DataFrame, columns) -> DataFrame:
    """The rows that parts of ranges make up."""
    of_row = F.sort_array(F.collect_list(F.struct("block", "seq", "began", "open", "lead", "cells", "moved"))).alias("parts")
    return stored(parts.groupBy("file", "row").agg(of_row).mapInArrow(TR.joiner(columns), TR.JOINED))


def _fill_spans(group: pd.DataFrame) -> pd.DataFrame:
    """Rows that row spans tie together, from the top: a spanning cell goes on
    in its columns, and other cells move past it."""
    out, carried = [], {}                                   # column -> (last row, text)
    for row, cells in group.sort_values(["row", "cell"]).groupby("row", sort=True):
        carried = {c: x for c, x in carried.items() if x[0] >= row}
        here, col = {c: x[1] for c, x in carried.items()}, 0
        for wide, tall, text in zip(cells["wide"], cells["tall"], cells["text"]):
            for _ in range(wide):
                while col in here:
                    col += 1
                here[col] = text
                if tall > 1:
                    carried[col] = (row + tall - 1, text)
        out += [(group["file"].iloc[0], row, c, text) for c, text in sorted(here.items())]
    return pd.DataFrame(out, columns=["file", "row", "col", "value"])


def html_cells(spark: SparkSession, paths: list[str] | str, by_row: bool = False) -> DataFrame:
    """First ``<table>`` of each file (a web page saved as .xlsx), up to its
    end tag → cells, or cell rows (``by_row``).

    Tags and comments inside cells are dropped, entities decoded, text ``nan``
    is null; end tags of rows and cells may be missing.  A cell that spans
    columns or rows fills each place, and pushes later cells of the rows it
    reaches aside.  Rows that no row span ties together are independent of
    each other; the others are filled in groups that end where no span reaches
    on.
    """
    whole, few, ranges = _scanned(spark, paths, TR.Html)
    first = (F.col("regions") + F.col("region") >= 1) & (F.col("closings") + F.col("closed") == 0)
    row = (F.col("rows") + F.col("row") - 1).cast("int").alias("row")
    parts = few.where(F.col("kind") == TR.PART).join(ranges, ["file", "block"]).where(first).withColumn("row", F.col("rows") + F.col("row"))
    parts = _joined(parts, TR.html_row).select("file", (F.col("row") - 1).cast("int").alias("row"), "texts", "wide", "tall")
    found = whole.join(ranges, ["file", "block"]).where(first).select("file", row, "texts", "wide", "tall").unionByName(parts)
    columns = F.when(F.col("wide").isNull(), F.col("texts")).otherwise(F.flatten(F.zip_with("texts", "wide", lambda t, n: F.array_repeat(t, n))))
    plain = lambda of: of.select("file", F.lit("html").alias("sheet"), "row", F.lit(None).cast("array<int>").alias("cols"), columns.alias("values"))      # noqa: E731
    # rows with or under a row span; a group starts at a row under none
    if few.where(F.col("kind") == TR.TOTAL).select("tall").unionAll(parts.select("tall")).where(F.array_max("tall") > 1).isEmpty():
        out = plain(found)
    else:
        spans = stored(found.where(F.array_max("tall") > 1).select("file", "row", F.array_max("tall").alias("tall")))
        under = spans.select("file", F.explode(F.sequence(F.col("row") + 1, F.col("row") + F.col("tall") - 1)).alias("row")).distinct().withColumn("under", F.lit(True))
        tied = spans.select("file", "row").distinct().join(under, ["file", "row"], "full").withColumn("first", F.col("under").isNull())
        tied = running(tied.select("file", F.floor(F.col("row") / TR.MOST_SPANNED).alias("block"), F.col("row").alias("id"), "first"), {"group": F.col("first")}).select("file", F.col("id").alias("row"), "group")
        both = found.join(stored(tied), ["file", "row"], "left")
        ones = F.array_repeat(F.lit(1), F.size("texts"))
        cells = both.where(F.col("group").isNotNull()).select("file", "group", "row", F.posexplode(F.arrays_zip(
            F.coalesce("wide", ones).alias("wide"), F.coalesce("tall", ones).alias("tall"), F.col("texts").alias("text"))).alias("cell", "c")).select("file", "group", "row", "cell", "c.*")
        filled = cells.groupBy("file", "group").applyInPandas(_fill_spans, "file string, row int, col int, value string")
        of_row = F.sort_array(F.collect_list(F.struct("col", "value"))).alias("c")
        filled = stored(filled.groupBy("file", "row").agg(of_row).select("file", F.lit("html").alias("sheet"), "row", F.col("c.col").alias("cols"), F.col("c.value").alias("values")))
        out = plain(both.where(F.col("group").isNull())).unionByName(filled)
    return out if by_row else unpacked(out)


def spreadsheetml_cells(spark: SparkSession, paths: list[str] | str, by_row: bool = False) -> DataFrame:
    """SpreadsheetML (XML workbook), first worksheet → cells, or cell rows
    (``by_row``).

    Unknown entities are removed.  A cell's or a row's 1-based ``ss:Index``
    sets its place, the next ones go on from there; ragged rows have fewer
    cells.
    """
    whole, few, ranges = _scanned(spark, paths, TR.SpreadsheetMl)
    # a row with a place moves itself and all later ones; places only grow
    earlier = F.when(F.col("region") == 0, F.col("ahead"))
    moved = F.coalesce(F.greatest(F.col("moved") - F.col("rows"), earlier), F.lit(0))
    first = lambda of: of.join(ranges, ["file", "block"]).where(F.col("regions") + F.col("region") == 1).withColumns({"moved": moved, "row": F.col("rows") + F.col("row")})      # noqa: E731
    parts = _joined(first(few.where(F.col("kind") == TR.PART)), TR.xml_row).where(F.col("began"))
    found = first(whole).select("file", "row", "moved", "cols", "texts").unionByName(parts.select("file", "row", "moved", "cols", "texts"))
    out = found.select("file", F.lit("xml").alias("sheet"), (F.col("row") - 1 + F.col("moved")).cast("int").alias("row"), "cols", F.col("texts").alias("values"))
    return out if by_row else unpacked(out)
