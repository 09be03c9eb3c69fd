"""Ingestion micro rows (FIXTURES §C): headers, alignment, decoders."""

import io
import zipfile

from pyspark.sql import functions as F

from ledgerlake.sources import files as FL
from ledgerlake.sources import split_files as SF
from ledgerlake.sources import schema as SC
from ledgerlake.sources import sinks as SK


def _cells(spark, rows):
    return spark.createDataFrame([("f", "s", r, c, v) for r, c, v in rows], FL.CELL_SCHEMA)


def test_sanitize_and_dedupe(spark):
    hdr = ["费（元）", "（元）", "a/b", "x", "x", " ", "【备注】 说明"]
    cells = _cells(spark, [(0, i, h) for i, h in enumerate(hdr)])
    got = [r.name for r in FL.header_names(cells, 0).orderBy("col").collect()]
    assert got == ["费_元", "元", "a_b", "x", "x_1", "unnamed", "备注_说明"]


def test_merged_header(spark):
    group = ["G", None, None, "H"]
    sub = ["G", "a", None, "b"]
    rows = [(0, i, g) for i, g in enumerate(group) if g] + [(1, i, s) for i, s in enumerate(sub) if s]
    got = [r.name for r in FL.merged_header_names(_cells(spark, rows), 0).orderBy("col").collect()]
    assert got == ["G", "G_a", "G_col_2", "H_b"]


def test_align_plans():
    plans = FL.align_plans({"ref": ["A", "col_1", "B"], "cur": ["A", "col_1", "col_2", "B"]})
    assert plans["ref"] == {}
    assert plans["cur"] == {"col_1": None, "col_2": "col_1"}
    # different anchors: left alone
    assert FL.align_plans({"r": ["A", "B"], "c": ["A", "C", "col_2"]})["c"] == {}


def test_cells_to_rows_drops_blank_rows(spark):
    rows = [(0, 0, "a"), (0, 1, "b"), (1, 0, "1"), (1, 1, "2"), (3, 1, "4")]
    cells = _cells(spark, rows + [(2, 0, None)])
    out = FL.cells_to_rows(cells, FL.header_names(cells, 0), 1)
    assert sorted(((r.a, r.b) for r in out.collect()), key=repr) == [("1", "2"), (None, "4")]


def _xlsx_bytes():
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rns = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    files = {
        "xl/workbook.xml": f'<workbook {ns} {rns}><sheets><sheet name="订单明细" sheetId="1" r:id="rId1"/>'
                           f'<sheet name="Empty" sheetId="2" r:id="rId2"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/'
                                      'relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/>'
                                      '<Relationship Id="rId2" Target="worksheets/sheet2.xml"/></Relationships>',
        "xl/sharedStrings.xml": f'<sst {ns}><si><t>订单号</t></si><si><t>金额</t></si><si><t>A-1</t></si></sst>',
        "xl/worksheets/sheet1.xml": f'<worksheet {ns}><sheetData>'
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row>'
        '<row r="2"><c r="A2" t="s"><v>2</v></c><c r="B2"><v>12.5</v></c></row>'
        '<row r="3"><c r="A3" t="inlineStr"><is><t>B-2</t></is></c></row>'
        '</sheetData><mergeCells count="1"><mergeCell ref="A3:B3"/></mergeCells></worksheet>',
        "xl/worksheets/sheet2.xml": f'<worksheet {ns}><sheetData/></worksheet>',
    }
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for k, v in files.items():
            z.writestr(k, v)
    return buf.getvalue()


def test_xlsx_decoder(spark, tmp_path):
    p = tmp_path / "账单.xlsx"
    p.write_bytes(_xlsx_bytes())
    cells = FL.xlsx_cells(spark, str(p), sheets=["订单明细", "处罚&赔付"])
    got = sorted((r.sheet, r.row, r.col, r.value) for r in cells.collect())
    # the merge A3:B3 lies in data rows: one value, not two
    assert got == [("订单明细", 0, 0, "订单号"), ("订单明细", 0, 1, "金额"), ("订单明细", 1, 0, "A-1"),
                   ("订单明细", 1, 1, "12.5"), ("订单明细", 2, 0, "B-2")]
    rows = FL.cells_to_rows(cells, FL.header_names(cells, 0), 1)
    assert sorted((r["订单号"], r["金额"]) for r in rows.collect()) == [("A-1", "12.5"), ("B-2", None)]
    # within the header rows it repeats its value
    wide = sorted((r.row, r.col, r.value) for r in FL.xlsx_cells(spark, str(p), ["订单明细"], header_rows=3).collect())
    assert (2, 1, "B-2") in wide


def test_xlsx_dates_are_text():
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    book = zipfile.ZipFile(io.BytesIO(_xlsx_bytes()))
    files = {n: book.read(n) for n in book.namelist()}
    files["xl/styles.xml"] = (f'<styleSheet {ns}><numFmts><numFmt numFmtId="164" formatCode="yyyy&quot;y&quot;m"/>'
                              '<numFmt numFmtId="165" formatCode="0.0&quot;days&quot;"/></numFmts><cellXfs>'
                              '<xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/>'
                              '<xf numFmtId="20"/></cellXfs></styleSheet>')
    files["xl/worksheets/sheet1.xml"] = (
        f'<worksheet {ns}><sheetData><row r="1"><c r="A1" s="1"><v>46106</v></c><c r="B1" s="2"><v>46106.5</v></c>'
        '<c r="C1" s="3"><v>46106</v></c><c r="D1" s="4"><v>0.75</v></c><c r="E1"><v>46106</v></c></row></sheetData></worksheet>')
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for k, x in files.items():
            z.writestr(k, x)
    got = [c[4] for c in FL.decode_xlsx("f", buf.getvalue(), ["订单明细"])]
    assert got == ["2026-03-25 00:00:00", "2026-03-25 12:00:00", "46106", "18:00:00", "46106"]


def test_csv_quotes_line_breaks_and_encodings(spark, tmp_path):
    text = '单号,备注\n1,"x ""y"" z"\n2,"a,b\nc"\n'
    (tmp_path / "gbk.csv").write_bytes(text.encode("gbk"))
    (tmp_path / "gb18030.csv").write_bytes((text + "3,𠮷\n").encode("gb18030"))
    (tmp_path / "bom.csv").write_bytes(text.encode("utf-8-sig"))
    (tmp_path / "latin.csv").write_bytes("n,v\n1,\xe9,\n".encode("latin1"))
    files = SF.csv_files(SF.csv_records(spark, str(tmp_path / "*.csv")), "GBK").collect()
    assert {r.file.rsplit("/", 1)[1]: r.encoding for r in files} == {
        "gbk.csv": "GBK", "gb18030.csv": "GB18030", "bom.csv": "utf-8", "latin.csv": "ISO-8859-1"}
    rows = [r for r in SF.read_csv(spark, str(tmp_path / "*.csv"), "GBK").collect()]
    assert sorted((r["单号"], r["备注"]) for r in rows if r._source_file != "latin.csv") == [
        ("1", 'x "y" z')] * 3 + [("2", "a,b\nc")] * 3 + [("3", "𠮷")]
    assert [(r["n"], r["v"], r["单号"]) for r in rows if r._source_file == "latin.csv"] == [("1", "é", None)]


def test_html_colspan_and_blank_xml_header(spark, tmp_path):
    p = tmp_path / "page.xlsx"
    p.write_text('<table><tr><th>a</th><th>b</th><th>c</th></tr><tr><td colspan="2">1</td><td>2</td></tr></table>')
    assert sorted((r.row, r.col, r.value) for r in SF.html_cells(spark, str(p)).collect())[3:] == [
        (1, 0, "1"), (1, 1, "1"), (1, 2, "2")]
    cells = _cells(spark, [(0, 0, "x"), (1, 0, "1"), (1, 1, "2")])
    assert [r.name for r in FL.header_names(cells, 0, numbered=True).orderBy("col").collect()] == ["x", "col_1"]


def test_spreadsheetml_sparse_and_entities(spark, tmp_path):
    p = tmp_path / "a.xml"
    p.write_text('<?xml version="1.0"?><Workbook xmlns="urn:schemas-microsoft-com:office:spreadsheet" '
                 'xmlns:ss="urn:schemas-microsoft-com:office:spreadsheet"><Worksheet ss:Name="S&nbsp;"><Table>'
                 '<Row><Cell><Data ss:Type="String">a</Data></Cell><Cell><Data>b</Data></Cell>'
                 '<Cell><Data>c</Data></Cell></Row>'
                 '<Row><Cell><Data>x&amp;y</Data></Cell><Cell ss:Index="3"><Data>z</Data></Cell></Row>'
                 '</Table></Worksheet></Workbook>', encoding="utf-8")
    cells = SF.spreadsheetml_cells(spark, str(p))
    got = sorted((r.row, r.col, r.value) for r in cells.collect())
    assert got == [(0, 0, "a"), (0, 1, "b"), (0, 2, "c"), (1, 0, "x&y"), (1, 2, "z")]


def test_html_table(spark, tmp_path):
    p = tmp_path / "page.xlsx"
    p.write_text("<html><table><tr><th>订单</th><th>金额</th></tr><tr><td>1</td><td>nan</td></tr>"
                 "<tr><td><b>2</b></td><td>3&amp;4</td></tr><tr><td>&#20013;&#x6587;</td><td>&amp;#65;</td></tr>"
                 "</table><table><tr><td>no</td></tr></table></html>",
                 encoding="utf-8")
    cells = SF.html_cells(spark, str(p))
    rows = FL.cells_to_rows(cells, FL.header_names(cells, 0), 1, drop_blank=False)
    assert sorted((r["订单"], r["金额"]) for r in rows.collect()) == [("1", None), ("2", "3&4"), ("中文", "&#65;")]


def test_route_first_match_wins(spark):
    files = spark.createDataFrame([("/d/美团-账单（A店）.xlsx",), ("/d/美团-商品明细.csv",), ("/d/x.tmp",)], "path string")
    rules = [("bill", "*美团-账单*.xlsx", "ods_bill"), ("mt_any", "*美团*", "ods_other")]
    got = {r.path: (r.rule, r.status) for r in FL.route_files(files, rules, skip=["*.tmp"]).collect()}
    assert got == {"/d/美团-账单（A店）.xlsx": ("bill", "routed"), "/d/美团-商品明细.csv": ("mt_any", "routed"),
                   "/d/x.tmp": (None, "skipped")}


def test_upsert_last_wins_and_update(spark):
    tgt = spark.createDataFrame([("1", "old"), ("2", "keep")], "k string, v string")
    src = spark.createDataFrame([("1", "a", 1), ("1", "b", 2), ("3", "c", 1)], "k string, v string, pos int")
    got = sorted(tuple(r) for r in SK.upsert_last_wins(tgt, src, ["k"], "pos").collect())
    assert got == [("1", "b"), ("2", "keep"), ("3", "c")]
    dim = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "k string, cost double")
    upd = spark.createDataFrame([("A", 3.456), ("C", 5.0), ("B", -1.0)], "k string, cost double")
    new, missing = SK.update_from(dim, upd, "k", "cost")
    assert sorted(tuple(r) for r in new.collect()) == [("A", 3.46), ("B", 2.0)]
    assert [r.k for r in missing.collect()] == ["C"]


def test_drift_and_conform(spark):
    seen = spark.createDataFrame([("1", None), ("2", "x")], "b string, c string")
    rep = {r.column_name: (r.status, r.filled_rows) for r in SC.drift_report(seen, ["a", "b"]).collect()}
    assert rep == {"a": ("new", None), "b": ("ok", 2), "c": ("extra", 1)}
    df = spark.createDataFrame([("1", "z")], "b string, extra string")
    out = SC.conform(df, SC.text_schema(["a", "b"]))
    assert out.columns == ["a", "b", "dt", "_source_file", "_load_time", "extra"]
