"""Files read in byte ranges: small ranges against plain readers."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.sources import split_files as SF

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_ranges(spark):
    """Ranges of some 200 bytes."""
    old = {k: spark.conf.get(k) for k in (SPLIT, "spark.sql.files.openCostInBytes")}
    for k in old:
        spark.conf.set(k, "200")
    yield spark
    for k, x in old.items():
        spark.conf.set(k, x)


def field(dice):
    plain = ["", "a", "5\" pipe", "x y", " pad ", "é中", "it's", 'a""b', "0"]
    quoted = ['"a,b"', '"two\nlines"', '"say ""hi"""', '""', '"""q"""', '"\n\n"', '"tail\n"', '"a\n""\n,b"']
    return dice.choice(plain if dice.random() < 0.7 else quoted)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_csv_in_small_ranges(small_ranges, tmp_path, end):
    dice = random.Random(3)
    want = []
    for k in range(3):
        records = [[str(i), *[field(dice) for _ in range(3)]] for i in range(300)]
        text = end.join(["id,n1,\"n\n2\",n3", *[",".join(r) for r in records], ""])
        (tmp_path / f"f{k}.csv").write_bytes(text.encode())
        want += [(f"f{k}.csv", *[x.replace("\r\n", "\n") for x in r]) for r in list(csv.reader(io.StringIO(text, newline="")))[1:]]
    cut = SF.pieces(small_ranges, str(tmp_path), "\n")
    assert cut.select("file", "block").distinct().count() > 50
    rows = SF.read_csv(small_ranges, str(tmp_path)).collect()
    got = [(r["_source_file"], r["id"], r["n1"] or "", r["n\n2"] or "", r["n3"] or "") for r in rows]
    assert sorted(got) == sorted(want)


def test_csv_layouts_short_records_and_repeated_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v,v\n1,2,3\n\n4\n5,6,7,8\n")
    (tmp_path / "b.csv").write_text("v,w\n9,\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text("k,v\n")
    got = SF.read_csv(spark, str(tmp_path)).select("k", "v", "v_1", "w", "_source_file").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([
        ("1", "2", "3", None, "a.csv"), ("4", None, None, None, "a.csv"), ("5", "6", "7", None, "a.csv"), (None, "9", None, None, "b.csv")], key=repr)


def test_an_open_quote_takes_the_rest(small_ranges, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,\"a\n" + "2,b\n" * 200)
    rows = SF.read_csv(small_ranges, str(tmp_path)).collect()
    assert len(rows) == 1 and rows[0].k == "1" and rows[0].v.startswith("a\n2,b\n2,b")


def test_states_follow_rules_of_any_kind(small_ranges):
    dice = random.Random(9)
    rules = [(dice.choice([(0, 1), (0, 1), (1, 0), (0, 0), (1, 1)])) for _ in range(500)]
    rows = [("f", i // 7, i, bool(a), bool(b)) for i, (a, b) in enumerate(rules)]
    df = small_ranges.createDataFrame(rows, "file string, block bigint, id bigint, a boolean, b boolean").repartition(5)
    got = {r.id: r.s for r in SF.states(df, F.col("a"), F.col("b"), "s").collect()}
    now, want = 0, {}
    for i, rule in enumerate(rules):
        want[i] = bool(now)
        now = rule[now]
    assert got == want


def grid(cells):
    out = {}
    for r in cells.collect():
        out.setdefault(r.file.rsplit("/", 1)[1], {}).setdefault(r.row, {})[r.col] = r.value
    return {f: [[rows[k].get(c) for c in range(max(rows[k]) + 1)] for k in sorted(rows)] for f, rows in out.items()}


def spanned(rows):
    """The table's grid, place by place."""
    taken = {}
    for r, cells in enumerate(rows):
        c = 0
        for text, wide, tall in cells:
            for _ in range(wide):
                while (r, c) in taken:
                    c += 1
                for below in range(r, min(r + tall, len(rows))):
                    taken.setdefault((below, c), text)
    last = [max(c for k, c in taken if k == r) for r in range(len(rows))]
    return [[taken.get((r, c)) for c in range(last[r] + 1)] for r in range(len(rows))]


def test_html_spans_in_small_ranges(small_ranges, tmp_path):
    dice = random.Random(6)
    want = {}
    for k in range(3):
        rows, body = [], ""
        for r in range(150):
            cells = [(f"t{r}.{c}", dice.choice([1, 1, 1, 2]), dice.choice([1] * 12 + [2, 4])) for c in range(4)]
            rows.append(cells)
            close = dice.choice(["</td>", ""])
            body += "<TR class='x'>" + "\n".join(
                f'<td{f" colspan={w}" if w > 1 else ""}{f" rowspan={chr(34)}{h}{chr(34)}" if h > 1 else ""}><b>{t}</b>{close}' for t, w, h in cells) + dice.choice(["</tr>", ""])
        (tmp_path / f"p{k}.html").write_text(f"<html><!-- <x --><p>1 > 0</p><table border=1>{body}</table><table><tr><td>no</td></tr></table></html>")
        want[f"p{k}.html"] = spanned(rows)
    assert grid(SF.html_cells(small_ranges, str(tmp_path))) == want


def test_html_cells_keep_text_only(spark, tmp_path):
    (tmp_path / "a.html").write_text("<table><tr><td> a <br/>b<!-- c --> > d&lt;e </td><td/><td>nan</td><th></th></tr></table>")
    (tmp_path / "b.html").write_text("no table here")
    assert grid(SF.html_cells(spark, str(tmp_path))) == {"a.html": [["a b > d<e", "", None, ""]]}


def test_spreadsheetml_in_small_ranges(small_ranges, tmp_path):
    dice = random.Random(2)
    body, want, row = "", {}, 0
    for r in range(200):
        skip = dice.choice([0] * 9 + [3])
        row += skip
        body += f'<Row{f" ss:Index={chr(34)}{row + 1}{chr(34)}" if skip else ""} ss:Height="12">'
        col = 0
        for c in range(5):
            jump = dice.choice([0, 0, 0, 2])
            col += jump
            index = f' ss:Index="{col + 1}"' if jump else ""
            if dice.random() < 0.2:
                body += f"<Cell{index}/>"
            else:
                body += f'<ss:Cell{index}><ss:Data ss:Type="String">v{r}.{c} &gt; &nbsp;&#20013;</ss:Data></ss:Cell>\n'
                want[row, col] = f"v{r}.{c} > 中"
            col += 1
        body += "</Row>"
        row += 1
    (tmp_path / "a.xml").write_text('<?xml version="1.0"?><Workbook><Styles><Style/></Styles><Worksheet ss:Name="A"><Table>' + body
                                    + '</Table></Worksheet><Worksheet ss:Name="B"><Table><Row><Cell><Data>no</Data></Cell></Row></Table></Worksheet></Workbook>', encoding="utf-8")
    cells = SF.spreadsheetml_cells(small_ranges, str(tmp_path)).collect()
    assert {(r.row, r.col): r.value for r in cells if r.value is not None} == want
    assert len(cells) == 1000
