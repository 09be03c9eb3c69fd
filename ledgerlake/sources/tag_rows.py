"""Rows of HTML tables and SpreadsheetML, read from byte ranges in one pass.

A reader goes through the tags of one range and counts from the range's
start.  A row that begins and ends in the range is complete (``WHOLE``).  What
is left at the range's ends, or lies beside a table's tags, is kept as parts
(``PART``) that ``join_parts`` puts together; ``TOTAL`` and ``SHEET`` records
say how far a range moves the counts of the next ones.  So no task holds a
whole file, and only the rows at the ends of ranges meet in a shuffle.
"""

from __future__ import annotations

import bz2
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc

WHOLE, PART, TOTAL, SHEET = 0, 1, 2, 3

#: ``region``: tables or worksheets begun so far in the range, ``closed``:
#: tables ended, ``row``: rows begun.  ``cols`` is null if the texts fill the
#: columns from the first on; ``wide`` and ``tall`` are null if all are 1.
#: ``moved``: the most that a row's place is ahead of its number, so far.
#: A part's ``lead`` is the text before the range's first tag that opens or
#: ends a cell, ``open``: is a cell open at the part's end (null: as before);
#: a cell without attributes is more text of the cell before.
SCANNED = ("file string, block bigint, seq int, kind tinyint, region int, closed int, row bigint, moved bigint, "
           "cols array<int>, texts array<string>, wide array<int>, tall array<int>, "
           "began boolean, open boolean, lead binary, cells array<struct<attributes:binary,text:binary>>")
_TYPES = pa.schema([
    ("file", pa.string()), ("block", pa.int64()), ("seq", pa.int32()), ("kind", pa.int8()), ("region", pa.int32()), ("closed", pa.int32()),
    ("row", pa.int64()), ("moved", pa.int64()), ("cols", pa.list_(pa.int32())), ("texts", pa.list_(pa.string())),
    ("wide", pa.list_(pa.int32())), ("tall", pa.list_(pa.int32())), ("began", pa.bool_()), ("open", pa.bool_()), ("lead", pa.binary()),
    ("cells", pa.list_(pa.struct([("attributes", pa.binary()), ("text", pa.binary())])))])

_TAG = re.compile(rb"<(/?[A-Za-z][A-Za-z0-9:_-]*)([^<>]*)>")
ROWS_AT_ONCE = 20_000
BYTES_AT_ONCE = 4 << 20


# ---------------------------------------------------------------------------
# texts and attributes
# ---------------------------------------------------------------------------
def _character(hex_digits: str) -> str:
    code = int(hex_digits.rjust(8, "0")[:8], 16)
    return "" if code == 0xFEFF else "?" if 0xD800 <= code < 0xE000 else chr(code)


def unescape(text: str) -> str:
    """As ``files._unescape``."""
    if "&" not in text:
        return text
    for n in re.findall(r"&#([0-9]+);", text):
        text = text.replace(f"&#{n};", _character(f"{int(n):X}"))
    for h in re.findall(r"&#[xX]([0-9a-fA-F]+);", text):
        text = text.replace(f"&#x{h};", _character(h)).replace(f"&#X{h};", _character(h))
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = text.replace(a, b)
    return text


def html_text(text: bytes | None) -> str | None:
    plain = unescape(re.sub(rb"(?s)<!--.*?-->", b"", text or b"").decode("utf-8", "replace")).strip(" \r\n")
    return None if plain == "nan" else plain


_UNKNOWN = re.compile(r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#[xX][0-9a-fA-F]+);)[A-Za-z0-9#]+;")


def xml_text(text: bytes | None) -> str | None:
    if text is None:
        return None
    plain = text.decode("utf-8", "replace")
    return unescape(_UNKNOWN.sub("", plain)).replace("&apos;", "'") if "&" in plain else plain


def number(attributes: bytes, name: bytes) -> int | None:
    """A number among the attributes, else None."""
    found = re.search(rb"(?i)(?:^|[\s:])" + name + rb"\s*=\s*[\"']?\s*([0-9]+)", attributes) if attributes else None
    return int(found[1]) if found and int(found[1]) < 1 << 31 else None


#: rows that a cell may span, as browsers have it
MOST_SPANNED = 65534


def html_row(cells: list) -> dict:
    """The columns of a row from its cells (attributes, text)."""
    spans = [(min(1000, max(1, number(a, b"colspan") or 1)), min(MOST_SPANNED, max(1, number(a, b"rowspan") or 1))) for a, _ in cells]
    plain = all(x == (1, 1) for x in spans)
    return {"texts": [html_text(t) for _, t in cells], "wide": None if plain else [w for w, _ in spans], "tall": None if plain else [h for _, h in spans]}


def xml_row(cells: list) -> dict:
    """A place in force counts from its cell; without one, from the row's first."""
    cols, shift = [], 0
    for i, (attributes, _) in enumerate(cells):
        place = number(attributes, b"Index")
        shift = shift if place is None else place - 1 - i
        cols.append(i + shift)
    return {"texts": [xml_text(t) for _, t in cells], "cols": None if cols == list(range(len(cols))) else cols}


# ---------------------------------------------------------------------------
# readers of a range
# ---------------------------------------------------------------------------
class _Reader:
    """What one range holds; its records leave by ``take``."""

    ends: frozenset[bytes]
    simple: re.Pattern[bytes]      # rows that need no look at single tags

    def __init__(self, file: str, block: int):
        self.file, self.block, self.seq = file, block, 0
        self.region = self.closed = self.row = 0
        self.moved: int | None = None
        self.tallest = 1                        # of complete rows' cells
        self.open: bool | None = None           # not known before the first tag that tells
        self.began, self.cells, self.lead = False, [], None
        self.records: list[dict] = []
        self.batches: list[pa.RecordBatch] = []

    def record(self, kind: int, **columns) -> None:
        self.records.append({"kind": kind, "seq": self.seq, "region": self.region, "closed": self.closed, "row": self.row, "moved": self.moved, **columns})
        self.seq += 1
        if len(self.records) >= ROWS_AT_ONCE:
            self.pack()

    def pack(self) -> None:
        if self.records:
            n, kept = len(self.records), self.records
            self.batches.append(pa.RecordBatch.from_arrays(
                [pa.array([self.file] * n), pa.array([self.block] * n, pa.int64())] + [pa.array([r.get(f.name) for r in kept], f.type) for f in list(_TYPES)[2:]], schema=_TYPES))
            self.records = []

    def take(self) -> list[pa.RecordBatch]:
        out, self.batches = self.batches, []
        return out

    def feed(self, data: bytes) -> None:
        """A piece of the range, which ends where a ``>`` is."""
        at, end = 0, len(data)
        while at < end:
            if self.open is False and (m := self.simple.match(data, at)):
                found = []
                while m:
                    found.append(m[1])
                    at = m.end()
                    m = self.simple.match(data, at)
                self.rows(found)
                continue
            m = _TAG.search(data, at)
            if m is None:
                self.text(data[at:])
                return
            name = m[1].lower()
            self.tag(name.replace(b"ss:", b"", 1) if name.startswith((b"ss:", b"/ss:")) else name, m[2], data[at:m.start()])
            at = m.end()

    def text(self, text: bytes) -> None:
        if self.open is None:
            self.lead = (self.lead or b"") + text
        elif self.open and self.cells:
            self.cells[-1][1] = text if self.cells[-1][1] is None else self.cells[-1][1] + text
        elif self.open and not self.began:      # of a cell that an earlier range began
            self.cells.append([None, text])

    def leave(self, whole: bool) -> None:
        """The end of a row, or of what is known of it."""
        if whole and self.began:
            if self.cells:
                columns = self.columns(self.cells)
                self.tallest = max(self.tallest, *(columns.get("tall") or [1]))
                self.record(WHOLE, **columns)
        elif self.cells or self.began or self.lead is not None:
            self.record(PART, began=self.began, open=self.open, lead=self.lead, cells=[{"attributes": a, "text": t} for a, t in self.cells])
        self.began, self.cells, self.lead = False, [], None

    def finish(self) -> None:
        self.leave(False)
        self.record(SHEET)
        self.record(TOTAL, tall=[self.tallest])
        self.pack()


class Html(_Reader):
    ends = frozenset((b"/td", b"/th", b"tr", b"/tr", b"table", b"/table"))
    simple = re.compile(rb"\s*<tr><td>((?:[^<>&]*</td><td>)*[^<>&]*)</td></tr>")
    columns = staticmethod(html_row)

    def tag(self, name: bytes, attributes: bytes, text: bytes) -> None:
        self.text(text)
        if name in (b"td", b"th"):
            self.cells.append([attributes, None])
            self.open = True
        elif name in self.ends:
            self.open = False
            if name == b"tr":
                self.leave(True)
                self.row += 1
                self.began = True
            elif name in (b"table", b"/table"):
                self.leave(False)
                self.region += name == b"table"
                self.closed += name == b"/table"

    def rows(self, found: list[bytes]) -> None:
        """Rows of plain cells; the last one may go on."""
        self.leave(True)
        if (n := len(found) - 1) > 0:
            self.pack()
            try:
                bodies = pa.array(found[:-1], pa.binary()).cast(pa.string())
            except pa.ArrowInvalid:
                bodies = pa.array([x.decode("utf-8", "replace") for x in found[:-1]])
            cut = pc.split_pattern(bodies, "</td><td>")
            texts = pc.ascii_trim(cut.values, characters=" \r\n")
            texts = pa.ListArray.from_arrays(cut.offsets, pc.if_else(pc.equal(texts, "nan"), pa.scalar(None, pa.string()), texts))
            known = {"file": pa.repeat(self.file, n), "block": pa.repeat(pa.scalar(self.block, pa.int64()), n), "kind": pa.repeat(pa.scalar(WHOLE, pa.int8()), n),
                     "region": pa.repeat(pa.scalar(self.region, pa.int32()), n), "closed": pa.repeat(pa.scalar(self.closed, pa.int32()), n),
                     "row": pa.array(range(self.row + 1, self.row + 1 + n), pa.int64()), "texts": texts}
            self.batches.append(pa.RecordBatch.from_arrays([known[f.name] if f.name in known else pa.nulls(n, f.type) for f in _TYPES], schema=_TYPES))
        self.row += len(found)
        self.began, self.cells = True, [[b"", x] for x in found[-1].split(b"</td><td>")]


class SpreadsheetMl(_Reader):
    ends = frozenset((b"/data", b"cell", b"/cell", b"row", b"/row", b"worksheet"))
    simple = re.compile(rb'\s*<Row>((?:<Cell(?: ss:Index="[0-9]{1,9}")?><Data(?: [^<>/]*)?>[^<>]*</Data></Cell>)*)</Row>')
    cell = re.compile(rb'<Cell([^<>]*)><Data[^<>]*>([^<>]*)</Data>')
    columns = staticmethod(xml_row)

    def tag(self, name: bytes, attributes: bytes, text: bytes) -> None:
        if name != b"worksheet":
            self.text(text)
        if name == b"data" and not attributes.endswith(b"/"):
            self.open = True
        elif name in self.ends:
            self.open = False
            if name == b"cell":
                self.cells.append([attributes, None])
            elif name == b"row":
                self.leave(True)
                self.row += 1
                self.began = True
                if (place := number(attributes, b"Index")) is not None:
                    self.moved = max(place - self.row, self.moved if self.moved is not None else place - self.row)
            elif name == b"worksheet":
                self.leave(False)
                self.record(SHEET)
                self.region, self.moved = self.region + 1, None

    def rows(self, found: list[bytes]) -> None:
        for body in found:
            self.leave(True)
            self.row += 1
            self.began, self.cells = True, [[*x] for x in self.cell.findall(body)]


# ---------------------------------------------------------------------------
# functions for mapInArrow
# ---------------------------------------------------------------------------
def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """(file, block, first, last) of a batch's runs of one range."""
    file, block, n, first = batch.column("file"), batch.column("block"), batch.num_rows, 0
    while first < n:
        key = (file[first], block[first])
        last = n
        if (file[n - 1], block[n - 1]) != key:
            same = pc.and_(pc.equal(file.slice(first), key[0]), pc.equal(block.slice(first), key[1]))
            last = first + pc.index(same, False).as_py()
        yield key[0].as_py(), key[1].as_py(), first, last
        first = last


def scanner(kind: type[_Reader]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(file, block, value) in order, cut at every ``>`` → ``SCANNED``."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, waiting, size = None, [], 0
        for batch in batches:
            for file, block, first, last in _runs(batch):
                if reader is None or (reader.file, reader.block) != (file, block):
                    if reader is not None:
                        reader.feed(b"".join(waiting))
                        reader.finish()
                        yield from reader.take()
                    reader, waiting, size = kind(file, block), [], 0
                values = batch.column("value").slice(first, last - first)
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, last - first], pa.int32()), values), b">")[0].as_py()
                waiting += [joined, b">"]
                size += len(joined) + 1
                if size >= BYTES_AT_ONCE:
                    reader.feed(b"".join(waiting))
                    yield from reader.take()
                    waiting, size = [], 0
        if reader is not None:
            reader.feed(b"".join(waiting))
            reader.finish()
            yield from reader.take()

    return scan


def _plain(content: memoryview, file: str) -> Iterator[bytes]:
    """A file's bytes without its compression, in pieces."""
    unpacker = bz2.BZ2Decompressor if file.endswith(".bz2") else (lambda: zlib.decompressobj(wbits=31)) if file.endswith(".gz") else None
    if unpacker is None:
        yield from (bytes(content[i:i + BYTES_AT_ONCE]) for i in range(0, len(content), BYTES_AT_ONCE))
        return
    rest = bytes(content)
    while rest:                             # a file may have several streams
        one = unpacker()
        piece = one.decompress(rest, BYTES_AT_ONCE)
        while piece or not one.eof:
            yield piece
            if one.eof:
                break
            left = one.unconsumed_tail if unpacker is not bz2.BZ2Decompressor else b""
            piece = one.decompress(left, BYTES_AT_ONCE)
            if not piece and not one.eof and (not left if unpacker is not bz2.BZ2Decompressor else one.needs_input):
                raise EOFError(f"{file} ends within its compressed data")
        rest = one.unused_data


def whole_files(kind: type[_Reader]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(file, content) → ``SCANNED``: files that are one range each."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, file in enumerate(batch.column("file").to_pylist()):
                reader, rest = kind(file, 0), b""
                for piece in _plain(memoryview(batch.column("content")[i].as_buffer()), file):
                    rest += piece
                    cut = rest.rfind(b">") + 1
                    reader.feed(rest[:cut])
                    rest = rest[cut:]
                    yield from reader.take()
                if rest:
                    reader.feed(rest + b">")        # as the last piece of a range
                reader.finish()
                yield from reader.take()

    return scan


JOINED = "file string, row bigint, cols array<int>, texts array<string>, wide array<int>, tall array<int>, moved bigint, began boolean"


def joiner(columns: Callable[[list], dict]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(file, row, parts) → ``JOINED``: the row that the parts, in order, make up."""
    names = ["file", "row", "cols", "texts", "wide", "tall", "moved", "began"]
    types = pa.schema([_TYPES.field(n) for n in names])

    def join_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for one in batch.to_pylist():
                cells, is_open = [], False
                for part in one["parts"]:
                    if part["lead"] is not None and is_open and cells:
                        cells[-1][1] = (cells[-1][1] or b"") + part["lead"]
                    for c in part["cells"]:
                        if c["attributes"] is not None:
                            cells.append([c["attributes"], c["text"]])
                        elif cells:
                            cells[-1][1] = (cells[-1][1] or b"") + c["text"]
                    is_open = is_open if part["open"] is None else part["open"]
                first = next((p for p in one["parts"] if p["began"]), None)
                if cells:
                    out.append({"file": one["file"], "row": one["row"], "began": first is not None, "moved": first and first["moved"], **columns(cells)})
            yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in out], f.type) for f in types], schema=types)

    return join_parts
