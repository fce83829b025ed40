"""Spreadsheets and Word files as Spark data sources (SRC-06, SRC-16, SNK-22).

``workbook`` reads a file or a folder of .xlsx files, one partition a file and
sheet, and writes a table as a folder of them. Each task writes its rows to a file of
its own, sheet by sheet as long as a sheet may be; files get their names when
the whole job is committed, and none stays if it fails. ``paragraphs`` reads
.docx files, one partition a file: (file, n, text), a table's row as one line with
its cells parted by tabs.

Options of ``workbook``: sheet (only those with this name; when writing, the name), header
(the number of header rows, 1 by default). Cells go by their place. Rows are read and written one by
one, so a sheet need not fit in memory. Paths lie in a folder that all executors
share. Values: strings, whole numbers, numbers, booleans; a cell that is no value
of its column's type is null, an empty string is read as null.
"""

from __future__ import annotations

import os
import re
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructType

#: Rows that a sheet may have.
MOST_ROWS = 1_048_576
# Names of the formats.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_TYPES = '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{}</Types>'
_SHEET_TYPE = '<Override PartName="/xl/worksheets/sheet{}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
_RELATIONS = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{}</Relationships>'
_RELATION = '<Relationship Id="rId{0}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/{1}" Target="{2}"/>'
_UNPRINTABLE = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")


def local(path: str) -> str:
    return re.sub("^file:/*", "/", path).rstrip("/")


def files(path: str, suffix: str) -> list[str]:
    """The files of a folder, or the file itself; hidden and unfinished ones are none."""
    if os.path.isfile(path):
        return [path]
    return sorted(os.path.join(path, f) for f in os.listdir(path) if f.endswith(suffix) and f[0] not in "._~")


@dataclass
class Sheet(InputPartition):
    file: str
    part: str


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int


def _sheets(file: str) -> list[tuple[str, str]]:
    """(name, part) of a workbook's sheets, in order."""
    with zipfile.ZipFile(file) as z:
        targets = {r.get("Id"): r.get("Target", "") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
    found = [(s.get("name", ""), targets[s.get(f"{_LINK}id")]) for s in book.iter(f"{_MAIN}sheet")]
    return [(name, t.lstrip("/") if t.startswith("/") else f"xl/{t}") for name, t in found]


def _column(place: str) -> int:
    """The number of a cell's column, from 0, by its letters."""
    n = 0
    for c in place:
        if c.isdigit():
            break
        n = n * 26 + ord(c) - 64
    return n - 1


def cells(file: str, part: str) -> Iterator[list[str | None]]:
    """A sheet's rows as texts, one by one; cells that are missing are null."""
    with zipfile.ZipFile(file) as z:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            for _, e in ElementTree.iterparse(z.open("xl/sharedStrings.xml")):
                if e.tag == f"{_MAIN}si":
                    shared.append("".join(t.text or "" for t in e.iter(f"{_MAIN}t")))
                    e.clear()
        for _, e in ElementTree.iterparse(z.open(part)):
            if e.tag != f"{_MAIN}row":
                continue
            row: list[str | None] = []
            for i, c in enumerate(e.iter(f"{_MAIN}c")):
                at = _column(c.get("r")) if c.get("r") else i
                row += [None] * (at + 1 - len(row))
                value, kind = c.find(f"{_MAIN}v"), c.get("t")
                if kind == "inlineStr":
                    row[at] = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                elif value is not None and value.text is not None:
                    row[at] = shared[int(value.text)] if kind == "s" else value.text
            yield row
            e.clear()


def _typed(text: str | None, kind: object) -> object:
    if text is None or text == "":
        return None
    try:
        if isinstance(kind, LongType):
            return int(text) if re.fullmatch(r"[+-]?\d+", text.strip()) else int(v) if (v := float(text)).is_integer() else None
        if isinstance(kind, DoubleType):
            return float(text)
    except (ValueError, OverflowError):
        return None
    if isinstance(kind, BooleanType):
        return {"1": True, "0": False, "true": True, "false": False}.get(text.lower())
    return text


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.path, self.sheet, self.header = schema, local(options["path"]), options.get("sheet"), int(options.get("header", 1))

    def partitions(self) -> Sequence[InputPartition]:
        return [Sheet(f, part) for f in files(self.path, ".xlsx") for name, part in _sheets(f) if self.sheet in (None, name)] or [Sheet("", "")]

    def read(self, partition: Sheet) -> Iterator[tuple]:
        kinds = [f.dataType for f in self.schema.fields]
        for i, row in enumerate(cells(partition.file, partition.part) if partition.file else ()):
            if i >= self.header:
                row += [None] * (len(kinds) - len(row))
                yield tuple(_typed(x, k) for x, k in zip(row, kinds, strict=False))


def _cell(value: object) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f"<c><v>{value!r}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(_UNPRINTABLE.sub("", str(value)))}</t></is></c>'


def _row(values: Sequence[object]) -> bytes:
    return f"<row>{''.join(map(_cell, values))}</row>".encode()


class _Writer(DataSourceWriter):
    def __init__(self, schema: StructType, options: dict, overwrite: bool):
        self.names, self.path, self.sheet, self.overwrite = schema.names, local(options["path"]), options.get("sheet", "Sheet"), overwrite
        self.header, self.job, self.most = int(options.get("header", 1)), uuid.uuid4().hex, int(options.get("rows", MOST_ROWS))

    def _place(self, name: str) -> str:
        return os.path.join(self.path, "_unfinished", self.job, name)

    def write(self, iterator: Iterator[Row]) -> Written:
        first = next(iterator, None)
        if first is None:
            return Written(None, 0)
        os.makedirs(self._place(""), exist_ok=True)
        name, rows, sheets = f"{uuid.uuid4().hex}.xlsx", 0, 0
        left: Row | None = first
        with zipfile.ZipFile(self._place(name), "w", zipfile.ZIP_DEFLATED) as z:
            while left is not None:
                sheets += 1
                with z.open(f"xl/worksheets/sheet{sheets}.xml", "w", force_zip64=True) as out:
                    out.write(f'<worksheet xmlns="{_MAIN[1:-1]}"><sheetData>'.encode())
                    for _ in range(self.header):
                        out.write(_row(self.names))
                    for _ in range(self.most - self.header):
                        out.write(_row(tuple(left)))
                        rows, left = rows + 1, next(iterator, None)
                        if left is None:
                            break
                    out.write(b"</sheetData></worksheet>")
            title = lambda i: escape(self.sheet if sheets == 1 else f"{self.sheet} {i}", {'"': "&quot;"})
            of = range(1, sheets + 1)
            z.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{_LINK[1:-1]}"><sheets>{"".join(f'<sheet name="{title(i)}" sheetId="{i}" r:id="rId{i}"/>' for i in of)}</sheets></workbook>')
            z.writestr("xl/_rels/workbook.xml.rels", _RELATIONS.format("".join(_RELATION.format(i, "worksheet", f"worksheets/sheet{i}.xml") for i in of)))
            z.writestr("_rels/.rels", _RELATIONS.format(_RELATION.format(1, "officeDocument", "xl/workbook.xml")))
            z.writestr("[Content_Types].xml", _TYPES.format("".join(map(_SHEET_TYPE.format, of))))
        return Written(name, rows)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        os.makedirs(self.path, exist_ok=True)
        if self.overwrite:
            for old in files(self.path, ".xlsx"):
                os.remove(old)
        for i, m in enumerate(m for m in messages if m is not None and m.file):
            os.replace(self._place(m.file), os.path.join(self.path, f"part-{i:05d}-{self.job}.xlsx"))
        self.abort(messages)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        place = self._place("")
        if os.path.isdir(place):
            for f in os.listdir(place):
                os.remove(os.path.join(place, f))
            os.removedirs(place)


class Workbook(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> StructType:
        """Columns by the first sheet's last header row, all strings."""
        file = files(local(self.options["path"]), ".xlsx")[0]
        part = next(p for n, p in _sheets(file) if self.options.get("sheet") in (None, n))
        header = int(self.options.get("header", 1))
        last: list[str | None] = []
        for i, row in enumerate(cells(file, part)):
            if i >= max(header, 1):
                break
            last = row
        out = StructType()
        for i, c in enumerate(last):
            out.add(c if header and c else f"_c{i}", StringType())
        return out

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, dict(self.options) | {k: self.options.get(k) for k in ("path", "sheet") if self.options.get(k)})

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(schema, dict(self.options), overwrite)


class _Paragraphs(DataSourceReader):
    def __init__(self, path: str):
        self.path = local(path)

    def partitions(self) -> Sequence[InputPartition]:
        return [Sheet(f, "word/document.xml") for f in files(self.path, ".docx")] or [Sheet("", "")]

    def read(self, partition: Sheet) -> Iterator[tuple]:
        if not partition.file:
            return
        text = lambda e: "".join("\t" if x.tag == f"{_WORD}tab" else "\n" if x.tag == f"{_WORD}br" else x.text or "" for x in e.iter() if x.tag in (f"{_WORD}t", f"{_WORD}tab", f"{_WORD}br"))
        n, depth = 0, 0
        with zipfile.ZipFile(partition.file) as z:
            for event, e in ElementTree.iterparse(z.open(partition.part), ("start", "end")):
                if e.tag == f"{_WORD}tr":
                    depth += 1 if event == "start" else -1
                if event == "end" and depth == 0 and e.tag in (f"{_WORD}p", f"{_WORD}tr"):
                    line = "\t".join(text(c) for c in e.iter(f"{_WORD}tc")) if e.tag == f"{_WORD}tr" else text(e)
                    yield os.path.basename(partition.file), n, line
                    n += 1
                    e.clear()


class Paragraphs(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paragraphs"

    def schema(self) -> str:
        return "file string, n int, text string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Paragraphs(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make both known to the session by their names."""
    for source in (Workbook, Paragraphs):
        spark.dataSource.register(source)
