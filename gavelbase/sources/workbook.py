"""Workbooks (.xlsx) as a data source, and as a sink, with the standard library only.

``spark.read.format("workbook")`` gives a row per data row: the columns of the header, all strings, and ``_row``, its
number. One partition reads one workbook; cells are read as a stream. Options: ``path`` (a file or a folder), ``sheet``
(number from 1), ``header`` (false gives _c0, _c1, ...), ``columns`` (names joined by ``|``: only their cells are read),
``start`` and ``limit`` (data rows passed over and taken; 0 sets no limit; reading ends with the last row wanted).
"""

from __future__ import annotations

import glob
import io
import itertools
import os
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape, unescape

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

from gavelbase.operators.conform import unique_headers

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def _column(ref: str) -> int:
    n = 0
    for c in ref:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def _shared(z: zipfile.ZipFile) -> list[str]:
    out: list[str] = []
    if "xl/sharedStrings.xml" in z.namelist():
        for _, e in ElementTree.iterparse(z.open("xl/sharedStrings.xml")):
            if e.tag == _NS + "si":
                out.append("".join(t.text or "" for t in e.iter(_NS + "t")))
                e.clear()
    return out


def _sheets(z: zipfile.ZipFile) -> list[str]:
    return sorted((n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n.rsplit("/", 1)[1]).group()))


def _open(content: bytes | str) -> zipfile.ZipFile:
    return zipfile.ZipFile(io.BytesIO(content) if isinstance(content, bytes) else content)


def read_cells(content: bytes | str, sheet: int = 1, columns: set[int] | None = None) -> Iterator[list[str]]:
    """The rows of a sheet as text; missing cells are empty, numbers lose a tail of zeros. columns: places of the cells that are wanted, others come out empty."""
    with _open(content) as z:
        sheets = _sheets(z)
        if sheet <= len(sheets):
            yield from _rows(z, sheets[sheet - 1], _shared(z), columns)


def read_sheets(content: bytes | str) -> Iterator[Iterator[list[str]]]:
    """The rows of each sheet in order; the file is opened once."""
    with _open(content) as z:
        shared = _shared(z)
        for name in _sheets(z):
            yield _rows(z, name, shared, None)


def _rows(z: zipfile.ZipFile, name: str, shared: list[str], columns: set[int] | None) -> Iterator[list[str]]:
    expected = 1
    for _, e in ElementTree.iterparse(z.open(name)):
        if e.tag != _NS + "row":
            continue
        at = int(e.get("r") or expected)
        for _ in range(expected, at):
            yield []
        row: list[str] = []
        for k, c in enumerate(e.iter(_NS + "c")):
            col = _column(c.get("r") or "") if c.get("r") else k
            if columns is not None and col not in columns:
                continue
            row.extend([""] * (col - len(row)))
            kind, v = c.get("t"), c.find(_NS + "v")
            text = v.text if v is not None and v.text else ""
            if kind == "s" and text:
                text = shared[int(text)]
            elif kind == "inlineStr":
                text = "".join(t.text or "" for t in c.iter(_NS + "t"))
            elif kind in (None, "n"):
                text = re.sub(r"\.0+$", "", text)
            row.append(text)
        expected = at + 1
        e.clear()
        yield row


def write_cells(rows: list[list], path: str) -> None:
    """A workbook of one sheet, written beside its place and then moved there."""
    write_sheets({"data": rows}, path)


def _sheet_rows(rows) -> Iterator[str]:
    for k, row in enumerate(rows, 1):
        cells = "".join(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f]", "", "" if v is None else str(v)))}</t></is></c>' for v in row)
        yield f'<row r="{k}">{cells}</row>'


def sheet_names(content: bytes | str) -> list[str]:
    """The sheets' names in order."""
    with _open(content) as z:
        return [unescape(n) for n in re.findall(r'<sheet [^>]*?name="([^"]*)"', z.read("xl/workbook.xml").decode("utf-8"))] if "xl/workbook.xml" in z.namelist() else []


def write_sheets(sheets: dict[str, list[list]], path: str, mode: str = "overwrite") -> None:
    """A workbook of several sheets, rows written as a stream. mode: "overwrite" makes a new workbook, "replace" puts the sheets in the place of those of their names and keeps others, "overlay" writes rows below those of a sheet of that name."""
    old = dict(zip(sheet_names(path), ([list(r) for r in rows] for rows in read_sheets(path)))) if mode != "overwrite" and os.path.exists(path) else {}
    if mode == "overlay":
        sheets = {n: old.get(n, []) + rows for n, rows in sheets.items()}
    sheets = {**old, **sheets}
    kinds = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    each = lambda f: "".join(f(k, n) for k, n in enumerate(sheets, 1))
    quoted = lambda n: escape(n, {'"': "&quot;"})
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kinds}.sheet.main+xml"/>' + each(lambda k, n: f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="{kinds}.worksheet+xml"/>') + "</Types>",
        "_rels/.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{_NS[1:-1]}" xmlns:r="{office}"><sheets>' + each(lambda k, n: f'<sheet name="{quoted(n)}" sheetId="{k}" r:id="r{k}"/>') + "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}/relationships">' + each(lambda k, n: f'<Relationship Id="r{k}" Type="{office}/worksheet" Target="worksheets/sheet{k}.xml"/>') + "</Relationships>",
    }
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    with zipfile.ZipFile(path + ".tmp", "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, head + text)
        for k, rows in enumerate(sheets.values(), 1):
            with z.open(f"xl/worksheets/sheet{k}.xml", "w") as f:
                f.write((head + f'<worksheet xmlns="{_NS[1:-1]}"><sheetData>').encode())
                for row in _sheet_rows(rows):
                    f.write(row.encode("utf-8"))
                f.write(b"</sheetData></worksheet>")
    os.replace(path + ".tmp", path)


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.options = schema, options

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in files(self.options["path"])]

    def read(self, partition: _File) -> Iterator[tuple]:
        o = self.options
        width, header, sheet = len(self.schema) - 1, o.get("header", "true").lower() == "true", int(o.get("sheet", "1"))
        start, limit, wanted = int(o.get("start", "0")), int(o.get("limit", "0")), None
        if o.get("columns"):
            place = {n: k for k, n in enumerate(_header(partition.path, sheet, header))}
            wanted = [place.get(n, -1) for n in self.schema.names[:-1]]
        for k, row in enumerate(read_cells(partition.path, sheet, set(wanted) if wanted else None)):
            n = k - header  # number of the data row from 0
            if n < start:
                continue
            if limit and n >= start + limit:
                return
            cells = [row[c] if 0 <= c < len(row) else "" for c in wanted] if wanted else (row + [""] * width)[:width]
            yield (*cells, k)


def _header(path: str, sheet: int, header: bool) -> list[str]:
    first = next(read_cells(path, sheet), [])
    return unique_headers(first) if header else [f"_c{k}" for k in range(len(first))]


def files(path: str) -> list[str]:
    path = path.removeprefix("file://")
    return sorted(glob.glob(os.path.join(path, "*.xlsx"))) if os.path.isdir(path) else sorted(glob.glob(path))


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> StructType:
        found = files(self.options["path"])
        names = _header(found[0], int(self.options.get("sheet", "1")), self.options.get("header", "true").lower() == "true") if found else []
        if self.options.get("columns"):
            names = [n for n in self.options["columns"].split("|") if n in names]
        return StructType([*(StructField(n, StringType()) for n in names), StructField("_row", LongType())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, dict(self.options))


def write_workbook(df: DataFrame, path: str, most_rows: int = 1_048_575) -> None:
    """A report as one workbook; a sheet holds ``most_rows`` rows, and a larger result is refused. Rows come to the driver partition by partition and are written as a stream."""
    if df.limit(most_rows + 1).count() > most_rows:
        raise ValueError(f"more than {most_rows} rows: write Parquet or CSV instead")
    write_sheets({"data": itertools.chain([df.columns], map(list, df.toLocalIterator()))}, path)
