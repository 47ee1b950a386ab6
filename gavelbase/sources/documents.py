"""Texts of landed files and pages: attachments (docx, xlsx, txt, csv, doc, pdf where a reader is installed), HTML to text and tables, JSON with a call wrapper."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelbase.functions.clean import jsonp
from gavelbase.functions.lazy import arrow_udf
from gavelbase.sources.workbook import read_sheets

SUFFIXES = ("pdf", "doc", "docx", "xls", "xlsx", "txt", "csv")


def _decode(content: bytes) -> str:
    for encoding in ("utf-8-sig", "gb18030"):
        try:
            return content.decode(encoding)
        except UnicodeDecodeError:
            pass
    return content.decode("latin-1")


def _docx(content: bytes) -> str:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        xml = z.read("word/document.xml").decode("utf-8", "replace")
    from html import unescape

    return unescape(re.sub(r"<[^>]+>", "", re.sub(r"</w:p>", "\n", xml))).strip()


def _xlsx(content: bytes) -> str:
    """All sheets, blank ones passed over."""
    return "\n".join(" | ".join(c for c in r if c) for rows in read_sheets(content) for r in rows if any(r))


def _pdf(content: bytes) -> str:
    try:
        from pypdf import PdfReader
    except ImportError:
        return ""
    return "\n".join(p.extract_text() or "" for p in PdfReader(io.BytesIO(content)).pages)


#: Runs of text in an old document: what is written in it, not its structure.
_DOC_RUN = re.compile(r"[一-鿿\w，。；：、（）()/.%\s-]*[一-鿿\w][一-鿿\w，。；：、（）()/.%\s-]*")


def _doc(content: bytes) -> str:
    """The readable runs of an old document in the encoding that gives most Han characters; a run of two characters counts."""
    best = max((content.decode(e, "ignore") for e in ("utf-16-le", "utf-8", "gb18030")), key=lambda t: len(re.findall("[一-鿿]", t)))
    return "\n".join(r.strip() for r in _DOC_RUN.findall(best) if len(r.strip()) >= 2)


def attachment_text(name: str, content: bytes) -> str:
    """A file's text by its ending; an unreadable or unknown one gives empty text."""
    readers = {"docx": _docx, "xlsx": _xlsx, "txt": _decode, "csv": _decode, "pdf": _pdf, "doc": _doc}
    reader = readers.get(name.rsplit(".", 1)[-1].lower())
    try:
        return reader(content) if reader else ""
    except Exception:
        return ""


def read_attachments(spark: SparkSession, path: str, most_bytes: int = 50_000_000) -> DataFrame:
    """path, item_id (the folder's name), name, length and text of each file of a known kind, pages in disguise left out. Larger files are listed with null text."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    own = raw.withColumn("name", F.element_at(F.split("path", "/"), -1)).withColumn("item_id", F.element_at(F.split("path", "/"), -2)).where(F.lower(F.element_at(F.split("name", r"\."), -1)).isin(*SUFFIXES))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in frames:
            yield x.drop(columns="content").assign(text=[None if c is None else attachment_text(n, bytes(c)) for n, c in zip(x["name"], x["content"])])

    page = F.lower(F.substring("content", 1, 512).cast("string")).rlike(r"<!doctype html|<html")
    cells = own.where(~F.coalesce(page, F.lit(False))).select("path", "item_id", "name", "length", F.when(F.col("length") <= most_bytes, F.col("content")).alias("content"))
    return cells.mapInPandas(read, "path string, item_id string, name string, length bigint, text string")


class _Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.text, self.rows, self.row, self.cell, self.hidden = [], [], None, None, 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.hidden += 1
        elif tag == "tr":
            self.row = []
        elif tag in ("td", "th"):
            self.cell = []
        elif tag in ("br", "p", "div", "li"):
            (self.text if self.cell is None else self.cell).append("\n")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)
        elif tag in ("td", "th") and self.cell is not None:
            value = re.sub(r"\s+", " ", "".join(self.cell)).strip()
            self.text += [value, " "]
            if self.row is not None:
                self.row.append(value)
            self.cell = None
        elif tag == "tr" and self.row is not None:
            if any(self.row):
                self.rows.append(self.row)
            self.row = None
            self.text.append("\n")
        elif tag in ("p", "div", "li"):
            (self.text if self.cell is None else self.cell).append("\n")

    def handle_data(self, data):
        if not self.hidden:
            (self.text if self.cell is None else self.cell).append(data)


def page_parts(page: str | None) -> tuple[str, list[list[str]]]:
    """Text and table rows of a page; scripts and styles are left out."""
    p = _Page()
    try:
        p.feed(page or "")
        p.close()
    except Exception:
        return "", []
    return "\n".join(s for s in (re.sub(r"[ \t\u00a0]+", " ", x).strip() for x in "".join(p.text).split("\n")) if s), p.rows


@arrow_udf("text string, rows array<array<string>>")
def html_parts(c: pd.Series) -> pd.DataFrame:
    got = [page_parts(x) for x in c]
    return pd.DataFrame({"text": [t for t, _ in got], "rows": [r for _, r in got]})


def json_field(c: Column, *paths: str) -> Column:
    """The first of the paths that the (wrapped) JSON text has."""
    inner = jsonp(c)
    return F.coalesce(*(F.get_json_object(inner, p) for p in paths))
