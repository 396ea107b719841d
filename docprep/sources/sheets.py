"""Spreadsheets without a library: the cells of an .xlsx file, read by workers and written for small reports."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docprep.sources.files import list_files

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _column(reference: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]*", reference).group():
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_rows(data: bytes, sheet: str | None = None) -> list[list[str | None]]:
    """The rows of a sheet, the first if none is named; an empty cell is null. A file that isn't a workbook raises ValueError."""
    try:
        book = zipfile.ZipFile(io.BytesIO(data))
        names = [(s.get("name"), s.get(f"{_REL}id")) for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")]
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        target = next(targets[i] for n, i in names if sheet is None or n == sheet)
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
        rows = ElementTree.fromstring(book.read("xl/" + target.removeprefix("/xl/"))).iter(f"{_MAIN}row")
        out: list[list[str | None]] = []
        for row in rows:
            at = int(row.get("r", len(out) + 1))
            out += [[] for _ in range(at - len(out))]
            for cell in row.iter(f"{_MAIN}c"):
                column = _column(cell.get("r", "")) if cell.get("r") else len(out[-1])
                value = cell.find(f"{_MAIN}v")
                kind = cell.get("t")
                text = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t")) if kind == "inlineStr" else value.text if value is not None else None
                if kind == "s" and text is not None:
                    text = shared[int(text)]
                out[-1] += [None] * (column + 1 - len(out[-1]))
                out[-1][column] = text or None
        return out
    except (zipfile.BadZipFile, KeyError, StopIteration, ElementTree.ParseError, IndexError) as e:
        raise ValueError(f"not a readable workbook: {e}") from e


def read_sheets(spark: SparkSession, path: str, sheet: str | None = None, prefix: str = "") -> DataFrame:
    """(path, name, row_no, cells map<string,string>) of every .xlsx file under the path whose name begins with the prefix.

    The first row names the columns; an unnamed column is named by its number, as is one of a name already taken.
    A file that can't be read has no rows. Empty cells are null.
    """
    files = list_files(spark, path, "*.xlsx", content=True).where(F.col("name").startswith(prefix)).select("path", "name", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, name, content in zip(*(c.to_pylist() for c in batch.columns)):
                try:
                    header, *rows = sheet_rows(content, sheet) or [[]]
                except ValueError:
                    continue
                width = max(map(len, [header, *rows]))
                titles: list[str] = []
                for i in range(width):
                    t = header[i] if i < len(header) else None
                    titles.append(t if t and t not in titles else f"column_{i + 1}")
                cells = [list(zip(titles, [*r, *[None] * (width - len(r))])) for r in rows]
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at] * n, pa.string()), pa.array([name] * n, pa.string()), pa.array(range(1, n + 1), pa.int32()), pa.array(cells, pa.map_(pa.string(), pa.string()))], names=["path", "name", "row_no", "cells"]
                )

    return files.mapInArrow(run, "path string, name string, row_no int, cells map<string,string>")


def _reference(column: int) -> str:
    out = ""
    column += 1
    while column:
        column, rest = divmod(column - 1, 26)
        out = chr(65 + rest) + out
    return out


def workbook(header: list[str], rows: list[list[object]]) -> bytes:
    """An .xlsx file of one sheet; lists print in brackets, nulls are empty cells, nothing is cut off."""
    lines = []
    for i, row in enumerate([header, *rows], 1):
        cells = "".join(f'<c r="{_reference(j)}{i}" t="inlineStr"><is><t xml:space="preserve">{escape(re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f]", "", str(v)))}</t></is></c>' for j, v in enumerate(row) if v is not None)
        lines.append(f'<row r="{i}">{cells}</row>')
    main, rel = _MAIN.strip("{}"), _REL.strip("{}")
    parts = {
        "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>' + text)
    return out.getvalue()


def _cell(value: object) -> object:
    """A value as pandas hands it over: arrays as lists, NaN as null."""
    if getattr(value, "ndim", 0):
        return value.tolist()
    return None if value is None or value != value else value


def workbooks(rows: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """(key, content): a workbook for each key, its rows in order; for sheets that people review, each within a task's memory."""
    kept = rows.select(key, *dict.fromkeys([*order, *columns]))
    schema = kept.select(key).schema

    def build(pdf):
        ordered = pdf.sort_values(order, kind="stable")
        body = [[_cell(v) for v in r] for r in ordered[columns].itertuples(index=False)]
        return type(pdf)({key: [pdf[key].iloc[0]], "content": [workbook(columns, body)]})

    return kept.groupBy(key).applyInPandas(build, schema.add("content", "binary"))
