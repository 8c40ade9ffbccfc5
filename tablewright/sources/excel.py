"""Excel workbook source (S9): sheet names and the first sheet's rows.

``read.format("binaryFile")`` gives one row per workbook, so every workbook
is parsed by its own task (``mapInPandas``) with the standard library
(xlsx is a zip of XML parts; no spreadsheet package is installed). Cells
come back as text, like the all-text landing tables; the cleaning steps
type them. A small writer builds test workbooks, bounded in rows, in the
session's shared folder.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from itertools import islice
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import write_bytes

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
      "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
      "rel": "http://schemas.openxmlformats.org/package/2006/relationships"}
#: Rows of a sheet that are handed on at a time.
ROWS = 10_000
_REF = re.compile(r"([A-Z]+)(\d+)")


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(el) -> str:
    return "".join(t.text or "" for t in el.iter(f"{{{NS['m']}}}t"))


def sheet_names(data: bytes) -> list[str]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        wb = ET.fromstring(z.read("xl/workbook.xml"))
    return [s.get("name") for s in wb.iterfind("m:sheets/m:sheet", NS)]


def _sheet_part(z: zipfile.ZipFile, index: int) -> str:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    sheet = list(wb.iterfind("m:sheets/m:sheet", NS))[index]
    rid = sheet.get(f"{{{NS['r']}}}id")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    for rel in rels.iterfind("rel:Relationship", NS):
        if rel.get("Id") == rid:
            target = rel.get("Target").lstrip("/")
            return target if target.startswith("xl/") else f"xl/{target}"
    raise KeyError(rid)


def sheet_rows(data: bytes, index: int = 0) -> Iterator[list[str | None]]:
    """Rows of one sheet as lists of cell text (None for empty cells)."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            sst = ET.fromstring(z.read("xl/sharedStrings.xml"))
            shared = [_text(si) for si in sst.iterfind("m:si", NS)]
        with z.open(_sheet_part(z, index)) as f:
            for _, row in ET.iterparse(f):
                if row.tag != f"{{{NS['m']}}}row":
                    continue
                cells: dict[int, str | None] = {}
                for c in row.iterfind("m:c", NS):
                    col = _col_index(_REF.match(c.get("r")).group(1))
                    kind = c.get("t")
                    v = c.find("m:v", NS)
                    if kind == "inlineStr":
                        cells[col] = _text(c.find("m:is", NS))
                    elif v is None:
                        cells[col] = None
                    elif kind == "s":
                        cells[col] = shared[int(v.text)]
                    elif kind == "b":
                        cells[col] = "True" if v.text == "1" else "False"
                    else:
                        cells[col] = v.text
                row.clear()
                width = max(cells) + 1 if cells else 0
                yield [cells.get(i) for i in range(width)]


def _parse(sheet: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                rows = enumerate(sheet_rows(content, sheet))
                while piece := [(path, i, r) for i, r in islice(rows, ROWS)]:
                    yield pd.DataFrame(piece, columns=["path", "row", "cells"])
    return run


def list_sheets(spark: SparkSession, path: str) -> DataFrame:
    """``pd.ExcelFile(f).sheet_names`` for every workbook under ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)

    def run(batches):
        for pdf in batches:
            rows = [(p, i, n) for p, c in zip(pdf["path"], pdf["content"])
                    for i, n in enumerate(sheet_names(c))]
            yield pd.DataFrame(rows, columns=["path", "sheet_index", "sheet_name"])
    return files.select("path", "content").mapInPandas(
        run, "path string, sheet_index int, sheet_name string")


def read_excel(spark: SparkSession, path: str, columns: list[str] | None = None,
               sheet: int = 0) -> DataFrame:
    """``pd.read_excel(f, sheet_name=sheet)`` over many workbooks; all cells as text.

    The first row of each sheet is its header and is dropped; ``columns`` name
    the cells by position (the declared landing schema). Without ``columns``
    the header row of one workbook names them (one small job).
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
    rows = files.select("path", "content").mapInPandas(
        _parse(sheet), "path string, row int, cells array<string>")
    if columns is None:
        header = rows.filter(F.col("row") == 0).select("cells").first()
        columns = list(header["cells"]) if header else []
    body = rows.filter(F.col("row") > 0)
    # Trailing empty cells are not stored, so short rows read as NULL there.
    return body.select(*[F.get("cells", i).alias(c) for i, c in enumerate(columns)])


# ------------------------------------------------------------------ writer

def workbook_bytes(header: list[str], rows: list[list], sheet: str = "Sheet1") -> bytes:
    def cell(ref, value):
        if value is None:
            return ""
        return (f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">'
                f"{escape(str(value))}</t></is></c>")

    def letters(i):
        s = ""
        i += 1
        while i:
            i, r = divmod(i - 1, 26)
            s = chr(65 + r) + s
        return s

    body = []
    for r, values in enumerate([header] + rows, start=1):
        cells = "".join(cell(f"{letters(i)}{r}", v) for i, v in enumerate(values))
        body.append(f'<row r="{r}">{cells}</row>')
    sheet_xml = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                 f'<worksheet xmlns="{NS["m"]}"><sheetData>{"".join(body)}</sheetData></worksheet>')
    parts = {
        "[Content_Types].xml": (
            '<?xml version="1.0" encoding="UTF-8"?>'
            '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
            '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            '<Default Extension="xml" ContentType="application/xml"/>'
            '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
            '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
            '</Types>'),
        "_rels/.rels": (
            '<?xml version="1.0" encoding="UTF-8"?>'
            f'<Relationships xmlns="{NS["rel"]}">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
            '</Relationships>'),
        "xl/workbook.xml": (
            '<?xml version="1.0" encoding="UTF-8"?>'
            f'<workbook xmlns="{NS["m"]}" xmlns:r="{NS["r"]}"><sheets>'
            f'<sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>'),
        "xl/_rels/workbook.xml.rels": (
            '<?xml version="1.0" encoding="UTF-8"?>'
            f'<Relationships xmlns="{NS["rel"]}">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/>'
            '</Relationships>'),
        "xl/worksheets/sheet1.xml": sheet_xml,
    }
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return buf.getvalue()


def write_excel(df: DataFrame, folder: str, rows_per_file: int = 100_000,
                sheet: str = "Sheet1") -> None:
    """Workbooks of at most ``rows_per_file`` rows under ``folder`` (any URI Spark can write).

    Tasks build the workbooks as bytes, one at a time; the driver writes each as it comes
    (one workbook is held, never the table), through Spark's own file systems. The reference only reads
    workbooks; this writer makes inputs for the reader.
    """
    spark = df.sparkSession
    header = df.columns

    def run(batches):
        part = TaskContext.get().partitionId()
        rows, piece = [], 0

        def book():
            return pd.DataFrame({"name": [f"part-{part:05d}-{piece:05d}.xlsx"],
                                 "data": [workbook_bytes(header, rows, sheet)]})

        for pdf in batches:
            pdf = pdf.astype(object).where(pdf.notna(), None)
            for row in pdf.values.tolist():
                rows.append(row)
                if len(rows) == rows_per_file:
                    yield book()
                    rows, piece = [], piece + 1
        if rows:
            yield book()

    for r in df.mapInPandas(run, "name string, data binary").toLocalIterator():
        write_bytes(spark, f"{folder}/{r['name']}", bytes(r["data"]))
