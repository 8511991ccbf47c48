"""Spreadsheets (.xlsx) as rows, with the standard library: a workbook a task, a row a spreadsheet row.

Only values are read: shared and inline strings, numbers, booleans, results of
formulas. Numbers are told as text, whole ones without a point.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ALIASES, WIDE
from .listings import batch_columns, canonical

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
#: Cells that a header row has one of, in lower case; rows that are looked at for it.
HEADER_MARKS, HEADER_ROWS = ("id", "index", "#", "doctor name"), 4


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{MAIN}t"))


def _number(value: str) -> str:
    try:
        n = float(value)
    except ValueError:
        return value
    return str(int(n)) if n == int(n) and abs(n) < 1e15 else repr(n)


def cells_of(content: bytes, sheet: int = 1) -> Iterator[tuple[int, list[str | None]]]:
    """Row number and cells of one sheet, in order; nothing of a file that isn't a workbook."""
    try:
        book = zipfile.ZipFile(io.BytesIO(content))
        names = set(book.namelist())
        shared = [_text(si) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{MAIN}si")] if "xl/sharedStrings.xml" in names else []
        tree = ElementTree.fromstring(book.read(f"xl/worksheets/sheet{sheet}.xml"))
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return
    for nth, row in enumerate(tree.iter(f"{MAIN}row"), 1):
        out: list[str | None] = []
        for cell in row.iter(f"{MAIN}c"):
            at = len(out)
            letters = re.match("[A-Z]+", cell.get("r", ""))
            if letters:
                at = 0
                for ch in letters.group():
                    at = at * 26 + ord(ch) - 64
                at -= 1
            value, kind = cell.find(f"{MAIN}v"), cell.get("t")
            told = None
            if kind == "inlineStr":
                told = _text(cell)
            elif value is not None and value.text is not None:
                told = shared[int(value.text)] if kind == "s" else value.text if kind in ("str", "e") else {"0": "FALSE", "1": "TRUE"}.get(value.text, value.text) if kind == "b" else _number(value.text)
            out += [None] * (at + 1 - len(out))
            out[at] = told
        yield int(row.get("r", nth)), out


def read_workbook(spark: SparkSession, path: str, sheet: int = 1) -> DataFrame:
    """``file, row, cells`` below a header row, ``cells`` by header in lower case; ``row`` counts the sheet's rows.

    The header is the first of the first rows that has a cell like "ID",
    "Index", "#" or "Doctor Name"; of headers that come twice the first counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.map_(pa.string(), pa.string())
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                heads, rows, cells = None, [], []
                for n, own in cells_of(content.as_py(), sheet):
                    low = [(c or "").strip().lower() for c in own]
                    if heads is None:
                        if n <= HEADER_ROWS and any(c in HEADER_MARKS for c in low):
                            heads = low
                        continue
                    told: dict[str, str] = {}
                    for h, c in zip(heads, own):
                        if h and c is not None and h not in told:
                            told[h] = c
                    rows.append(n)
                    cells.append(list(told.items()))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), pa.array(rows, pa.int64()), pa.array(cells, kind)], names=["file", "row", "cells"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInArrow(run, "file string, row long, cells map<string,string>")


def read_practice_book(spark: SparkSession, path: str) -> DataFrame:
    """A practice listing as ``listings.canonical`` gives it, with ``file`` and ``row``."""
    rows = read_workbook(spark, path)
    heads = {a.lower(): a for names in ALIASES.values() for a in names}
    own = rows.select("file", "row", *[F.col("cells")[low].alias(a) for low, a in heads.items()])
    return canonical(own, keep=("file", "row"))


def read_batch_book(spark: SparkSession, path: str) -> DataFrame:
    """A batch table (the wide headers) as typed rows, with ``file`` and ``pos`` (the sheet's row)."""
    rows = read_workbook(spark, path)
    have = {name: F.coalesce(F.col("cells")[header.lower()], F.col("cells")[name]) for header, name, _, _ in WIDE}
    return rows.select(*batch_columns(have), "file", F.col("row").alias("pos")).filter("idx IS NOT NULL")
