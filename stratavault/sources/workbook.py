"""Workbook source: first sheet of ``.xlsx`` files as rows of text cells, one task per file.

The decoder streams the sheet XML, so a task holds the shared texts and one chunk of rows, not the sheet.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_SCHEMA = "path string, row_no int, cells array<string>"
INSPECTION_SCHEMA = "path string, merged boolean, sheets array<string>"
CHUNK_ROWS = 5_000

# Fixed values of the file format: built-in date formats and the two day-zero conventions.
DATE_FORMAT_IDS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
DAY_ZERO, DAY_ZERO_1904 = datetime(1899, 12, 30), datetime(1904, 1, 1)


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _elements(book: zipfile.ZipFile, member: str, wanted: set[str]) -> Iterator[ElementTree.Element]:
    """Finished elements with one of the wanted local names, freed after use."""
    if member not in book.namelist():
        return
    with book.open(member) as stream:
        for _, element in ElementTree.iterparse(stream):
            if _local(element.tag) in wanted:
                yield element
                element.clear()


def _texts(element: ElementTree.Element) -> str:
    """Text of a rich or plain string, without phonetic hints."""
    found = []
    for child in element:
        if _local(child.tag) == "t":
            found.append(child.text or "")
        elif _local(child.tag) == "r":
            found.append(_texts(child))
    return "".join(found)


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(name, member) of the sheets in workbook order."""
    targets = {}
    for rel in _elements(book, "xl/_rels/workbook.xml.rels", {"Relationship"}):
        target = rel.get("Target", "")
        targets[rel.get("Id")] = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    found = []
    for sheet in _elements(book, "xl/workbook.xml", {"sheet"}):
        rel_id = next((v for k, v in sheet.attrib.items() if _local(k) == "id"), None)
        found.append((sheet.get("name", ""), targets.get(rel_id, "")))
    return found


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Indexes of the cell styles that show dates or times."""
    custom, styles = {}, set()
    if "xl/styles.xml" not in book.namelist():
        return styles
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    for element in root.iter():
        name = _local(element.tag)
        if name == "numFmt":
            code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", element.get("formatCode", ""))
            custom[int(element.get("numFmtId", 0))] = bool(re.search("[ymdhsYMDHS]", code))
    for block in root:
        if _local(block.tag) == "cellXfs":
            for index, xf in enumerate(block):
                fmt = int(xf.get("numFmtId", 0))
                if fmt in DATE_FORMAT_IDS or custom.get(fmt, False):
                    styles.add(index)
    return styles


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match("[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - 64
    return index - 1


def _number(text: str) -> str:
    value = float(text)
    return str(int(value)) if value.is_integer() and abs(value) < 1e15 else repr(value)


def sheet_rows(content: bytes) -> Iterator[tuple[int, list[str | None]]]:
    """(row number, cells) of the first sheet; numbers and dates in plain text form."""
    book = zipfile.ZipFile(io.BytesIO(content))
    shared = [_texts(si) for si in _elements(book, "xl/sharedStrings.xml", {"si"})]
    dates = _date_styles(book)
    zero = DAY_ZERO
    for setting in _elements(book, "xl/workbook.xml", {"workbookPr"}):
        zero = DAY_ZERO_1904 if setting.get("date1904") in ("1", "true") else DAY_ZERO

    def text_of(cell: ElementTree.Element) -> str | None:
        kind = cell.get("t", "n")
        parts = {_local(child.tag): child for child in cell}
        if kind == "inlineStr":
            return _texts(parts["is"]) if "is" in parts else None
        raw = parts["v"].text if "v" in parts else None
        if raw is None or kind == "e":
            return None
        if kind == "s":
            return shared[int(raw)]
        if kind == "b":
            return "True" if raw == "1" else "False"
        if kind == "n":
            if int(cell.get("s", -1)) in dates:
                moment = zero + timedelta(days=float(raw))
                return (moment + timedelta(microseconds=500_000)).strftime("%Y-%m-%d %H:%M:%S")
            return _number(raw)
        return raw

    number = 0
    member = _sheets(book)[0][1]
    for row in _elements(book, member, {"row"}):
        number = int(row.get("r", number + 1))
        cells: list[str | None] = []
        for position, cell in enumerate(c for c in row if _local(c.tag) == "c"):
            index = _column_index(cell.get("r")) if cell.get("r") else max(position, len(cells))
            cells.extend([None] * (index - len(cells)))
            cells.append(text_of(cell))
        yield number, cells


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            chunk = []
            for number, cells in sheet_rows(content):
                chunk.append((path, number, cells))
                if len(chunk) == CHUNK_ROWS:
                    yield pd.DataFrame(chunk, columns=["path", "row_no", "cells"])
                    chunk = []
            yield pd.DataFrame(chunk, columns=["path", "row_no", "cells"])


def _inspect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for path, content in zip(batch["path"], batch["content"], strict=True):
            book = zipfile.ZipFile(io.BytesIO(content))
            sheets = _sheets(book)
            merged = next(_elements(book, sheets[0][1], {"mergeCell"}), None) is not None
            found.append((path, merged, [name for name, _ in sheets]))
        yield pd.DataFrame(found, columns=["path", "merged", "sheets"])


def _files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(paths).select("path", "content")


def read_rows(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Rows of the first sheet of every file: path, row number, cells as text."""
    return _files(spark, paths).mapInPandas(_decode, ROWS_SCHEMA)


def inspect(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Per file: whether the first sheet has merged cells, and its sheet names."""
    return _files(spark, paths).mapInPandas(_inspect, INSPECTION_SCHEMA)


def header_names(cells: list[str | None]) -> list[str]:
    """Column names of a header row: blanks become ``Unnamed: n``, repeats get a number."""
    names: list[str] = []
    for i, cell in enumerate(cells):
        base, name, again = cell or f"Unnamed: {i}", cell or f"Unnamed: {i}", 0
        while name in names:
            again += 1
            name = f"{base}.{again}"
        names.append(name)
    return names


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """One workbook as an all-text table; the first row names the columns."""
    rows = read_rows(spark, path).where("row_no >= 1")
    first = rows.where("row_no = 1").first()
    if first is None:
        raise ValueError(f"no header row in {path}")
    names = header_names(list(first["cells"]))
    return rows.where("row_no > 1").select(*[F.get("cells", i).alias(n) for i, n in enumerate(names)])
