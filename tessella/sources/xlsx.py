"""Workbooks: XLSX files to rows of cells and back, a file at a time inside tasks.

Readers stream a worksheet's rows; writers stream rows, sorted by book and sheet, into a file. So a
task holds a few rows and a workbook's shared strings, never a sheet.
"""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH = 2000
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_ROWS = "path string, sheet string, sheet_index int, _row bigint, cells array<string>"
_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f]")


def _column(ref: str) -> int:
    n = 0
    for c in ref:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def _letters(index: int) -> str:
    out, n = "", index + 1
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def _strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    with book.open("xl/sharedStrings.xml") as f:
        return ["".join(t.text or "" for t in item.iter(f"{_MAIN}t")) for _, item in ET.iterparse(f) if item.tag == f"{_MAIN}si"]


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(name, part) of the sheets; a sheet without a link lies at its number."""
    links = {}
    if "xl/_rels/workbook.xml.rels" in book.namelist():
        links = {r.get("Id"): r.get("Target", "") for r in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    found = []
    for i, s in enumerate(ET.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")):
        target = links.get(s.get(_LINK)) or f"worksheets/sheet{i + 1}.xml"
        found.append((s.get("name", ""), target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
    return found


def _rows(book: zipfile.ZipFile, part: str, strings: list[str]) -> Iterator[tuple[int, list[str]]]:
    at = 0
    with book.open(part) as f:
        for _, row in ET.iterparse(f):
            if row.tag != f"{_MAIN}row":
                continue
            at = int(row.get("r") or at + 1)
            cells: list[str] = []
            for c in row.iter(f"{_MAIN}c"):
                place = _column(c.get("r") or "") if c.get("r") else len(cells)
                cells += [""] * (place + 1 - len(cells))
                value = c.find(f"{_MAIN}v")
                if c.get("t") == "inlineStr":
                    cells[place] = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                elif value is not None and value.text is not None:
                    cells[place] = strings[int(value.text)] if c.get("t") == "s" else value.text
            row.clear()
            yield at, cells


def read_workbooks(files: DataFrame) -> DataFrame:
    """``path, sheet, sheet_index, _row, cells`` of workbooks (``path, content``, as binaryFile gives them).

    Rows that the file leaves out are not there; cells it leaves out are empty.
    """

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                with zipfile.ZipFile(io.BytesIO(content.as_buffer())) as book:
                    strings = _strings(book)
                    for index, (name, part) in enumerate(_sheets(book)):
                        held = []
                        for row in _rows(book, part, strings):
                            held.append(row)
                            if len(held) == BATCH:
                                yield _batch(path, name, index, held)
                                held = []
                        if held:
                            yield _batch(path, name, index, held)

    return files.select("path", "content").mapInArrow(run, _ROWS)


def _batch(path: str, name: str, index: int, rows: list) -> pa.RecordBatch:
    n = len(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array([path] * n), pa.array([name] * n), pa.array([index] * n, pa.int32()), pa.array([r for r, _ in rows], pa.int64()), pa.array([c for _, c in rows], pa.list_(pa.string()))],
        names=["path", "sheet", "sheet_index", "_row", "cells"],
    )


def _escaped(text: str) -> str:
    return _CONTROL.sub("", text).replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


class _Writer:
    """Streams the sheets of one workbook, in order, into a file."""

    HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
    SPACE = "http://schemas.openxmlformats.org"

    def __init__(self, uri: str):
        store, path = pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = store.open_output_stream(path)
        self.book = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.names: list[str] = []
        self.part, self.n = None, 0

    def sheet(self, name: str) -> None:
        self._end()
        clean = re.sub(r"[:\\/?*\[\]]", "_", name)[:31] or "Sheet"
        self.names.append(clean if clean not in self.names else f"{clean[:27]}_{len(self.names) + 1}")
        self.part = self.book.open(f"xl/worksheets/sheet{len(self.names)}.xml", "w")
        self.part.write(f'{self.HEAD}<worksheet xmlns="{self.SPACE}/spreadsheetml/2006/main"><sheetData>'.encode())

    def row(self, number: int, cells: list[str | None]) -> None:
        full = [(i, c) for i, c in enumerate(cells) if c]
        body = "".join(f'<c r="{_letters(i)}{number}" t="inlineStr"><is><t xml:space="preserve">{_escaped(c)}</t></is></c>' for i, c in full)
        self.part.write(f'<row r="{number}">{body}</row>'.encode())
        self.n += 1

    def _end(self) -> None:
        if self.part is not None:
            self.part.write(b"</sheetData></worksheet>")
            self.part.close()

    def close(self) -> int:
        self._end()
        numbers = range(1, len(self.names) + 1)
        office = f"{self.SPACE}/officeDocument/2006/relationships"
        sheets = "".join(f'<sheet name="{_escaped(s)}" sheetId="{i}" r:id="rId{i}"/>' for i, s in zip(numbers, self.names))
        links = "".join(f'<Relationship Id="rId{i}" Type="{office}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in numbers)
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in numbers)
        package = f"{self.SPACE}/package/2006"
        self.book.writestr("xl/workbook.xml", f'{self.HEAD}<workbook xmlns="{self.SPACE}/spreadsheetml/2006/main" xmlns:r="{office}"><sheets>{sheets}</sheets></workbook>')
        self.book.writestr("xl/_rels/workbook.xml.rels", f'{self.HEAD}<Relationships xmlns="{package}/relationships">{links}</Relationships>')
        self.book.writestr("_rels/.rels", f'{self.HEAD}<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        self.book.writestr(
            "[Content_Types].xml",
            f'{self.HEAD}<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            f'<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>{kinds}</Types>',
        )
        self.book.close()
        self.out.close()
        return self.n


def write_workbooks(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``book, sheet, _row, cells`` as one XLSX file a book; the result lists ``book, path, n_rows``.

    Nothing is written before the result is read. Cells are inline strings and empty ones are left
    out. File names are unique to a task attempt: only listed files count. Sheets come in name order.
    """
    dealt = rows.select("book", "sheet", "_row", "cells").repartition("book").sortWithinPartitions("book", "sheet", "_row")

    def run(batches):
        writer, book, sheet = None, None, None
        uri = ""

        def ended():
            n = writer.close()
            return pa.RecordBatch.from_arrays([pa.array([book]), pa.array([uri]), pa.array([n], pa.int64())], names=["book", "path", "n_rows"])

        for batch in batches:
            for b, s, number, cells in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if writer is None or b != book:
                    if writer is not None:
                        yield ended()
                    book, sheet = b, None
                    uri = f"{folder}/{re.sub(r'[^A-Za-z0-9_.-]', '_', b)}-{uuid.uuid4().hex}.xlsx"
                    writer = _Writer(uri)
                if s != sheet:
                    writer.sheet(s)
                    sheet = s
                writer.row(number, cells)
        if writer is not None:
            yield ended()

    return dealt.withColumn("book", F.col("book").cast("string")).mapInArrow(run, "book string, path string, n_rows long")
