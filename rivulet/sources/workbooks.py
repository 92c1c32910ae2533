"""Cells of spreadsheets and CSV files in a folder, read where Spark puts the files.

A file is one row of Spark's binary files, so any store will do, and files are parsed by as many tasks as there are. A workbook (a zip of
XML, ECMA-376) is read cell by cell, its shared texts first; what is kept is one file's bytes and texts.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
#: Cells in a batch.
BATCH = 50_000
Cell = tuple[int, int, str]


def _shared(book: zipfile.ZipFile) -> list[str]:
    """The workbook's shared texts."""
    out: list[str] = []
    if "xl/sharedStrings.xml" in book.namelist():
        with book.open("xl/sharedStrings.xml") as part:
            for _, e in ElementTree.iterparse(part):
                if e.tag == f"{_MAIN}si":
                    out.append("".join(t.text or "" for t in e.iter(f"{_MAIN}t")))
                    e.clear()
    return out


def xlsx_cells(data: bytes) -> Iterator[Cell]:
    """(row, column, text) of the cells of a workbook's first sheet that hold something; rows are numbered as they come."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        texts = _shared(book)
        first = min((n for n in book.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[0]))
        row = at = 0
        with book.open(first) as part:
            for _, e in ElementTree.iterparse(part):
                if e.tag == f"{_MAIN}c":
                    letters = re.match("[A-Z]+", e.get("r", ""))
                    at = reduce(lambda n, x: n * 26 + ord(x) - 64, letters[0], 0) - 1 if letters else at
                    value = e.findtext(f"{_MAIN}v")
                    if e.get("t") == "s" and value is not None:
                        value = texts[int(value)]
                    elif e.get("t") == "inlineStr":
                        value = "".join(t.text or "" for t in e.iter(f"{_MAIN}t"))
                    if value:
                        yield row, at, value
                    at += 1
                elif e.tag == f"{_MAIN}row":
                    row, at = row + 1, 0
                    e.clear()


def csv_cells(data: bytes) -> Iterator[Cell]:
    for row, values in enumerate(csv.reader(io.StringIO(data.decode("utf-8-sig")))):
        yield from ((row, at, v) for at, v in enumerate(values) if v)


def cells(spark: SparkSession, folder: str) -> DataFrame:
    """filename, row, col, value of the .xlsx and .csv files in a folder and those below it. A file that can't be read raises."""
    import pyarrow as pa

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).where(F.lower("path").rlike(r"\.(xlsx|csv)$"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column("path"), b.column("content")):
                name, some = path.as_py(), []

                def made(name: str = name) -> pa.RecordBatch:
                    cols = list(zip(*some)) or [(), (), ()]
                    out = [pa.array([name] * len(some), pa.string()), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string())]
                    some.clear()  # noqa: B023
                    return pa.RecordBatch.from_arrays(out, ["filename", "row", "col", "value"])

                for cell in (csv_cells if name.lower().endswith(".csv") else xlsx_cells)(content.as_py()):
                    some.append(cell)
                    if len(some) >= BATCH:
                        yield made()
                yield made()

    return files.select("path", "content").mapInArrow(run, "filename string, row long, col int, value string")


def xlsx(rows: Iterable[Sequence[object]]) -> bytes:
    """A workbook of one sheet: numbers as numbers, all else as shared texts, None as no cell."""
    texts: dict[str, int] = {}

    def cell(at: int, value: object) -> str:
        name, n = "", at
        while n >= 0:
            name, n = chr(65 + n % 26) + name, n // 26 - 1
        if isinstance(value, (int, float)):
            return f'<c r="{name}{{row}}"><v>{value}</v></c>'
        return f'<c r="{name}{{row}}" t="s"><v>{texts.setdefault(str(value), len(texts))}</v></c>'

    lines = ["".join(cell(i, v) for i, v in enumerate(r) if v is not None).replace("{row}", str(k)) for k, r in enumerate(rows, 1)]
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    kind = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    parts = {
        "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
        + "".join(f'<Override PartName="/xl/{n}" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.{t}+xml"/>' for n, t in (("workbook.xml", "sheet.main"), ("worksheets/sheet1.xml", "worksheet"), ("sharedStrings.xml", "sharedStrings"))) + "</Types>",
        "_rels/.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{kind}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook {main} xmlns:r="{kind}"><sheets><sheet name="Sheet1" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{kind}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Type="{kind}/sharedStrings" Target="sharedStrings.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f"<worksheet {main}><sheetData>" + "".join(f'<row r="{k}">{x}</row>' for k, x in enumerate(lines, 1)) + "</sheetData></worksheet>",
        "xl/sharedStrings.xml": f"<sst {main}>" + "".join(f'<si><t xml:space="preserve">{escape(t)}</t></si>' for t in texts) + "</sst>",
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, text)
    return out.getvalue()
