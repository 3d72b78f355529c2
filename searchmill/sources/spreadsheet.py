"""Spreadsheet scan: every .xlsx file of a folder, decoded in parallel by file.

Spark distributes the files; decoding one file is plain Python because Spark has no
spreadsheet reader. Rows leave the decoder in Arrow batches while the sheet is being
parsed, so memory holds the compressed file and its shared strings, not the sheet.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterable, Iterator
from itertools import chain
from urllib.parse import unquote
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchmill.functions.headers import HeaderError, parse_header
from searchmill.schemas import METRICS, SHEET_ROW_SCHEMA
from searchmill.sources.discover import PATTERNS
from searchmill.sources.storage import export_name, literal, require_folder

BATCH_ROWS = 2000
CELL_REFERENCE = re.compile(r"([A-Z]+)")

ARROW_DAY = pa.struct([("dt", pa.date32())] + [(m, pa.float64()) for m in METRICS])
ARROW_SHEET_ROW = pa.schema(
    [
        ("source_file", pa.string()),
        ("mtime", pa.timestamp("us", tz="UTC")),
        ("row_no", pa.int64()),
        ("query", pa.string()),
        ("page_path", pa.string()),
        ("days", pa.list_(ARROW_DAY)),
    ]
)


def read_spreadsheets(
    spark: SparkSession, folder: str, names: list[str] | None = None
) -> DataFrame:
    """Sheet rows (SHEET_ROW_SCHEMA) of the first sheet of every .xlsx file in `folder`, or of
    those in `names`."""
    require_folder(spark, folder)
    paths = literal(folder)
    if names is not None:
        paths = [literal(f"{folder.rstrip('/')}/{unquote(name)}") for name in names]
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", PATTERNS["xlsx"])
        .load(paths)
        .where(~F.col("_metadata.file_name").startswith("~$"))
        .select(
            export_name(spark, folder).alias("source_file"),
            F.col("modificationTime").alias("mtime"),
            "content",
        )
    )
    return decode_spreadsheets(files)


def decode_spreadsheets(files: DataFrame) -> DataFrame:
    """Sheet rows of (source_file, mtime, content) rows."""
    return files.mapInArrow(_decode_batches, SHEET_ROW_SCHEMA)


def _decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(name) for name in ("source_file", "mtime", "content")]
        for i in range(batch.num_rows):
            name, mtime, content = (c[i] for c in columns)
            yield from _file_batches(name.as_py(), mtime, content.as_buffer())


def _file_batches(name: str, mtime: pa.Scalar, content) -> Iterator[pa.RecordBatch]:
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        rows = first_sheet_rows(book)
        columns = next(rows, (0, None))[1]
        if columns is None:
            return
        header = parse_header(columns, where=name)
        days = [
            (date, [found[m].position if m in found else None for m in METRICS])
            for date, found in header.days()
        ]
        width = len(columns)
        pending: list[tuple] = []
        for row_no, values in rows:
            if len(values) > width or any(
                v is not None and c is None for c, v in zip(columns, values)
            ):
                raise HeaderError(f"{name}: row {row_no} has a value in a column without a name")
            values += [None] * (width - len(values))
            pending.append((row_no, values))
            if len(pending) == BATCH_ROWS:
                yield _to_batch(name, mtime, header, days, pending)
                pending = []
        if pending:
            yield _to_batch(name, mtime, header, days, pending)


def _to_batch(name, mtime, header, days, rows) -> pa.RecordBatch:
    offsets, dates = [0], []
    metrics: list[list[float | None]] = [[] for _ in METRICS]
    for row_no, values in rows:
        for date, positions in days:
            found = [None if p is None else values[p] for p in positions]
            if found.count(None) == len(found):
                continue
            dates.append(date)
            for target, text in zip(metrics, found):
                try:
                    target.append(None if text is None or text == "" else float(text))
                except ValueError:
                    raise ValueError(f"{name}: row {row_no}, {date}: {text!r} is no number") from None
        offsets.append(len(dates))
    day_values = pa.StructArray.from_arrays(
        [pa.array(dates, pa.date32()), *[pa.array(m, pa.float64()) for m in metrics]],
        fields=list(ARROW_DAY),
    )
    count = len(rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([name] * count, pa.string()),
            pa.array([mtime.as_py()] * count, pa.timestamp("us", tz="UTC")),
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([r[1][header.query] for r in rows], pa.string()),
            pa.array([r[1][header.page_path] for r in rows], pa.string()),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), day_values),
        ],
        schema=ARROW_SHEET_ROW,
    )


def first_sheet_rows(book: zipfile.ZipFile) -> Iterator[tuple[int, list[str | None]]]:
    """(row number, cell texts) of the workbook's first sheet; empty rows are left out."""
    strings = _shared_strings(book)
    with book.open(_first_sheet_part(book)) as part:
        number = 0
        for row in _elements(part, "row"):
            number = int(row.get("r") or number + 1)
            values: list[str | None] = []
            for cell in _children(row, "c"):
                column = _column_index(cell.get("r"), len(values))
                values += [None] * (column + 1 - len(values))
                values[column] = _cell_text(cell, strings)
            if any(v is not None for v in values):
                yield number, values


def _first_sheet_part(book: zipfile.ZipFile) -> str:
    """The first <sheet> names a relation; the relation names the part."""
    with book.open("xl/workbook.xml") as part:
        sheet = next(_elements(part, "sheet"), None)
        if sheet is None:
            raise HeaderError("the workbook has no sheet")
        relation = next(v for k, v in sheet.attrib.items() if k.endswith("}id"))
    with book.open("xl/_rels/workbook.xml.rels") as part:
        for found in _elements(part, "Relationship"):
            if found.get("Id") == relation:
                return posixpath.normpath(posixpath.join("/xl", found.get("Target"))).lstrip("/")
    raise HeaderError(f"the workbook has no part for relation {relation}")


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    with book.open("xl/sharedStrings.xml") as part:
        return [_rich_text(item) for item in _elements(part, "si")]


def _rich_text(item: ElementTree.Element) -> str:
    """Text of a string item: plain, or in formatted runs. Reading aids are not part of it."""
    runs: Iterable = chain.from_iterable(
        [child] if _local(child) == "t" else _children(child, "t")
        for child in item
        if _local(child) in ("t", "r")
    )
    return "".join(t.text or "" for t in runs)


def _cell_text(cell: ElementTree.Element, strings: list[str]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        inline = next(_children(cell, "is"), None)
        return None if inline is None else _rich_text(inline)
    value = next(_children(cell, "v"), None)
    if value is None or value.text is None or kind == "e":
        return None
    return strings[int(value.text)] if kind == "s" else value.text


def _column_index(reference: str | None, following: int) -> int:
    """'C7' -> 2; cells without a reference follow the previous one."""
    if not reference:
        return following
    index = 0
    for letter in CELL_REFERENCE.match(reference)[1]:
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def _elements(part, name: str) -> Iterator[ElementTree.Element]:
    """Finished elements of that name, freed after use."""
    parents: list[ElementTree.Element] = []
    for event, element in ElementTree.iterparse(part, events=("start", "end")):
        if event == "start":
            parents.append(element)
            continue
        parents.pop()
        if _local(element) == name:
            yield element
            element.clear()
            if parents:
                parents[-1].remove(element)


def _children(element: ElementTree.Element, name: str) -> Iterator[ElementTree.Element]:
    return (child for child in element if _local(child) == name)


def _local(element: ElementTree.Element) -> str:
    return element.tag.rsplit("}", 1)[-1]
