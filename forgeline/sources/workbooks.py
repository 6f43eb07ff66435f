"""Spreadsheet workbooks (.xlsx), many in parallel.

Each workbook is one row of a binary scan; a task unpacks the workbooks it gets and emits
their cells, with the kind that the cell and its style say: a day number shown as a date is a date. A sheet has at most 1,048,576 rows by its format, which bounds what one task
holds, and rows leave it in batches.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import materialize
from .files import scan_files

# The XML namespaces of the workbook format.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_BATCH = 5_000
# The built-in number formats that show a number as a date or time.
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}

CELLS = "path string, row_no bigint, cells array<string>"
#: Kinds a cell can have, and what a column of several kinds becomes: the first type that all fit.
KINDS = ("boolean", "integer", "number", "date", "timestamp", "text")
TYPES = (
    ("boolean", {"boolean"}),
    ("bigint", {"integer"}),
    ("double", {"integer", "number"}),
    ("date", {"date"}),
    ("timestamp_ntz", {"date", "timestamp"}),
)


def _column_index(reference: str) -> int:
    """``C7`` is column 2."""
    index = 0
    for letter in re.match(r"[A-Z]+", reference)[0]:
        index = index * 26 + ord(letter) - 64
    return index - 1


def _sheet_member(book: zipfile.ZipFile, sheet: str | None) -> str | None:
    workbook = ElementTree.fromstring(book.read("xl/workbook.xml"))
    targets = {
        rel.get("Id"): rel.get("Target")
        for rel in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    }
    for entry in workbook.iter(f"{_MAIN}sheet"):
        if sheet is None or entry.get("name") == sheet:
            target = targets[entry.get(_RELATION)]
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    return None


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in item.iter(f"{_MAIN}t")) for item in root.iter(f"{_MAIN}si")]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """The cell styles whose number format shows a date or time."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): f.get("formatCode") or "" for f in root.iter(f"{_MAIN}numFmt")}

    def shows_date(number: int) -> bool:
        # Text in quotes and brackets and escaped letters of a format say nothing about the number.
        code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", own.get(number, ""))
        return number in _DATE_FORMATS or re.search(r"[dmyhs]", code, re.IGNORECASE) is not None

    styles = root.find(f"{_MAIN}cellXfs")
    return {k for k, xf in enumerate(styles if styles is not None else []) if shows_date(int(xf.get("numFmtId") or 0))}


def _since_1904(book: zipfile.ZipFile) -> bool:
    found = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{_MAIN}workbookPr")
    return found is not None and found.get("date1904") in ("1", "true")


def _from_serial(serial: float, since_1904: bool) -> tuple[str, str]:
    """A day number as a date, or with its time where it has one. In the older calendar 1900 counts as a
    leap year, so days before March of it are one less."""
    if since_1904:
        start = datetime(1904, 1, 1)
    else:
        start = datetime(1899, 12, 30) if serial >= 60 else datetime(1899, 12, 31)
    moment = start + timedelta(milliseconds=round(serial * 86_400_000))
    if moment.time() == datetime.min.time():
        return "date", moment.date().isoformat()
    return "timestamp", moment.isoformat(sep=" ")


class _Book:
    """What the cells of a workbook need to be understood."""

    def __init__(self, book: zipfile.ZipFile):
        self.shared = _shared_strings(book)
        self.dates = _date_styles(book)
        self.since_1904 = _since_1904(book)

    def cell(self, cell: ElementTree.Element) -> tuple[str, str] | None:
        """Kind and text of a cell; None for an empty one and for an error."""
        how, value = cell.get("t"), cell.findtext(f"{_MAIN}v")
        if how == "inlineStr":
            return "text", "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
        if value is None or how == "e":
            return None
        if how == "s":
            return "text", self.shared[int(value)]
        if how == "b":
            return "boolean", "true" if value.strip() == "1" else "false"
        if how == "d":
            return ("timestamp", value.replace("T", " ")) if "T" in value else ("date", value)
        if how == "str":
            return "text", value
        try:
            number = float(value)
        except ValueError:
            return "text", value
        if int(cell.get("s") or 0) in self.dates:
            try:
                return _from_serial(number, self.since_1904)
            except OverflowError:
                return "number", value
        return ("integer", str(int(number))) if number == int(number) and abs(number) < 2**53 else ("number", value)


def _sheet_rows(content: bytes, sheet: str | None) -> Iterator[tuple[int, list[tuple[str, str] | None]]]:
    """Number and cells of each row. A row or cell that does not say where it is follows the one before."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        member = _sheet_member(book, sheet)
        if member is None:
            return
        known, number = _Book(book), 0
        with book.open(member) as stream:
            for _, row in ElementTree.iterparse(stream):
                if row.tag != f"{_MAIN}row":
                    continue
                number = int(row.get("r") or number + 1)
                cells: list[tuple[str, str] | None] = []
                for cell in row.iter(f"{_MAIN}c"):
                    at = _column_index(cell.get("r")) if cell.get("r") else len(cells)
                    cells.extend([None] * (at + 1 - len(cells)))
                    cells[at] = known.cell(cell)
                yield number, cells
                row.clear()


def _unpacked(workbooks: DataFrame, unpack: Callable[[str, bytes], Iterator[tuple]], schema: str) -> DataFrame:
    """Rows of (path, content) through a function of one workbook. A batch from Spark holds several, up to its
    own bound in bytes; they are opened one at a time and their rows leave in small batches."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = [f.name for f in fields], to_arrow_schema(fields)

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                rows = []
                for row in unpack(path.as_py(), content.as_py()):
                    rows.append(row)
                    if len(rows) == _BATCH:
                        yield out(rows)
                        rows = []
                if rows:
                    yield out(rows)

    fields = T.StructType.fromDDL(schema)
    return workbooks.select("path", "content").mapInArrow(each, fields)


def sheet_rows(
    workbooks: DataFrame, columns: list[str], sheet: str | None = None, header_row: int = 1
) -> DataFrame:
    """The data rows of one sheet (the first one by default) of every workbook in
    ``workbooks`` (path, content), as (path, row_no, cells) with the texts of the cells in the order of
    ``columns``, found by their names in the header row. A column the header lacks is NULL
    and a workbook without the sheet gives no rows."""

    def unpack(path: str, content: bytes) -> Iterator[tuple]:
        places: list[int] = []
        for row_no, cells in _sheet_rows(content, sheet):
            texts = [cell and cell[1] for cell in cells]
            if row_no <= header_row:
                places = [texts.index(c) if c in texts else -1 for c in columns]
                continue
            yield path, row_no, [texts[at] if 0 <= at < len(texts) else None for at in places]

    return _unpacked(workbooks, unpack, CELLS)


def sheet_cells(workbooks: DataFrame, sheet: str | None = None, header_row: int = 1) -> DataFrame:
    """The data rows of one sheet of every workbook as (path, row_no, names, kinds, texts): its cells that hold
    something, by the names in the header row. Of columns with one name the first counts."""

    def unpack(path: str, content: bytes) -> Iterator[tuple]:
        header: dict[int, str] = {}
        for row_no, cells in _sheet_rows(content, sheet):
            if row_no <= header_row:
                header = {}
                for at, cell in enumerate(cells):
                    if cell and cell[1] and cell[1] not in header.values():
                        header[at] = cell[1]
                continue
            found = [(header[at], *cell) for at, cell in enumerate(cells) if cell and at in header]
            names, kinds, texts = (list(x) for x in zip(*found)) if found else ([], [], [])
            yield path, row_no, names, kinds, texts

    return _unpacked(workbooks, unpack, "path string, row_no bigint, names array<string>, kinds array<string>, texts array<string>")


def inferred_schema(cells: DataFrame) -> T.StructType:
    """The columns of all workbooks together in the order of their names, each of the narrowest type that
    fits every cell in it. The kinds are merged by an aggregation; the driver gets one row per column."""
    each = cells.select(F.explode(F.arrays_zip("names", "kinds")).alias("c"))
    kinds = each.groupBy("c.names").agg(F.collect_set("c.kinds").alias("kinds")).orderBy("names").collect()
    ddl = {r["names"]: next((t for t, fit in TYPES if set(r["kinds"]) <= fit), "string") for r in kinds}
    return T.StructType([T.StructField(name, T._parse_datatype_string(kind)) for name, kind in ddl.items()])


def typed_sheet(cells: DataFrame, schema: T.StructType) -> DataFrame:
    """`sheet_cells` as a table; a cell that does not fit its type is NULL."""
    row = F.map_from_arrays("names", "texts")
    return cells.withColumn("_row", row).select(
        *[F.try_element_at("_row", F.lit(f.name)).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def project_sheet(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Cells to typed columns. A cell that does not fit its type is NULL; a sheet without
    data rows is an empty table of the schema."""
    return rows.select(
        *[F.get("cells", F.lit(at)).try_cast(f.dataType).alias(f.name) for at, f in enumerate(schema.fields)]
    )


def scan_workbook(
    spark: SparkSession, path: str, schema: T.StructType | None = None, sheet: str | None = None
) -> DataFrame:
    """A sheet of every workbook below a path as one table. Without a schema the types are inferred over
    all workbooks, which are unpacked once and stored."""
    books = scan_files(spark, path, "*.xlsx")
    if schema is not None:
        return project_sheet(sheet_rows(books, schema.fieldNames(), sheet), schema)
    return inferred_sheet(books, sheet)


def inferred_sheet(books: DataFrame, sheet: str | None = None) -> DataFrame:
    """`scan_workbook` without a schema, over rows of (path, content)."""
    cells = materialize(sheet_cells(books, sheet), "sheet-cells")
    return typed_sheet(cells, inferred_schema(cells))
