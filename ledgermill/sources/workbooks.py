"""Workbooks (xlsx): the first sheet of many files as rows of text."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions.text import null_words_to_null
from ledgermill.sources.batches import RowBuffer, named_contents

# XML names, built-in date formats and quoted parts of a number format.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_DATE_FORMATS = {"14", "15", "16", "17", "18", "19", "20", "21", "22", "45", "46", "47"}
_QUOTED = re.compile(r'"[^"]*"|\[[^\]]*\]|\\.')
_BOOK_ROW = pa.schema(
    [("path", pa.string()), ("row_index", pa.int64()), ("cells", pa.map_(pa.string(), pa.string()))]
)


def _column_number(reference: str) -> int:
    n = 0
    for ch in reference:
        if not ch.isalpha():
            break
        n = n * 26 + ord(ch.upper()) - ord("A") + 1
    return n - 1


def _xml(book, name: str):
    from xml.etree import ElementTree

    return ElementTree.fromstring(book.read(name)) if name in book.namelist() else None


def _first_sheet(book) -> str:
    """Part name of the sheet that comes first in the workbook."""
    listing, links = _xml(book, "xl/workbook.xml"), _xml(book, "xl/_rels/workbook.xml.rels")
    if listing is not None and links is not None:
        sheet = next(listing.iter(_MAIN + "sheet"), None)
        wanted = None if sheet is None else sheet.get(_LINK + "id")
        for link in links:
            if link.get("Id") == wanted:
                target = link.get("Target").lstrip("/")
                return target if target.startswith("xl/") else "xl/" + target
    return min(n for n in book.namelist() if n.startswith("xl/worksheets/sheet") and n.endswith(".xml"))


def _date_styles(book) -> set[str]:
    """Cell style numbers that show a number as a date or time."""
    styles = _xml(book, "xl/styles.xml")
    if styles is None:
        return set()
    custom = {
        f.get("numFmtId")
        for f in styles.iter(_MAIN + "numFmt")
        if any(ch in _QUOTED.sub("", f.get("formatCode") or "").lower() for ch in "ymdhs")
    }
    formats = next(styles.iter(_MAIN + "cellXfs"), ())
    return {
        str(i) for i, f in enumerate(formats) if f.get("numFmtId") in custom or f.get("numFmtId") in _DATE_FORMATS
    }


def _date_text(day_number: str) -> str:
    """ISO text of a stored day number (days since 1899-12-30)."""
    import datetime as dt

    moment = dt.datetime(1899, 12, 30) + dt.timedelta(seconds=round(float(day_number) * 86400))
    return moment.date().isoformat() if moment.time() == dt.time() else moment.isoformat(" ")


def _sheet_rows(content: bytes) -> Iterator[dict[int, str]]:
    """Rows of the first sheet as ``{column number: text}``; cells styled as dates read as ISO text."""
    import io
    import zipfile
    from xml.etree import ElementTree

    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            with book.open("xl/sharedStrings.xml") as f:
                for _, e in ElementTree.iterparse(f):
                    if e.tag == _MAIN + "si":
                        shared.append("".join(t.text or "" for t in e.iter(_MAIN + "t")))
                        e.clear()
        dates = _date_styles(book)
        with book.open(_first_sheet(book)) as f:
            for _, e in ElementTree.iterparse(f):
                if e.tag != _MAIN + "row":
                    continue
                row: dict[int, str] = {}
                for at, cell in enumerate(e.iter(_MAIN + "c")):
                    kind, v = cell.get("t"), cell.find(_MAIN + "v")
                    if kind == "inlineStr":
                        text = "".join(t.text or "" for t in cell.iter(_MAIN + "t"))
                    elif v is None or v.text is None or kind == "e":
                        continue
                    elif kind == "s":
                        text = shared[int(v.text)]
                    elif kind == "b":
                        text = "True" if v.text == "1" else "False"
                    elif kind in (None, "n") and cell.get("s") in dates:
                        text = _date_text(v.text)
                    else:
                        text = v.text
                    reference = cell.get("r")
                    row[_column_number(reference) if reference else at] = text
                e.clear()
                yield row


def workbook_rows(books: DataFrame) -> DataFrame:
    """Rows ``(path, row_index, cells)`` of a workbook table ``(path, content)``; ``cells`` maps header to text and the
    header row itself is not a row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = RowBuffer(_BOOK_ROW)
        for path, content in named_contents(batches):
            header: dict[int, str] | None = None
            index = 0
            for row in _sheet_rows(content):
                if header is None:
                    header = row
                    continue
                cells = [(header[i], v) for i, v in row.items() if i in header]
                out.add((path, index, cells), sum(len(v) for _, v in cells))
                index += 1
                if out.full():
                    yield from out.take()
        yield from out.take()

    return books.select("path", "content").mapInArrow(read, "path string, row_index bigint, cells map<string,string>")


def workbook_table(books: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """First sheets of a workbook table as text columns, combined by header name.

    Give the wanted columns to keep this lazy; without them one job collects the distinct header names.
    """
    rows = workbook_rows(books)
    if columns is None:
        names = rows.select(F.explode(F.map_keys("cells")).alias("name")).distinct()
        columns = sorted(r["name"] for r in names.collect())
    cell = F.col("cells")
    return rows.select(*[null_words_to_null(F.try_element_at(cell, F.lit(c))).alias(c) for c in columns])


def scan_workbooks(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None, glob: str = "*.xlsx"
) -> DataFrame:
    """First sheets of all workbooks at the paths, see :func:`workbook_table`."""
    return workbook_table(spark.read.format("binaryFile").option("pathGlobFilter", glob).load(paths), columns)
