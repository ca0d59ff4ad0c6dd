"""Landed payloads derived from tables by Spark: JSON envelopes, zip archives, workbooks and filing documents.

These build the inputs of the scan operators out of any table, row by row or in bounded batches, so that the scans can
be checked against the table itself at any size.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def land_envelopes(records: DataFrame, path: str, array: Column, field: str = "data") -> None:
    """One JSON envelope per row and line: the array column under ``field``."""
    records.select(F.to_json(F.struct(array.alias(field))).alias("value")).write.text(path)


def zip_rows(rows: DataFrame, per_archive: int = 200) -> DataFrame:
    """Rows ``(member, content)`` packed into archives ``(path, content)`` of at most ``per_archive`` members."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import uuid
        import zipfile

        for batch in batches:
            for at in range(0, len(batch), per_archive):
                part, held = batch.iloc[at : at + per_archive], io.BytesIO()
                with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
                    for member, content in zip(part["member"], part["content"]):
                        z.writestr(member, content)
                yield pd.DataFrame({"path": [f"{uuid.uuid4().hex}.zip"], "content": [held.getvalue()]})

    return rows.select("member", "content").mapInPandas(pack, "path string, content binary")


def zip_documents(rows: DataFrame) -> DataFrame:
    """Rows ``(path, member, content)`` to one archive ``(path, content)`` each."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import zipfile

        for batch in batches:
            packed = []
            for member, content in zip(batch["member"], batch["content"]):
                held = io.BytesIO()
                with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr(member, content)
                packed.append(held.getvalue())
            yield pd.DataFrame({"path": batch["path"], "content": packed})

    return rows.select("path", "member", "content").mapInPandas(pack, "path string, content binary")


def _cell(reference: str, value: object) -> str:
    from xml.sax.saxutils import escape

    if value is None or value != value:
        return ""
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return f'<c r="{reference}"><v>{value!r}</v></c>'
    return f'<c r="{reference}" t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'


def workbook_bytes(header: Sequence[str], rows: Sequence[Sequence[object]]) -> bytes:
    """A one-sheet workbook."""
    import io
    import zipfile

    def name(i: int) -> str:
        return chr(ord("A") + i) if i < 26 else chr(ord("A") + i // 26 - 1) + chr(ord("A") + i % 26)

    lines = []
    for r, row in enumerate([header, *rows], start=1):
        cells = "".join(_cell(f"{name(i)}{r}", v) for i, v in enumerate(row))
        lines.append(f'<row r="{r}">{cells}</row>')
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(
            "xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>'
        )
    return held.getvalue()


def workbooks(df: DataFrame, per_book: int = 500) -> DataFrame:
    """The rows of a frame as workbooks ``(path, content)`` of at most ``per_book`` rows."""
    names = df.columns

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        for batch in batches:
            for at in range(0, len(batch), per_book):
                rows = [list(r) for r in batch.iloc[at : at + per_book].itertuples(index=False, name=None)]
                yield pd.DataFrame({"path": [f"{uuid.uuid4().hex}.xlsx"], "content": [workbook_bytes(names, rows)]})

    return df.mapInPandas(build, "path string, content binary")


def _xml_text(c: Column) -> Column:
    text = F.replace(c.cast("string"), F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def filing_document(facts: Sequence[tuple[str, str | Column, Column]]) -> Column:
    """One instance document from ``(tag, context id, value)`` facts of a row; a null value gives no fact."""
    parts: list[Column] = [F.lit('<xbrli:xbrl xmlns:xbrli="http://www.xbrl.org/2003/instance" xmlns:f="urn:facts">')]
    for tag, context, value in facts:
        context = context if isinstance(context, Column) else F.lit(context)
        parts.append(
            F.when(
                value.isNotNull(),
                F.concat(F.lit(f'<f:{tag} contextRef="'), context, F.lit('">'), _xml_text(value), F.lit(f"</f:{tag}>")),
            ).otherwise("")
        )
    parts.append(F.lit("</xbrli:xbrl>"))
    return F.concat(*parts)


def metadata_facts(values: Mapping[str, Column]) -> list[tuple[str, str, Column]]:
    """Document metadata facts for :func:`filing_document`."""
    return [(tag, "FilingDateInstant", value) for tag, value in values.items()]


def fact_rows(df: DataFrame, document: Column, facts: Sequence[tuple[Column, Column, Column, Column]]) -> DataFrame:
    """Fact rows from table rows: ``(tag, context id, value, label)`` per fact, numbered in the given order."""
    entries = [
        F.struct(
            F.lit(i).cast("bigint").alias("fact_index"),
            tag.cast("string").alias("local_name"),
            value.cast("string").alias("value"),
            context.cast("string").alias("context_id"),
            F.lit(None).cast("string").alias("unit_id"),
            label.cast("string").alias("label"),
        )
        for i, (tag, context, value, label) in enumerate(facts)
    ]
    return df.select(document.cast("string").alias("source_path"), F.inline(F.array(*entries)))

