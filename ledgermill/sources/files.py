"""Flat-file and table scans."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions.coerce import NUMBER_TEXT, WHOLE_TEXT, enforce_types, to_double, to_long
from ledgermill.functions.text import clean_text
from ledgermill.hadoop import first_lines, is_folder, list_files, path_exists
from ledgermill.names import col
from ledgermill.operators.combine import union_parts
from ledgermill.sinks.tables import is_stored, read_table
from ledgermill.sources.records import has_broken_records, text_columns
from ledgermill.sources.workbooks import scan_workbooks
from ledgermill.spec import TableRef, TableSpec


#: How a text column spells truth values.
TRUTH_TEXT = r"^(true|True|TRUE|false|False|FALSE)$"


def infer_columns(df: DataFrame) -> DataFrame:
    """Text columns whose every present value is a number or a truth value, as such. One pass over the data decides.

    Whole numbers without fractions become 64-bit, other numbers doubles. Meant for files without a spec; give a spec for
    code columns such as ``01301`` and for large scans.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    tests = []
    for i, c in enumerate(texts):
        tests += [
            F.count(col(c)).alias(f"n{i}"),
            F.count_if(col(c).rlike(NUMBER_TEXT)).alias(f"d{i}"),
            F.count_if(col(c).rlike(WHOLE_TEXT)).alias(f"w{i}"),
            F.count_if(col(c).rlike(TRUTH_TEXT)).alias(f"b{i}"),
        ]
    if not tests:
        return df
    seen = df.agg(*tests).first()
    typed = {}
    for i, c in enumerate(texts):
        n = seen[f"n{i}"]
        if n and seen[f"w{i}"] == n:
            typed[c] = to_long(col(c), T.StringType())
        elif n and seen[f"d{i}"] == n:
            typed[c] = to_double(col(c), T.StringType())
        elif n and seen[f"b{i}"] == n:
            typed[c] = col(c).try_cast("boolean")
    return df.select(*[typed.get(c, col(c)).alias(c) for c in df.columns])


def scan_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    spec: TableSpec | None = None,
    sep: str = ",",
    infer: bool = True,
    multiline: bool | None = None,
) -> DataFrame:
    """CSV files with a header. Values are read as text and the null words become null; then the spec's types apply, or
    numbers and truth values are inferred from the data when there is no spec and ``infer`` is set.

    Line breaks inside quotes belong to the value, and files that hold some are split over tasks like any other. By
    default one pass over the files looks for them; ``multiline`` says whether there are any and saves that pass. A stored
    CSV table of this package is read as what was written, without null words and inference.
    """
    if isinstance(paths, str) and is_stored(spark, paths):
        frame, infer = read_table(spark, paths, "csv"), False
    else:
        frame = clean_text(text_columns(spark, paths, sep, multiline))
    if spec is not None:
        known = [c for c in frame.columns if c in spec.types]
        return enforce_types(frame.select(*[col(c) for c in known]), spec)
    return infer_columns(frame) if infer else frame


def _by_header(spark: SparkSession, files: Sequence[str], sep: str) -> list[list[str]]:
    """CSV files grouped by their header line."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, line in zip(files, first_lines(spark, files)):
        groups.setdefault(tuple(next(csv.reader([line], delimiter=sep), ())), []).append(path)
    return list(groups.values())


def load_flat_files(
    spark: SparkSession,
    path: str,
    load_all: bool = False,
    spec: TableSpec | None = None,
    sep: str = ",",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One CSV or workbook, or with ``load_all`` every ``*.csv`` and ``*.xlsx`` directly inside a folder.

    Files with the same header are one scan; differing headers are combined by column name with nulls where a file
    lacks a column. Files with another suffix are skipped. Without a spec, numbers and truth values are
    inferred over the whole result.
    """
    if not path_exists(spark, path):
        raise NotImplementedError(f"No file or folder at {path!r}")
    if is_folder(spark, path):
        if not load_all:
            raise ValueError("A folder is only read with load_all=True")
        files = list_files(spark, path)
    else:
        files = [path]
    csvs = [f for f in files if f.lower().endswith(".csv")]
    books = [f for f in files if f.lower().endswith(".xlsx")]
    if not csvs and not books:
        raise ValueError(f"No .csv or .xlsx file at {path!r}")
    parts: list[DataFrame] = []
    if csvs:
        groups = _by_header(spark, csvs, sep) if len(csvs) > 1 else [csvs]
        multiline = len(sep) == 1 and has_broken_records(spark, csvs, sep)
        parts += [scan_csv(spark, group, sep=sep, infer=False, multiline=multiline) for group in groups]
    if books:
        parts.append(scan_workbooks(spark, books, columns or (spec.source_names if spec else None)))
    frame = union_parts(parts)
    if spec is not None:
        return enforce_types(frame.select(*[col(c) for c in frame.columns if c in spec.types]), spec)
    return infer_columns(frame)


def scan_table(spark: SparkSession, ref: TableRef, warehouse: str | None = None) -> DataFrame:
    """A base or joined table: a ready frame, a catalog table, or a path in CSV or Parquet (by ``fmt`` or suffix).

    Declared types are enforced when the reference carries a spec.
    """
    if ref.frame is not None:
        frame = ref.frame
    elif ref.table is not None:
        frame = spark.table(ref.table)
    elif ref.path is not None:
        path = f"{(warehouse or '').rstrip('/')}/{ref.db}/{ref.path}" if ref.db else ref.path
        fmt = ref.fmt or path.rstrip("/").rpartition(".")[2]
        if fmt not in ("csv", "parquet"):
            raise NotImplementedError(f"Cannot tell the format of {path!r}; give fmt='csv' or fmt='parquet'")
        if fmt == "parquet" or is_stored(spark, path):
            frame = read_table(spark, path, fmt)
        else:
            frame = scan_csv(spark, path, infer=ref.spec is None)
    else:
        raise ValueError("Give a frame, a table name or a path")
    return enforce_types(frame, ref.spec) if ref.spec is not None else frame


def local_table(spark: SparkSession, columns: dict[str, list[str]]) -> DataFrame:
    """A small text table from driver values whose size the planner knows, so that joins with it are broadcast."""
    return spark.createDataFrame(pa.table({name: pa.array(values, pa.string()) for name, values in columns.items()}))


def code_list(
    spark: SparkSession, codes: Iterable[str] | None = None, path: str | None = None, name: str = "code"
) -> DataFrame:
    """Code dimension from an inline list or from a text file with one code per line (``- "13010"`` also reads)."""
    if codes is not None:
        return local_table(spark, {name: sorted({str(c) for c in codes})})
    if path is None:
        raise ValueError("Give codes or a path")
    line = F.regexp_extract("value", r"""^\s*(?:-\s+)?["']?([^"'#\s]+)["']?\s*(?:#.*)?$""", 1)
    return spark.read.text(path).select(line.alias(name)).filter(f"`{name}` <> '' and `{name}` <> '-'").distinct()
