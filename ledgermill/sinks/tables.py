"""Stored tables: directory datasets in Parquet or CSV with keyed writes.

* ``append`` and ``incremental`` add files and never rewrite stored ones, unless new data changes a stored type.
* ``upsert`` on a table partitioned by part of its key reads and replaces only the partitions that new data touches
  (Spark's dynamic partition overwrite); any other upsert writes the whole result beside the table and swaps.
* A whole-table write always goes to a sibling folder first and is swapped in by rename, so a failed job leaves the
  old table in place. One writer per table is assumed.

The columns, types and partition columns of the table are kept in ``_schema.json`` inside its folder, so that files
written before a column was added read with nulls, no job is needed to merge file schemas, and later writes keep the
partitioning.

The layout of a CSV table also says how its text is spelled: line breaks escaped, so that a row is a line, and a null told
from any text. Null words apply to files of others only, and to tables from before this rule, which keep their spelling.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions.coerce import to_spark_type
from ledgermill.functions.text import CSV_NULL, clean_text, csv_options, null_words_to_null, spell_text, unspell_text
from ledgermill.hadoop import file_system, is_folder, list_files, list_folders, path_exists, read_text, write_text
from ledgermill.names import col, require_columns
from ledgermill.operators.merge import (
    align,
    check_keys_present,
    check_mode,
    kept_rows,
    new_rows,
    profile_new_keys,
)
from ledgermill.scratch import scratch_scope, write_scratch
from ledgermill.sources.records import text_columns

FORMATS = ("parquet", "csv")
_SCHEMA_FILE = "_schema.json"


def _old_path(path: str) -> str:
    return path.rstrip("/") + ".__old"


def _live_path(spark: SparkSession, path: str) -> str:
    """Where the table can be read now: during a swap, or after one that was cut off, that is the set-aside folder."""
    return path if path_exists(spark, path) or not path_exists(spark, _old_path(path)) else _old_path(path)


def recover(spark: SparkSession, path: str) -> None:
    """Finish or undo a swap that was cut off: when only the set-aside table is there, put it back.

    Only the table's writer may call this; readers use whichever folder is there.
    """
    fs, target, make = file_system(spark, path)
    old = make(_old_path(path))
    if fs.exists(old):
        if fs.exists(target):
            fs.delete(old, True)
        else:
            fs.rename(old, target)


def _swap_in(spark: SparkSession, staged: str, path: str) -> None:
    fs, target, make = file_system(spark, path)
    old = make(_old_path(path))
    parent = target.getParent()
    if parent is not None:
        fs.mkdirs(parent)
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"Could not set {path} aside")
    if fs.exists(target) or not fs.rename(make(staged), target):
        if fs.exists(old) and not fs.exists(target):
            fs.rename(old, target)
        raise OSError(f"Could not move the staged table to {path}")
    if fs.exists(old):
        fs.delete(old, True)


def is_stored(spark: SparkSession, path: str) -> bool:
    """True for a folder that holds the layout of a stored table."""
    return path_exists(spark, f"{path.rstrip('/')}/{_SCHEMA_FILE}")


def _read_layout(spark: SparkSession, path: str) -> tuple[T.StructType | None, list[str], bool]:
    """Column types and partition columns the table was written with, and whether its CSV text is spelled out. Folders
    written by others tell only their partition columns, by their names."""
    text = read_text(spark, f"{path.rstrip('/')}/{_SCHEMA_FILE}")
    if text is not None:
        layout = json.loads(text)
        return T.StructType.fromJson(layout["schema"]), layout["partition_by"], "csv_null" in layout
    columns, folder = [], path
    while True:
        inner = [f for f in list_folders(spark, folder) if "=" in f.rsplit("/", 1)[-1]]
        if not inner:
            return None, columns, False
        folder = inner[0]
        columns.append(folder.rsplit("/", 1)[-1].split("=", 1)[0])


def _write_layout(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str], spelled: bool = False
) -> None:
    layout = {"schema": schema.jsonValue(), "partition_by": list(partition_by)}
    if spelled:
        layout["csv_null"] = CSV_NULL
    write_text(spark, f"{path.rstrip('/')}/{_SCHEMA_FILE}", json.dumps(layout))


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when the folder (or file) is there and holds a table, be it an empty one."""
    path = _live_path(spark, path)
    if not path_exists(spark, path):
        return False
    if not is_folder(spark, path) or is_stored(spark, path):
        return True
    names = [f.rsplit("/", 1)[-1] for f in [*list_files(spark, path), *list_folders(spark, path)]]
    return any(not n.startswith(("_", ".")) for n in names)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a stored table. CSV columns come back with the types they were written with."""
    if fmt not in FORMATS:
        raise NotImplementedError(f"Unsupported table format {fmt!r}; choose from {FORMATS}")
    path = _live_path(spark, path)
    schema, _, spelled = _read_layout(spark, path)
    if fmt == "parquet":
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    if schema is None:
        return clean_text(text_columns(spark, path))
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    options = csv_options() | ({"nullValue": CSV_NULL} if spelled else {})
    frame = spark.read.options(**options).schema(text).csv(path)

    def typed(f: T.StructField):
        c = col(f.name)
        if spelled and isinstance(f.dataType, T.StringType):
            return unspell_text(c).alias(f.name)
        return to_spark_type(null_words_to_null(c), T.StringType(), f.dataType).alias(f.name)

    return frame.select(*[typed(f) for f in schema.fields])


def existing_or_empty(spark: SparkSession, path: str, fmt: str, incoming: T.StructType) -> DataFrame:
    """The stored table, or an empty frame with the incoming columns when there is none."""
    if table_exists(spark, path):
        return read_table(spark, path, fmt)
    return spark.createDataFrame([], incoming)


def _writable(df: DataFrame, fmt: str, spelled: bool) -> DataFrame:
    """CSV has no types of its own; timestamps are written so that they read back exactly, and text on one line."""
    if fmt != "csv":
        return df
    out = []
    for f in df.schema.fields:
        c = col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif spelled and isinstance(f.dataType, T.StringType):
            c = spell_text(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def _write_files(
    df: DataFrame,
    path: str,
    mode: str,
    fmt: str,
    partition_by: Sequence[str],
    compression: str | None,
    dynamic: bool = False,
    spelled: bool = True,
) -> None:
    if partition_by:
        # even out file sizes: small partitions share a task, a hot one is split over several
        df = df.hint("rebalance", *[col(c) for c in partition_by])
    writer = _writable(df, fmt, spelled).write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "parquet":
        writer.parquet(path)
    else:
        writer.options(**csv_options(), **({"nullValue": CSV_NULL} if spelled else {})).csv(path)


def _stored_order(df: DataFrame, partition_by: Sequence[str]) -> T.StructType:
    """Schema as files hold it: partition columns last."""
    rest = [f for f in df.schema.fields if f.name not in partition_by]
    return T.StructType(rest + [df.schema[c] for c in partition_by])


def replace_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), compression: str | None = None
) -> None:
    """Write the whole table beside the target and swap it in."""
    spark = df.sparkSession
    recover(spark, path)
    staged = f"{path.rstrip('/')}.__new-{uuid.uuid4().hex}"
    _write_files(df, staged, "errorifexists", fmt, partition_by, compression)
    _write_layout(spark, staged, _stored_order(df, partition_by), partition_by, spelled=fmt == "csv")
    _swap_in(spark, staged, path)


def _touched(existing: DataFrame, new: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Stored rows in the partitions that new data touches. The partitions are named in the scan filter, several columns as
    one text, so the scan lists and reads only those folders. The driver's own list of folders is no shorter."""

    def place(c: str) -> Column:
        return col(c).cast(existing.schema[c].dataType).alias(c)

    one = partition_by[0] if len(partition_by) == 1 else None
    where = place(one) if one else F.to_json(F.struct(*[place(c) for c in partition_by]))
    names = [r[0] for r in new.select(where).distinct().collect()]
    known = [F.lit(n) for n in names if n is not None]
    test = where.isin(known) if known else F.lit(False)
    return existing.filter(test | where.isNull() if len(known) < len(names) else test)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    keys: Sequence[str] = (),
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    compression: str | None = None,
    evolve: bool = False,
    stage: bool = True,
) -> None:
    """Write ``df`` into the table at ``path``.

    Modes: ``overwrite``; ``append`` (all rows added); ``incremental`` (rows with a new key added); ``upsert`` (rows
    with a stored key replace it; new data that repeats a key is refused). A missing table is simply created; one without
    rows keeps its columns and partitioning, and the same is refused as for one with rows.
    A keyed write reads new data several times, so it is first written to the shared scratch folder; that also gives the
    planner its true size, on which it decides whether to broadcast the keys. Pass ``stage=False`` when ``df`` already
    reads a stored table.
    """
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported table format {fmt!r}; choose from {FORMATS}")
    mode = check_mode(mode, keys)
    partition_by = list(partition_by)
    if partition_by and fmt == "csv":
        raise ValueError("Partition columns need the parquet format")
    require_columns(df, partition_by, "the frame to write")
    with scratch_scope(df.sparkSession):
        _write(df, path, mode, list(keys), fmt, partition_by, compression, evolve, stage)


def _write(
    df: DataFrame,
    path: str,
    mode: str,
    keys: list[str],
    fmt: str,
    partition_by: list[str],
    compression: str | None,
    evolve: bool,
    stage: bool,
) -> None:
    spark = df.sparkSession
    recover(spark, path)
    if mode == "overwrite" or not table_exists(spark, path):
        return replace_table(df, path, fmt, partition_by, compression)
    existing = read_table(spark, path, fmt)
    _, stored_partitions, spelled = _read_layout(spark, path)
    if partition_by and partition_by != stored_partitions:
        raise ValueError(f"The table is partitioned by {stored_partitions}, not {partition_by}; overwrite it to change that")
    partition_by = stored_partitions
    check_keys_present(existing.columns, df.columns, keys, evolve)
    if existing.isEmpty():
        _, new = align(existing, df, evolve)
        if mode == "upsert":
            profile_new_keys(new, keys, mode)
        return replace_table(new, path, fmt, partition_by, compression)
    if stage and mode in ("incremental", "upsert"):
        df = write_scratch(df, "delta")
    old, new = align(existing, df, evolve)
    same_types = all(old.schema[c].dataType == existing.schema[c].dataType for c in existing.columns)
    order = _stored_order(new, partition_by)
    old, new = old.select(*[col(c) for c in order.names]), new.select(*[col(c) for c in order.names])
    by_part_of_key = bool(partition_by) and set(partition_by) <= set(keys)

    repeated, has_null = profile_new_keys(new, keys, mode) if mode in ("incremental", "upsert") else (False, False)

    if mode in ("append", "incremental"):
        added = new
        if mode == "incremental":
            near = _touched(old, new, partition_by) if by_part_of_key else old
            added = new_rows(near, new, keys, repeated, has_null)
        # CSV is positional, so a changed column order cannot be appended either
        appendable = same_types and (fmt == "parquet" or order.names[: len(existing.columns)] == existing.columns)
        if not appendable:
            return replace_table(old.unionByName(added), path, fmt, partition_by, compression)
        # inserted rows are found by reading the files listed above, which an append leaves alone; the layout changes
        # once the files are there
        _write_files(added, path, "append", fmt, partition_by, compression, spelled=spelled)
        return _write_layout(spark, path, order, partition_by, spelled)

    if by_part_of_key and same_types:
        result = kept_rows(_touched(old, new, partition_by), new, keys, has_null).unionByName(new)
        _write_files(result, path, "overwrite", fmt, partition_by, compression, dynamic=True)
        return _write_layout(spark, path, order, partition_by)
    return replace_table(
        kept_rows(old, new, keys, has_null).unionByName(new), path, fmt, partition_by, compression
    )


def write_tables(tables: dict[str, tuple[DataFrame, Sequence[str], str | None]], mode: str, **options) -> dict[str, str]:
    """Write several named tables ``{name: (frame, keys, path)}`` of one job.

    When any frame is empty nothing is written at all. A table without a path is skipped. Returns what happened per
    table: ``written``, ``no path`` or ``aborted``.
    """
    if any(frame.isEmpty() for frame, _, _ in tables.values()):
        return dict.fromkeys(tables, "aborted")
    done = {}
    for name, (frame, keys, path) in tables.items():
        if not path:
            done[name] = "no path"
            continue
        write_table(frame, path, mode, keys, **options)
        done[name] = "written"
    return done


# The name of a snapshot, followed by its time.
SNAPSHOT_NAME = "cache_dataprep_"
SNAPSHOT_TIME = "%Y%m%d%H%M%S"


def snapshot(df: DataFrame, cache_dir: str, stamp: str | None = None) -> str:
    """Write a timestamped CSV snapshot of the frame into ``cache_dir`` and return its path. It is a stored table:
    :func:`read_table` gives back the same rows and types."""
    stamp = stamp or dt.datetime.now().strftime(SNAPSHOT_TIME)
    path = f"{cache_dir.rstrip('/')}/{SNAPSHOT_NAME}{stamp}"
    _write_files(df, path, "overwrite", "csv", (), None)
    _write_layout(df.sparkSession, path, df.schema, (), spelled=True)
    return path
