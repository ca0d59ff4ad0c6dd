"""Keyed writes into tables of Spark's catalogue that are stored in files (parquet, orc, ...).

The rules are those of :mod:`ledgermill.sinks.tables`. Rows that an insert or upsert needs are worked out against the stored
table and staged in the shared scratch folder first, so a table is never read while it is replaced, and a failed job before
that leaves it as it was. An upsert into a table partitioned by part of its key replaces only the partitions that new data
touches. A new column is added to the catalogue entry and no stored file is rewritten for it; only a changed type rewrites
the table. One writer per table is assumed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgermill.names import col, quoted, require_columns
from ledgermill.operators.merge import align, check_keys_present, check_mode, kept_rows, new_rows, profile_new_keys
from ledgermill.scratch import scratch_scope, write_scratch
from ledgermill.sinks.tables import _touched as touched_partitions


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _external_location(spark: SparkSession, table: str) -> str | None:
    """Where an external table keeps its files."""
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return about["Location"] if about.get("Type") == "EXTERNAL" else None


def _create(df: DataFrame, table: str, partition_by: Sequence[str], fmt: str, location: str | None) -> None:
    writer = df.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)


def _insert(df: DataFrame, table: str, overwrite: bool = False, dynamic: bool = False) -> None:
    """Rows by the table's own column order; ``dynamic`` replaces only the partitions that the rows are in.

    An insert by name takes the overwrite mode from the session, so it is set for as long as the insert runs.
    """
    spark, setting = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    order, before = spark.table(table).columns, spark.conf.get(setting)
    spark.conf.set(setting, "dynamic" if dynamic else "static")
    try:
        df.select(*[col(c) for c in order]).write.insertInto(table, overwrite=overwrite)
    finally:
        spark.conf.set(setting, before)


def write_catalogue_table(
    df: DataFrame,
    table: str,
    mode: str = "overwrite",
    keys: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    evolve: bool = False,
    fmt: str = "parquet",
    location: str | None = None,
    stage: bool = True,
) -> None:
    """Write ``df`` into a catalogue table; modes and checks as for :func:`ledgermill.sinks.tables.write_table`.

    A missing table is created (at ``location`` when given, as an external table). Pass ``stage=False`` when ``df`` already
    reads a stored table other than the target.
    """
    mode = check_mode(mode, keys)
    spark, keys, partition_by = df.sparkSession, list(keys), list(partition_by)
    require_columns(df, partition_by, "the frame to write")
    if not spark.catalog.tableExists(table):
        if mode == "upsert":
            profile_new_keys(df, keys, mode)
        return _create(df, table, partition_by, fmt, location)
    stored_partitions = _partition_columns(spark, table)
    with scratch_scope(spark):
        if stage:
            df = write_scratch(df, "delta")
        if mode == "overwrite":
            return _create(df, table, partition_by or stored_partitions, fmt, _external_location(spark, table))
        if partition_by and partition_by != stored_partitions:
            raise ValueError(f"{table} is partitioned by {stored_partitions}, not {partition_by}; overwrite it to change that")
        existing = spark.table(table)
        check_keys_present(existing.columns, df.columns, keys, evolve)
        old, new = align(existing, df, evolve)
        same_types = all(old.schema[c].dataType == existing.schema[c].dataType for c in existing.columns)
        added = [f for f in new.schema.fields if f.name not in existing.columns]
        repeated, has_null = profile_new_keys(new, keys, mode) if mode in ("incremental", "upsert") else (False, False)
        by_part_of_key = bool(stored_partitions) and set(stored_partitions) <= set(keys)
        near = touched_partitions(old, new, stored_partitions) if by_part_of_key else old
        if mode == "incremental":
            new = write_scratch(new_rows(near, new, keys, repeated, has_null), "inserted")
        if not same_types:
            whole = kept_rows(old, new, keys, has_null) if mode == "upsert" else old
            whole = write_scratch(whole.unionByName(new), "rewritten")
            return _create(whole, table, stored_partitions, fmt, _external_location(spark, table))
        if mode == "upsert":
            new = write_scratch(kept_rows(near, new, keys, has_null).unionByName(new), "merged")
        if added:
            columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
        if mode == "upsert" and not by_part_of_key:
            return _insert(new, table, overwrite=True)
        _insert(new, table, overwrite=mode == "upsert", dynamic=mode == "upsert")


def catalogue_rows(spark: SparkSession, table: str) -> DataFrame:
    """The stored table as it is now, whatever an earlier read has cached about its files."""
    spark.catalog.refreshTable(table)
    return spark.table(table)
