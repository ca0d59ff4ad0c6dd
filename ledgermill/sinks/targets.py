"""Writes to what a :class:`ledgermill.spec.TargetSpec` names: a folder or a catalogue table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgermill.sinks.catalogue import catalogue_rows, write_catalogue_table
from ledgermill.sinks.tables import read_table, write_table
from ledgermill.spec import TargetSpec


def write_target(df: DataFrame, target: TargetSpec, keys: Sequence[str], partition_by: Sequence[str] = (), stage: bool = True) -> None:
    if target.table is not None:
        if target.compression:
            raise ValueError("A catalogue table has its own compression; set it in the table's properties")
        return write_catalogue_table(
            df, target.table, target.mode, keys, partition_by, target.evolve, target.fmt, target.path, stage
        )
    if target.path is None:
        raise ValueError("A target needs a path or a table")
    write_table(
        df, target.path, target.mode, keys, target.fmt, partition_by, target.compression, target.evolve, stage
    )


def read_target(spark: SparkSession, target: TargetSpec) -> DataFrame:
    """The stored table of a target."""
    if target.table is not None:
        return catalogue_rows(spark, target.table)
    return read_table(spark, target.path, target.fmt)
