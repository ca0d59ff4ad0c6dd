"""Projections: retained columns, renames, constants, ingestion metadata, imputed columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions.scalar import now_whole_seconds
from ledgermill.names import col, require_columns
from ledgermill.spec import TableSpec, spark_type


def retain(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the listed columns in the listed order."""
    require_columns(df, columns)
    return df.select(*[col(c) for c in columns])


def strict_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Keep exactly the declared columns in declared order; a missing one is an error."""
    require_columns(df, spec.source_names, f"the frame for {spec.name!r}")
    return df.select(*[col(c) for c in spec.source_names])


def rename_declared(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Source names to stored names."""
    return df.withColumnsRenamed({c.name: c.rename for c in spec.columns if c.rename})


def project_spec(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Strict projection and renames in one select."""
    require_columns(df, spec.source_names, f"the frame for {spec.name!r}")
    return df.select(*[col(c.name).alias(c.stored_name) for c in spec.columns])


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(v) for name, v in values.items()})


def with_ingestion_metadata(df: DataFrame, source: str | None = None, at: dt.datetime | None = None) -> DataFrame:
    """Add ``ingestion_datetime`` in whole seconds and, when given, ``ingestion_source``.

    Pass ``at`` for a repeatable result; otherwise it is the time the query runs.
    """
    stamp = F.lit(at.replace(microsecond=0)).cast("timestamp") if at else now_whole_seconds()
    added = {"ingestion_datetime": stamp}
    if source is not None:
        added["ingestion_source"] = F.lit(source)
    return df.withColumns(added)


def impute_missing_columns(df: DataFrame, wanted: TableSpec | Mapping[str, str | T.DataType]) -> DataFrame:
    """Add columns the table wants but the data lacks, as typed nulls after the present ones."""
    types = wanted.types if isinstance(wanted, TableSpec) else wanted
    added = {}
    for name, t in types.items():
        if name not in df.columns:
            added[name] = F.lit(None).cast(t if isinstance(t, T.DataType) else spark_type(t))
    return df.withColumns(added) if added else df
