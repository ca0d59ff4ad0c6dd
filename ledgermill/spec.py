"""Declarative table and frame specifications.

A :class:`TableSpec` says what a stored table looks like: its columns in order, their logical types, which may be
null, which must be unique, what they are renamed to and which form the key. Everything else in the package takes a
spec (or plain column lists taken from one) and a ``DataFrame``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

# Logical type name -> Spark type. "Decimal(p,s)" is parsed separately.
LOGICAL_TYPES: dict[str, T.DataType] = {
    "Date": T.DateType(),
    "Datetime": T.TimestampType(),
    "Timestamp": T.TimestampType(),
    "String": T.StringType(),
    "Category": T.StringType(),
    "Object": T.StringType(),
    "Int": T.LongType(),
    "Int8": T.ByteType(),
    "Int16": T.ShortType(),
    "Int32": T.IntegerType(),
    "Int64": T.LongType(),
    "Float": T.DoubleType(),
    "Float32": T.FloatType(),
    "Float64": T.DoubleType(),
    "Bool": T.BooleanType(),
    "Decimal": T.DecimalType(38, 10),
}


def spark_type(logical: str) -> T.DataType:
    """Spark type of a logical type name; raises ``ValueError`` for an unknown name."""
    if logical.startswith("Decimal(") and logical.endswith(")"):
        precision, scale = logical[len("Decimal(") : -1].split(",")
        return T.DecimalType(int(precision), int(scale))
    try:
        return LOGICAL_TYPES[logical]
    except KeyError:
        raise ValueError(f"Unknown column type {logical!r}; known: {sorted(LOGICAL_TYPES)}") from None


@dataclass(frozen=True)
class ColumnSpec:
    """One column: its source name, logical type and rules. ``rename`` is the stored name."""

    name: str
    type: str = "String"
    nullable: bool = True
    unique: bool = False
    rename: str | None = None
    primary_key: bool = False
    partition_key: bool = False
    format: str | None = None  # date / timestamp pattern; ISO when absent

    @property
    def stored_name(self) -> str:
        return self.rename or self.name


@dataclass(frozen=True)
class TableSpec:
    """Ordered column specs of one table."""

    columns: tuple[ColumnSpec, ...]
    name: str = "table"

    def __post_init__(self) -> None:
        object.__setattr__(self, "columns", tuple(self.columns))
        for label, names in (("column", self.source_names), ("stored column", self.stored_names)):
            repeated = sorted({n for n in names if names.count(n) > 1})
            if repeated:
                raise ValueError(f"Repeated {label} names in spec {self.name!r}: {repeated}")
        for column in self.columns:
            spark_type(column.type)

    @classmethod
    def from_dict(cls, schema: Mapping[str, Any], name: str = "table") -> TableSpec:
        """Build from ``{"schemas": {column: {type, nullable, unique, new_column, primary_key, partition_key}}}``."""
        columns = []
        for column, rules in schema.get("schemas", schema).items():
            columns.append(
                ColumnSpec(
                    name=column,
                    type=rules["type"],
                    nullable=rules.get("nullable", True),
                    unique=rules.get("unique", False),
                    rename=rules.get("new_column") or None,
                    primary_key=rules.get("primary_key", False),
                    partition_key=rules.get("partition_key", False),
                    format=rules.get("format"),
                )
            )
        return cls(tuple(columns), name)

    @property
    def source_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def stored_names(self) -> list[str]:
        return [c.stored_name for c in self.columns]

    @property
    def primary_keys(self) -> list[str]:
        """Key columns under their stored names."""
        return [c.stored_name for c in self.columns if c.primary_key]

    @property
    def partition_columns(self) -> list[str]:
        """Partition columns under their stored names."""
        return [c.stored_name for c in self.columns if c.partition_key]

    @property
    def types(self) -> dict[str, str]:
        return {c.name: c.type for c in self.columns}

    @property
    def stored_schema(self) -> T.StructType:
        """Spark schema of the validated, renamed table."""
        return T.StructType([T.StructField(c.stored_name, spark_type(c.type), True) for c in self.columns])

    @property
    def text_schema(self) -> T.StructType:
        """All columns as text under source names: the schema for reading landed text files."""
        return T.StructType([T.StructField(c.name, T.StringType(), True) for c in self.columns])


@dataclass(frozen=True)
class TableRef:
    """A table input: a path (format from ``fmt`` or the suffix), a catalog table, or a ready ``DataFrame``."""

    path: str | None = None
    db: str | None = None
    fmt: str | None = None
    table: str | None = None
    frame: Any = None
    spec: TableSpec | None = None


@dataclass(frozen=True)
class JoinSpec:
    """One join step: the other table, the key columns and the join type."""

    source: TableRef
    keys: Sequence[str] | None = None
    how: str = "inner"


@dataclass(frozen=True)
class FillSpec:
    """Null fill of one column: a statistic name for numeric columns, a constant otherwise."""

    column: str
    value: int | float | str | bool


@dataclass(frozen=True)
class ExtractSpec:
    """Base table, joins, null fills, filter and final schema of one analysis frame."""

    base: TableRef
    joins: Sequence[JoinSpec] = ()
    fills: Sequence[FillSpec] = ()
    where: Any = None  # SQL text or a structured predicate, see ledgermill.functions.predicates
    final: TableSpec | None = None
    row_guard: bool = True
    stage: bool | None = None  # write the validated frame to scratch; by default when there are joins to save
    snapshot_dir: str | None = None


@dataclass(frozen=True)
class TargetSpec:
    """Where and how a validated frame is stored: a folder, or with ``table`` a catalogue table (``path`` then says where a
    new one keeps its files, if not in the warehouse)."""

    path: str | None = None
    fmt: str = "parquet"
    mode: str = "overwrite"
    evolve: bool = False
    compression: str | None = None
    partition_by: Sequence[str] = field(default_factory=tuple)
    table: str | None = None


@dataclass(frozen=True)
class IngestSpec:
    """Generic ingest: stages over a scanned frame, retained columns, metadata, validation, result."""

    source: Any  # path or DataFrame
    ingestion_source: str
    load_all: bool = False
    sep: str = ","
    stages: Sequence[Mapping[str, Any]] = ()
    retain: Sequence[str] | None = None
    table: TableSpec | None = None
    target: TargetSpec | None = None
