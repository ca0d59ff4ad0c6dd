"""Validation of a frame against a table spec.

``validate`` fails on the first broken rule, like a schema check in front of a table; ``validation_report`` lists every
rule with its number of bad rows. Both coerce first, so a rule sees the typed value.

The not-null and whole-number rules are counters in one aggregate, and the values of all unique columns are counted in one
more. ``validate`` can take its counters while it writes the typed frame to the shared scratch folder (``stage=True``), so
that an expensive input is computed once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions.coerce import not_whole, to_logical
from ledgermill.names import col, require_columns
from ledgermill.operators.profile import repeated_value_counts
from ledgermill.operators.project import rename_declared, strict_columns
from ledgermill.scratch import write_scratch
from ledgermill.spec import TableSpec, spark_type

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


class ValidationError(ValueError):
    """A frame broke a rule of its table spec."""


def typed_columns(df: DataFrame, spec: TableSpec) -> list[Column]:
    """The declared columns of ``df`` with declared types, under source names; bad input is null."""
    return [to_logical(col(c.name), df.schema[c.name].dataType, c.type, c.format).alias(c.name) for c in spec.columns]


def typed(df: DataFrame, spec: TableSpec, carry: Sequence[str] = ()) -> DataFrame:
    """Declared columns in declared order with declared types, then the carried columns untouched."""
    require_columns(df, [*spec.source_names, *carry], f"the frame for {spec.name!r}")
    return df.select(*typed_columns(df, spec), *[col(c) for c in carry])


def _flagged(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, list[tuple[str, str, str]]]:
    """The typed frame plus one boolean column per whole-number rule that can fail, and the rule list
    ``(column, rule, counted column)``."""
    source = strict_columns(df, spec)
    extra, rules = [], []
    for i, c in enumerate(spec.columns):
        kind = source.schema[c.name].dataType
        if isinstance(spark_type(c.type), _INTEGRAL) and not isinstance(kind, _INTEGRAL + (T.BooleanType,)):
            extra.append(not_whole(col(c.name), kind).alias(f"_whole_{i}"))
            rules.append((c.name, "whole", f"_whole_{i}"))
    rules += [(c.name, "nullable", c.name) for c in spec.columns if not c.nullable]
    return source.select(*typed_columns(source, spec), *extra), rules


def _counters(rules: list[tuple[str, str, str]]) -> list:
    return [
        F.count_if(col(counted) if rule == "whole" else col(counted).isNull()).alias(f"r{i}")
        for i, (_, rule, counted) in enumerate(rules)
    ]


def validation_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows ``(column_name, rule, n_bad)`` for every not-null, whole-number and unique rule of the spec.

    For a unique column ``n_bad`` is the number of rows beyond the first of each value; repeated nulls are left to the
    not-null rule.
    """
    flagged, rules = _flagged(df, spec)
    parts = []
    if rules:
        counts = flagged.agg(*_counters(rules))
        entries = [
            F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("rule"), F.col(f"r{i}").alias("n_bad"))
            for i, (c, r, _) in enumerate(rules)
        ]
        parts.append(counts.select(F.inline(F.array(*entries))))
    unique = [c.name for c in spec.columns if c.unique]
    if unique:
        repeats = repeated_value_counts(flagged, unique)
        entries = [
            F.struct(F.lit(c).alias("column_name"), F.lit("unique").alias("rule"), col(c).alias("n_bad")) for c in unique
        ]
        parts.append(repeats.select(F.inline(F.array(*entries))))
    if not parts:
        return df.sparkSession.createDataFrame([], "column_name string, rule string, n_bad bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def raise_if_bad(report: DataFrame) -> None:
    """Raise on the broken rules of a report."""
    bad = [(r["column_name"], r["rule"], r["n_bad"]) for r in report.filter("n_bad > 0").collect()]
    if bad:
        raise ValidationError("; ".join(f"{c}: {n} rows break the {rule} rule" for c, rule, n in sorted(bad)))


def validate(df: DataFrame, spec: TableSpec, stage: bool = False) -> DataFrame:
    """The typed frame under stored names, or :class:`ValidationError`.

    Runs the checks now. With ``stage`` the typed frame is written to the shared scratch folder while it is counted and
    the result reads it back, so the input is computed once; otherwise the result is lazy over the input.
    """
    flagged, rules = _flagged(df, spec)
    if stage:
        counts = {}
        if rules:
            seen = Observation("rules")
            staged = write_scratch(flagged.observe(seen, *_counters(rules)), "validated")
            counts = seen.get
        else:
            staged = write_scratch(flagged, "validated")
        flagged = staged
    else:
        counts = flagged.agg(*_counters(rules)).first().asDict() if rules else {}
    for i, (name, rule, _) in enumerate(rules):
        if counts[f"r{i}"]:
            raise ValidationError(f"{name}: {counts[f'r{i}']} rows break the {rule} rule")
    unique = [c.name for c in spec.columns if c.unique]
    for name, n in (repeated_value_counts(flagged, unique).first().asDict() if unique else {}).items():
        if n:
            raise ValidationError(f"{name}: repeated values break the unique rule")
    return rename_declared(flagged.select(*[col(c.name) for c in spec.columns]), spec)
