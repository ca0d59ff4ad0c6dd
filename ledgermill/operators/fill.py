"""Null fill by column statistic or constant, and as a fitted stage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions.coerce import without_nan
from ledgermill.names import col, require_columns
from ledgermill.operators.joins import null_safe_join
from ledgermill.operators.medians import exact_medians
from ledgermill.operators.profile import FILL_METHODS, fill_statistics
from ledgermill.spec import FillSpec

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


# one past the largest value of each whole-number type
_LIMIT = {T.ByteType: 2**7, T.ShortType: 2**15, T.IntegerType: 2**31, T.LongType: 2**63}


def fill_values(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Replace nulls (and NaN) by the given value per column.

    A whole-number column that gets a fractional value becomes a double; a sum widens to 64 bits.
    """
    require_columns(df, values)
    out = []
    for f in df.schema.fields:
        c = col(f.name)
        value = values.get(f.name)
        if value is None:
            out.append(c)
            continue
        kind = f.dataType
        if isinstance(kind, _INTEGRAL) and isinstance(value, float):
            kind = T.DoubleType()
        elif isinstance(kind, _INTEGRAL) and isinstance(value, int) and not isinstance(value, bool):
            kind = T.LongType() if not -_LIMIT[type(kind)] <= value < _LIMIT[type(kind)] else kind
        present = without_nan(c, f.dataType).cast(kind)
        out.append(F.coalesce(present, F.lit(value).cast(kind)).alias(f.name))
    return df.select(*out)


def resolve_fills(
    df: DataFrame, fills: Sequence[FillSpec], stats_from: DataFrame | None = None, exact: bool = True
) -> dict[str, Any]:
    """Constants for every fill: numeric columns take a statistic name (or a number), other columns the value itself.

    Statistics are computed now, over ``stats_from`` (by default ``df``); columns the frame lacks are ignored.
    ``exact=False`` allows approximate medians, which need no pass of their own.
    """
    methods, values = {}, {}
    for fill in fills:
        if fill.column not in df.columns:
            continue
        if isinstance(df.schema[fill.column].dataType, T.NumericType):
            if isinstance(fill.value, (int, float)) and not isinstance(fill.value, bool):
                values[fill.column] = fill.value
            elif fill.value in FILL_METHODS:
                methods[fill.column] = fill.value
            else:
                raise ValueError(f"Numeric column {fill.column!r} needs one of {FILL_METHODS} or a number")
        else:
            values[fill.column] = fill.value
    if methods:
        stats = fill_statistics(stats_from if stats_from is not None else df, methods, exact)
        for name, value in stats.items():
            fractional = methods[name] in ("mean", "median") and isinstance(df.schema[name].dataType, _INTEGRAL)
            values[name] = float(value) if fractional and value is not None else value
    return values


def fill_nulls(df: DataFrame, fills: Sequence[FillSpec] | Mapping[str, Any], exact: bool = True) -> DataFrame:
    """Fill nulls by statistic or constant. Runs the statistics jobs now; the filled frame is lazy."""
    if isinstance(fills, Mapping):
        fills = [FillSpec(c, v) for c, v in fills.items()]
    return fill_values(df, resolve_fills(df, fills, exact=exact))


def fill_nulls_by_group(df: DataFrame, group: Sequence[str], fills: Mapping[str, Any]) -> DataFrame:
    """Fill nulls by the group's own ``mean``, ``median``, ``min``, ``max``, ``sum`` or ``mode``, or by a constant.

    The statistics are pre-aggregated to one row per group and joined back, so a hot group is never gathered in one task.
    A column keeps its type, except that ``mean`` and ``median`` make a whole-number column a double. Medians are exact
    and run their rounds now, for all columns and groups together.
    """
    require_columns(df, [*group, *fills])
    keys = [col(g) for g in group]
    simple = {"mean": F.avg, "min": F.min, "max": F.max, "sum": F.sum}

    def present(name: str):
        return without_nan(col(name), df.schema[name].dataType)

    tables = []
    aggregates = [simple[m](present(c)).alias(f"_s_{c}") for c, m in fills.items() if m in simple]
    if aggregates:
        tables.append(df.groupBy(*keys).agg(*aggregates))
    for name in [c for c, m in fills.items() if m == "mode"]:
        counts = df.groupBy(*keys, present(name).alias("_v")).agg(F.count(F.lit(1)).alias("_n")).filter("_v is not null")
        best = F.min(F.struct((-F.col("_n")).alias("n"), F.col("_v"))).getField("_v")
        tables.append(counts.groupBy(*keys).agg(best.alias(f"_s_{name}")))
    medians = [c for c, m in fills.items() if m == "median" and isinstance(df.schema[c].dataType, T.NumericType)]
    if medians:
        found = exact_medians(df, medians, list(group))
        tables.append(found.select(*keys, *[col(c).alias(f"_s_{c}") for c in medians]))
    out = df
    for stats in tables:
        out = null_safe_join(out, stats, list(group), "left")
    columns = []
    for f in df.schema.fields:
        method = fills.get(f.name)
        if method is None:
            columns.append(col(f.name))
            continue
        if method in simple or method == "mode" or f.name in medians:
            value = col(f"_s_{f.name}")
        elif method == "zero":
            value = F.lit(0)
        elif isinstance(f.dataType, T.NumericType) and isinstance(method, str):
            raise ValueError(f"Group fill of {f.name!r} by {method!r} is not supported")
        else:
            value = F.lit(method)
        if method == "sum" and isinstance(f.dataType, _INTEGRAL):
            value = value.cast("long")  # a sum widens to 64 bits
        elif method != "mean" and f.name not in medians:
            value = value.cast(f.dataType)
        columns.append(F.coalesce(without_nan(col(f.name), f.dataType), value).alias(f.name))
    return out.select(*columns)
