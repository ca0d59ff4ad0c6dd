"""Column statistics in one pass: row count, null counts and fractions, numeric summaries, exact median and mode.

Exact medians and modes are found without ever holding a column's values in one task, for all columns at once: modes from
per-value counts (pre-aggregated before the shuffle), medians by :mod:`ledgermill.operators.medians`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions.coerce import without_nan
from ledgermill.functions.scalar import is_missing
from ledgermill.names import col, require_columns
from ledgermill.operators.medians import SKETCH, exact_medians, opened, opening, present_double

FILL_METHODS = ("mean", "median", "mode", "min", "max", "sum", "zero")


def _present(df: DataFrame, name: str) -> Column:
    return without_nan(col(name), df.schema[name].dataType)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def empty_test(df: DataFrame) -> DataFrame:
    """One row ``is_empty``; reads no more than the first row found."""
    return df.limit(1).agg((F.count(F.lit(1)) == 0).alias("is_empty"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with ``n`` and, per column, the number of nulls (NaN included) under the column's name."""
    columns = list(columns or df.columns)
    require_columns(df, columns)
    return df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(is_missing(col(c), df.schema[c].dataType)).alias(c) for c in columns],
    )


def null_fractions(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows ``(column_name, null_frac)``, one per column, from a single pass."""
    columns = list(columns or df.columns)
    counts = null_counts(df, columns)
    n = F.col("_n")
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.when(n > 0, col(c).cast("double") / n).alias("null_frac"))
        for c in columns
    ]
    return counts.select(F.inline(F.array(*entries)))


def value_counts(df: DataFrame, name: str) -> DataFrame:
    """``(value, n)`` of the present values."""
    return df.select(_present(df, name).alias("value")).filter("value is not null").groupBy("value").agg(
        F.count(F.lit(1)).alias("n")
    )


def typed_entries(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The present values of several columns as rows ``(place, v0, v1, ...)``: the column's place, and the value in the
    field of its type. Also the names of the fields by place."""
    kinds = list(dict.fromkeys(df.schema[c].dataType.simpleString() for c in columns))

    def entry(place: int, name: str) -> Column:
        kind = df.schema[name].dataType.simpleString()
        fields = [(_present(df, name) if k == kind else F.lit(None).cast(k)).alias(f"v{j}") for j, k in enumerate(kinds)]
        return F.struct(F.lit(place).alias("place"), _present(df, name).isNotNull().alias("there"), *fields)

    entries = df.select(F.inline(F.array(*[entry(i, c) for i, c in enumerate(columns)]))).filter("there").drop("there")
    return entries, [f"v{kinds.index(df.schema[c].dataType.simpleString())}" for c in columns]


def repeated_value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: per column, under its name, how many rows lie beyond the first of each present value.

    One pass counts the values of all columns, combined before the one exchange of values.
    """
    require_columns(df, columns)
    entries, _ = typed_entries(df, columns)
    extra = entries.groupBy(*entries.columns).agg((F.count(F.lit(1)) - 1).alias("extra"))
    sums = [F.coalesce(F.sum(F.when(F.col("place") == i, F.col("extra"))), F.lit(0)).cast("bigint").alias(c)
            for i, c in enumerate(columns)]
    return extra.agg(*sums)


def exact_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, Any]:
    """Most frequent present value of each column, the smallest on a tie; None when all are missing.

    One pass counts the values of all columns, combined before the exchange.
    """
    columns = list(columns)
    if not columns:
        return {}
    entries, fields = typed_entries(df, columns)
    values = [c for c in entries.columns if c != "place"]
    counts = entries.groupBy("place", *values).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("place").agg(F.min(F.struct((-F.col("n")).alias("r"), *values)).alias("m"))
    found = {r["place"]: r["m"] for r in best.collect()}
    return {c: found[i][fields[i]] if i in found else None for i, c in enumerate(columns)}


def exact_mode(df: DataFrame, name: str) -> Any:
    """Most frequent present value, the smallest on a tie; None when all are missing."""
    return exact_modes(df, [name])[name]


def exact_median(df: DataFrame, name: str, accuracy: int = SKETCH) -> float | None:
    """Exact median (mean of the two middle values for an even count); None when all values are missing.

    ``accuracy`` is the size of the sketches the search goes by; it has no say in the result."""
    return exact_medians(df, [name], size=accuracy).first()[0]


def fill_statistics(df: DataFrame, methods: Mapping[str, str], exact: bool = True) -> dict[str, Any]:
    """Fill value of each column. Passes over the data do not depend on the number of columns: one fused aggregate, one
    count of values for all modes, and the rounds of :func:`exact_medians` for all medians together.

    ``exact=False`` takes medians from ``percentile_approx`` inside the fused aggregate.
    """
    unknown = {c: m for c, m in methods.items() if m not in FILL_METHODS}
    if unknown:
        raise ValueError(f"Unknown fill methods {unknown}; use one of {FILL_METHODS}")
    require_columns(df, methods)
    fused, picked, out = [], [], {}
    medians = [c for c, m in methods.items() if m == "median" and exact]
    for i, (name, method) in enumerate(methods.items()):
        kind, v = df.schema[name].dataType, _present(df, name)
        if not isinstance(kind, T.NumericType):
            raise ValueError(f"Column {name!r} is {kind.simpleString()}; {method!r} needs a number")
        picked.append(F.col(f"s{i}"))
        if method == "mean":
            fused.append(F.avg(v).alias(f"s{i}"))
        elif method == "sum":
            fused.append(F.coalesce(F.sum(v), F.lit(0)).alias(f"s{i}"))
        elif method in ("min", "max"):
            fused.append(getattr(F, method)(v).alias(f"s{i}"))
        elif method == "median" and not exact:
            fused.append(F.percentile_approx(v.cast("double"), 0.5, 10_000).alias(f"s{i}"))
        elif method == "median":
            fused.append(opening(present_double(df, name)).alias(f"s{i}"))
            picked[-1] = opened(F.col(f"s{i}")).alias(f"s{i}")
        else:
            picked.pop()
            if method == "zero":
                out[name] = 0
    seen = df.agg(*fused).select(*picked).collect() if fused else []
    row = seen[0].asDict() if seen else {}
    if medians:
        state = [row.pop(f"s{list(methods).index(c)}") for c in medians]
        out |= exact_medians(df, medians, state=state).first().asDict()
    out |= exact_modes(df, [c for c, m in methods.items() if m == "mode"])
    out |= {name: row[f"s{i}"] for i, name in enumerate(methods) if f"s{i}" in row}
    return {name: out[name] for name in methods}
