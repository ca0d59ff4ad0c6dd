"""Rows behind a price chart: one code's bars, or every code's, with the top of the volume axis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.names import col, require_columns
from ledgermill.operators.filters import code_slice
from ledgermill.operators.joins import null_safe_join


def chart_feed(
    df: DataFrame,
    columns: Sequence[str],
    volume: str,
    code_column: str = "local_code",
    code: object = None,
    axis: str = "axis_max",
) -> DataFrame:
    """The chart columns plus the code's greatest volume.

    For one code the maximum is read first, in a small job, and attached as a constant. For all codes it is one
    pre-aggregated row per code joined back, not a window, so a code with a very long history is spread over tasks.
    """
    require_columns(df, [code_column, volume, *columns])
    if code is not None:
        rows = code_slice(df, code, code_column)
        top = rows.agg(F.max(col(volume)).alias(axis)).first()[axis]
        return rows.select(*[col(c) for c in columns], F.lit(top).cast(df.schema[volume].dataType).alias(axis))
    top = df.groupBy(col(code_column)).agg(F.max(col(volume)).alias(axis))
    needed = [code_column] + [c for c in columns if c != code_column]
    joined = null_safe_join(df.select(*[col(c) for c in needed]), top, [code_column], "left")
    return joined.select(*[col(c) for c in columns], col(axis))
