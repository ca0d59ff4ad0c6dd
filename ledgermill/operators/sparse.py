"""Drop columns that are mostly missing."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgermill.names import col
from ledgermill.operators.profile import null_counts


def dense_columns(df: DataFrame, threshold: float = 0.5) -> list[str]:
    """Columns whose missing fraction is below ``threshold``, from one pass; all columns for an empty frame."""
    counts = null_counts(df).first().asDict()
    n = counts["_n"]
    return [c for c in df.columns if n == 0 or counts[c] / n < threshold]


def drop_sparse_columns(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Keep a column only when its missing fraction is strictly below ``threshold``. Runs the counting job now."""
    return df.select(*[col(c) for c in dense_columns(df, threshold)])
