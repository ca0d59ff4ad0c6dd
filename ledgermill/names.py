"""Column access that survives spaces and dots in names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Top-level column by its exact name."""
    return F.col(quoted(name))


def require_columns(df: DataFrame, names: Iterable[str], what: str = "data") -> None:
    """Raise ``ValueError`` when a named column is absent; looks at the schema only."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"Columns {missing} not found in {what}; it has {df.columns}")
