"""Union of parts by column name, distinct rows, and the newest row per key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.names import col, require_columns


def union_parts(parts: Iterable[DataFrame]) -> DataFrame:
    """All rows of all parts, matched by column name; a column a part lacks is null there."""
    parts = list(parts)
    if not parts:
        raise ValueError("No parts to combine")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows, of the named columns when given."""
    if columns:
        require_columns(df, columns)
        df = df.select(*[col(c) for c in columns])
    return df.distinct()


def last_value(df: DataFrame, index: Sequence[str], value: str, order: Sequence[str], name: str | None = None) -> DataFrame:
    """The value on the last row of each group in ``order``: one maximum per group, taken before and
    after the shuffle. Spark sorts by the group's columns for it (the maximum holds text), it gathers no group."""
    require_columns(df, [*index, value, *order])
    last = F.max_by(col(value), F.struct(*[col(o) for o in order]))
    return df.groupBy(*[col(i) for i in index]).agg(last.alias(name or value))


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The whole row with the greatest ``order`` per key; ties go to the greatest remaining columns, so the result
    does not depend on how the rows arrive."""
    require_columns(df, [*keys, *order])
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*[col(o) for o in order], *[col(c) for c in rest])).alias("_row")
    rows = df.groupBy(*[col(k) for k in keys]).agg(best)
    picked = {c: (col(c) if c in keys else F.col("_row").getField(c)) for c in df.columns}
    return rows.select(*[c.alias(n) for n, c in picked.items()])
