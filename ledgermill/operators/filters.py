"""Row filters: date cuts, code patterns, suffixes, equality sets and request-style table slices."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.names import col, require_columns


def _bound(df: DataFrame, column: str, value: str | dt.date | dt.datetime) -> Column:
    """The bound as a literal of the column's own type, so that the comparison reaches the file scan uncast."""
    kind = df.schema[column].dataType
    return F.lit(str(value)) if isinstance(kind, T.StringType) else F.lit(value).cast(kind)


def date_cut(df: DataFrame, cut_date: str | dt.date, column: str = "date") -> DataFrame:
    """Rows on or after ``cut_date``."""
    require_columns(df, [column])
    return df.filter(col(column) >= _bound(df, column, cut_date))


def date_between(
    df: DataFrame, column: str, start: str | dt.date | None = None, end: str | dt.date | None = None
) -> DataFrame:
    """Rows from ``start`` to the end of day ``end``; either side may be open.

    Works on dates, timestamps and ISO text, which sorts like the dates it spells.
    """
    require_columns(df, [column])
    if start is not None:
        df = df.filter(col(column) >= _bound(df, column, start))
    if end is not None:
        if isinstance(df.schema[column].dataType, T.DateType):
            df = df.filter(col(column) <= _bound(df, column, end))
        else:
            day = dt.date.fromisoformat(str(end)[:10]) + dt.timedelta(days=1)
            df = df.filter(col(column) < _bound(df, column, day))
    return df


def matches(df: DataFrame, column: str, pattern: str, anchored: bool = False) -> DataFrame:
    """Rows whose text contains the pattern, or starts with a match of it when ``anchored``; null never matches."""
    require_columns(df, [column])
    return df.filter(col(column).cast("string").rlike(f"^(?:{pattern})" if anchored else pattern))


def ends_with_any(df: DataFrame, column: str, suffixes: Sequence[str]) -> DataFrame:
    """Rows whose text ends with one of the suffixes."""
    require_columns(df, [column])
    test = F.lit(False)
    for suffix in suffixes:
        test = test | col(column).endswith(suffix)
    return df.filter(test)


def equals_all(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Rows where every named column equals its value."""
    require_columns(df, values)
    for name, value in values.items():
        df = df.filter(col(name) == F.lit(value))
    return df


def code_slice(df: DataFrame, code: object, column: str = "local_code") -> DataFrame:
    """Rows of one code; all rows when ``code`` is None."""
    return df if code is None else equals_all(df, {column: code})


# Which arguments each kind of table accepts: the rules of the requests these slices stand for.
SLICE_RULES = {
    "summary": {"needs": ("code", "date"), "allows": ("code", "date")},
    "bars": {"needs": ("code", "date"), "allows": ("code", "date", "date_from", "date_to")},
    "flows": {"needs": (), "allows": ("section", "date_from", "date_to")},
}


def table_slice(
    df: DataFrame,
    kind: str = "bars",
    *,
    code: object = None,
    date: str | dt.date | None = None,
    date_from: str | dt.date | None = None,
    date_to: str | dt.date | None = None,
    section: str | None = None,
    code_column: str = "Code",
    date_column: str = "Date",
    section_column: str = "Section",
) -> DataFrame:
    """Slice a landed table by code, day, day range or section.

    ``summary`` and ``bars`` need a code or a date; a range needs a code and excludes a single date. A table
    partitioned by the date column is pruned to the partitions asked for.
    """
    given = {"code": code, "date": date, "date_from": date_from, "date_to": date_to, "section": section}
    given = {k: v for k, v in given.items() if v is not None}
    rules = SLICE_RULES[kind]
    illegal = sorted(set(given) - set(rules["allows"]))
    if illegal:
        raise ValueError(f"A {kind} slice does not accept {illegal}")
    if rules["needs"] and not any(k in given for k in rules["needs"]):
        raise ValueError(f"A {kind} slice needs at least one of {list(rules['needs'])}")
    ranged = "date_from" in given or "date_to" in given
    if kind == "bars" and ranged and "code" not in given:
        raise ValueError("A date range needs a code")
    if ranged and "date" in given:
        raise ValueError("Give either a single date or a date range, not both")
    if "code" in given:
        df = equals_all(df, {code_column: code})
    if "section" in given:
        df = equals_all(df, {section_column: section})
    if "date" in given:
        return date_between(df, date_column, date, date)
    return date_between(df, date_column, date_from, date_to) if ranged else df
