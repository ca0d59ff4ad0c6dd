"""Scalar helpers: exchange codes, date text, date arithmetic, calendars and null tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions.coerce import without_nan

# The exchange suffix of a listed code and the check digit that replaces it in stored tables.
EXCHANGE_SUFFIX = ".T"
CHECK_DIGIT = "0"


def exchange_ticker(code: Column) -> Column:
    """First four characters of a code plus the exchange suffix."""
    return F.concat(F.substring(code, 1, 4), F.lit(EXCHANGE_SUFFIX))


def stored_ticker(ticker: Column) -> Column:
    """Exchange suffix replaced by the check digit, as literal text (never a pattern)."""
    return F.replace(ticker, F.lit(EXCHANGE_SUFFIX), F.lit(CHECK_DIGIT))


def date_text(c: Column) -> Column:
    """``yyyy-MM-dd`` text of a date or timestamp."""
    return F.date_format(c, "yyyy-MM-dd")


def parse_date(c: Column) -> Column:
    """ISO date text as a date, bad text as null."""
    return F.try_to_date(c, "yyyy-MM-dd")


def months_before(c: Column, months: int = 1) -> Column:
    return F.add_months(c.cast("date"), -months)


def days_before(c: Column, days: int) -> Column:
    return F.date_sub(c.cast("date"), days)


def each_day(start: Column | dt.date, end: Column | dt.date) -> Column:
    """Array of every day from ``start`` to ``end``, both included; explode it for rows."""
    lo = start if isinstance(start, Column) else F.lit(start)
    hi = end if isinstance(end, Column) else F.lit(end)
    return F.sequence(lo.cast("date"), hi.cast("date"), F.expr("interval 1 day"))


def now_whole_seconds() -> Column:
    return F.date_trunc("second", F.current_timestamp())


def is_missing(c: Column, source: T.DataType | None = None) -> Column:
    """Null test that also counts NaN when the column type is a float."""
    return (c if source is None else without_nan(c, source)).isNull()
