"""Load windows: which days of a landed table a recurring ingest takes.

Exactly one of an explicit range, a single day or "latest" decides; no bound at all means the whole table.
"""

from __future__ import annotations

import calendar
import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.names import col
from ledgermill.operators.filters import date_between


@dataclass(frozen=True)
class LoadWindow:
    """Inclusive days; an open side is None."""

    start: dt.date | None = None
    end: dt.date | None = None

    def apply(self, df: DataFrame, column: str) -> DataFrame:
        return date_between(df, column, self.start, self.end)


# Days that "latest" reaches back per kind of table, and whether the range ends yesterday.
LATEST_DAYS = {"summary": 30, "statements": 30, "flows": 7}


def _day(value: str | dt.date | None) -> dt.date | None:
    if value is None or isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


def months_back(day: dt.date, months: int) -> dt.date:
    """The same day ``months`` earlier, or the last day of a shorter month."""
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    return dt.date(year, month + 1, min(day.day, calendar.monthrange(year, month + 1)[1]))


def _period_start(period: str, today: dt.date) -> dt.date | None:
    """First day of a lookback such as ``1d``, ``5d``, ``3mo``, ``1y``, ``ytd`` or ``max``."""
    if period == "max":
        return None
    if period == "ytd":
        return dt.date(today.year, 1, 1)
    found = re.fullmatch(r"(\d+)(d|wk|mo|y)", period)
    if not found:
        raise ValueError(f"Unknown period {period!r}")
    n, unit = int(found[1]), found[2]
    if unit == "d":
        return today - dt.timedelta(days=n - 1)
    if unit == "wk":
        return today - dt.timedelta(weeks=n)
    return months_back(today, n if unit == "mo" else 12 * n)


def resolve_window(
    kind: str,
    *,
    start_date: str | dt.date | None = None,
    end_date: str | dt.date | None = None,
    single_date: str | dt.date | None = None,
    latest: bool = False,
    period: str | None = None,
    cut_date: str | dt.date | None = None,
    today: dt.date | None = None,
) -> LoadWindow:
    """Days to load for a ``summary``, ``bars``, ``flows``, ``filings``, ``statements`` or ``prices`` ingest.

    * summary: latest is the last 30 days; bars: yesterday; flows: the last 7 days.
    * filings: up to today, from one month earlier, unless given.
    * statements: from ``cut_date`` on, by default 30 days ago.
    * prices: a range or a lookback period, by default one day.
    """
    today = today or dt.date.today()
    start, end = _day(start_date), _day(end_date)
    ranged = start is not None or end is not None
    if kind == "statements":
        return LoadWindow(_day(cut_date) or today - dt.timedelta(days=30), None)
    if kind == "filings":
        end = end or today
        return LoadWindow(start or months_back(end, 1), end)
    if kind == "prices":
        if ranged and period is not None:
            raise ValueError("Give either a date range or a period, not both")
        if ranged:
            if start is None or end is None:
                raise ValueError("A price range needs both a start and an end date")
            return LoadWindow(start, end)
        return LoadWindow(_period_start(period or "1d", today), today)
    if kind not in ("summary", "bars", "flows"):
        raise ValueError(f"Unknown kind of table {kind!r}")
    if sum([ranged, single_date is not None, bool(latest)]) > 1:
        raise ValueError("Give only one of a date range, a single date or latest")
    if single_date is not None:
        if single_date == "whole":
            return LoadWindow()
        return LoadWindow(_day(single_date), _day(single_date))
    if latest:
        if kind == "bars":
            yesterday = today - dt.timedelta(days=1)
            return LoadWindow(yesterday, yesterday)
        return LoadWindow(today - dt.timedelta(days=LATEST_DAYS[kind]), today)
    return LoadWindow(start, end)


def latest_rows(df: DataFrame, column: str, days: int) -> DataFrame:
    """Rows of the last ``days`` days of the table itself. One job reads the newest date from that column alone, and the
    bound then reaches the scan as a literal."""
    newest = df.agg(F.max(col(column)).cast("date").alias("d")).first()["d"]
    if newest is None:
        return df
    return date_between(df, column, newest - dt.timedelta(days=days))
