"""Reshapes: long to wide with mean, statements to rows, key/value pairs, wide prices to rows, series to rows.

The wanted names are given, so a long table becomes wide by one aggregate with a condition per name: its rows are combined
before the one exchange, and no job looks for names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions.coerce import without_nan
from ledgermill.functions.scalar import is_missing
from ledgermill.names import col, require_columns


def pivot_mean(
    df: DataFrame, index: Sequence[str], names: str, values: str, wanted: Sequence[str], drop_empty: bool = True
) -> DataFrame:
    """One row per index with the mean of ``values`` in one column per wanted name.

    Rows with a null index are left out, NaN counts as missing, and an index whose every value is missing or whose names
    are all unwanted yields no row (``drop_empty``). The wanted names are given, so no job looks for them.
    """
    require_columns(df, [*index, names, values])
    v = without_nan(col(values), df.schema[values].dataType)
    rows = df.select(*[col(i) for i in index], col(names).alias("_name"), v.alias("_value"))
    rows = rows.dropna(subset=list(index)) if index else rows
    rows = rows.filter(F.col("_name").isin(list(wanted)))
    means = [F.avg(F.when(F.col("_name") == F.lit(w), F.col("_value"))).alias(str(w)) for w in dict.fromkeys(wanted)]
    wide = rows.groupBy(*[col(i) for i in index]).agg(*means)
    return wide.filter(F.coalesce(*[col(w) for w in wanted]).isNotNull()) if drop_empty else wide


def unpivot(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Wide to long: one row per id row and named column."""
    require_columns(df, [*ids, *columns])
    return df.unpivot([col(i) for i in ids], [col(c) for c in columns], name, value)


def items_to_columns(
    df: DataFrame, index: Sequence[str], item: str, value: str, items: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Long ``(index..., item, value)`` to one row per index with a column per item; an index without wanted items has a
    row of nulls.

    A repeated item has the value of its first row in ``order`` that has one (of several such rows, the smallest value);
    without an order, its smallest value.
    """
    require_columns(df, [*index, item, value, *order])

    def picked(name: str) -> Column:
        wanted = F.when((col(item) == F.lit(name)) & col(value).isNotNull(), col(value))
        if not order:
            return F.min(wanted).alias(str(name))
        first = F.struct(*[col(o).alias(f"o{i}") for i, o in enumerate(order)], col(value).alias("v"))
        return F.min(F.when(wanted.isNotNull(), first))["v"].alias(str(name))

    return df.groupBy(*[col(i) for i in index]).agg(*[picked(name) for name in dict.fromkeys(items)])


def statements_to_rows(
    matrix: DataFrame,
    items: Sequence[str],
    ticker: str = "ticker",
    item: str = "item",
    periods: Sequence[str] | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Statement matrices of all tickers (items down, period dates across) to one row per ticker and date.

    ``periods`` are the date-named columns; by default every column besides ticker, item and ``order``, which says which
    row counts where a ticker repeats an item.
    """
    periods = list(periods or [c for c in matrix.columns if c not in (ticker, item, *order)])
    long = unpivot(matrix, [ticker, item, *order], periods, "date", "_value")
    out = items_to_columns(long, ["date", ticker], item, "_value", items, order)
    return out.withColumn("date", F.to_date("date"))


def pairs_to_row(
    df: DataFrame, index: Sequence[str], key: str, value: str, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Key/value rows to one wide row per index."""
    return items_to_columns(df, index, key, value, keys, order)


def map_to_row(df: DataFrame, index: Sequence[str], entries: Column, fields: Mapping[str, T.DataType | str]) -> DataFrame:
    """A map column to one column per wanted key; row by row, so nothing is shuffled."""
    picked = [F.try_element_at(entries, F.lit(k)).try_cast(t).alias(k) for k, t in fields.items()]
    return df.select(*[col(i) for i in index], *picked)


def stack_columns(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "field", value: str = "v"
) -> DataFrame:
    """Wide columns to long rows without the missing ones."""
    long = unpivot(df, ids, columns, name, value)
    return long.filter(~is_missing(col(value), long.schema[value].dataType))


def prices_to_rows(
    wide: DataFrame, tickers: Sequence[str], fields: Sequence[str], date: str = "Date", sep: str = "|"
) -> DataFrame:
    """Two-level wide prices (columns ``ticker|field``) to ``(date, ticker, fields...)`` rows.

    A (date, ticker) whose every field is missing gives no row. All fields of a pair sit in one input row, so the rows
    are exploded in place: no shuffle.
    """
    require_columns(wide, [date])
    structs = []
    for ticker in tickers:
        parts = []
        for f in fields:
            name = f"{ticker}{sep}{f}"
            parts.append((col(name) if name in wide.columns else F.lit(None)).cast("double").alias(f))
        structs.append(F.struct(F.lit(ticker).alias("ticker"), *parts))
    rows = wide.select(col(date).alias("date"), F.inline(F.array(*structs)))
    present = F.lit(False)
    for f in fields:
        present = present | ~is_missing(col(f), T.DoubleType())
    return rows.filter(present)


def series_to_rows(
    df: DataFrame, ticker: str, series: str | None = None, date: str = "date", amount: str = "Dividends"
) -> DataFrame:
    """A dated series per ticker, as a map column, to ``(date, ticker, amount)`` rows."""
    require_columns(df, [ticker, series or ""])
    return df.select(col(ticker).alias("ticker"), F.explode(col(series)).alias(date, amount)).select(
        date, "ticker", amount
    )
