import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from ledgermill.operators import combine, reshape


def test_pivot_mean_matches_pandas(spark):
    data = [("d1", "a", 1.0), ("d1", "a", 4.0), ("d1", "b", None), ("d2", "b", 2.0), (None, "a", 9.0), ("d3", "a", None)]
    df = spark.createDataFrame(data, "doc string, name string, v double")
    out = reshape.pivot_mean(df, ["doc"], "name", "v", ["a", "b", "c"]).toPandas().sort_values("doc")
    want = pd.DataFrame(data, columns=["doc", "name", "v"]).pivot_table(index="doc", columns="name", values="v")
    assert list(out.doc) == list(want.index)
    assert list(out.a.fillna(-1)) == list(want.a.fillna(-1))
    assert list(out.b.fillna(-1)) == list(want.b.fillna(-1))
    assert out.c.isna().all()


def test_statements(spark, rows):
    df = spark.createDataFrame(
        [("7203.T", "Total Revenue", 10.0, 20.0), ("7203.T", "Net Income", 1.0, None), ("1301.T", "Total Revenue", 5.0, 6.0)],
        "ticker string, item string, `2023-03-31` double, `2024-03-31` double",
    )
    out = reshape.statements_to_rows(df, ["Total Revenue", "Net Income", "EBIT"])
    assert out.columns == ["date", "ticker", "Total Revenue", "Net Income", "EBIT"]
    day = dt.date(2023, 3, 31), dt.date(2024, 3, 31)
    assert rows(out) == [
        (day[0], "1301.T", 5.0, None, None),
        (day[0], "7203.T", 10.0, 1.0, None),
        (day[1], "1301.T", 6.0, None, None),
        (day[1], "7203.T", 20.0, None, None),
    ]


def test_pairs_and_maps(spark, rows):
    df = spark.createDataFrame([("t", "symbol", "7203.T"), ("t", "sector", "Autos")], "ticker string, key string, value string")
    assert rows(reshape.pairs_to_row(df, ["ticker"], "key", "value", ["symbol", "sector", "none"])) == [
        ("t", "7203.T", "Autos", None)
    ]
    df = spark.createDataFrame([("t", {"pe": "12.5", "name": "x"})], "ticker string, info map<string,string>")
    out = reshape.map_to_row(df, ["ticker"], F.col("info"), {"pe": "double", "name": "string", "beta": "double"})
    assert rows(out) == [("t", 12.5, "x", None)]


def test_wide_prices(spark, rows):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 4), 1.0, 2.0, None), (dt.date(2024, 1, 5), None, float("nan"), 7.0)],
        "Date date, `A|Open` double, `A|Close` double, `B|Open` double",
    )
    out = reshape.prices_to_rows(df, ["A", "B", "C"], ["Open", "Close"])
    assert out.columns == ["date", "ticker", "Open", "Close"]
    assert rows(out) == [(dt.date(2024, 1, 4), "A", 1.0, 2.0), (dt.date(2024, 1, 5), "B", 7.0, None)]


def test_series_and_stack(spark, rows):
    df = spark.createDataFrame([("t", {dt.date(2024, 3, 1): 1.5, dt.date(2024, 9, 1): 2.0})], "ticker string, series map<date,double>")
    assert rows(reshape.series_to_rows(df, "ticker", "series")) == [
        (dt.date(2024, 3, 1), "t", 1.5),
        (dt.date(2024, 9, 1), "t", 2.0),
    ]
    wide = spark.createDataFrame([(1, 0.5, None), (2, float("nan"), 3.0)], "id int, a double, b double")
    assert rows(reshape.stack_columns(wide, ["id"], ["a", "b"])) == [(1, "a", 0.5), (2, "b", 3.0)]


def test_union_last_and_newest(spark, rows):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2.5, 2)], "b double, id int")
    assert rows(combine.union_parts([a, b])) == [(1, "x", None), (2, None, 2.5)]
    facts = spark.createDataFrame([("d", 0, "a"), ("d", 2, None), ("d", 1, "b")], "doc string, at int, v string")
    assert rows(combine.last_value(facts, ["doc"], "v", ["at"])) == [("d", None)]
    newest = combine.newest_per_key(facts, ["doc"], ["at"])
    assert newest.columns == ["doc", "at", "v"] and rows(newest) == [("d", 2, None)]
    tied = spark.createDataFrame([("d", 1, "a"), ("d", 1, "b"), (None, 1, "c")], "doc string, at int, v string")
    assert rows(combine.newest_per_key(tied, ["doc"], ["at"])) == [("d", 1, "b"), (None, 1, "c")]


def test_repeated_items_by_order_or_smallest(spark, rows):
    data = [("t", "a", 2, None), ("t", "a", 1, None), ("t", "a", 4, 7.0), ("t", "a", 3, 9.0), ("t", "a", 3, 8.0), ("t", "b", 1, 5.0), ("u", "x", 1, 1.0)]
    df = spark.createDataFrame(data, "k string, item string, line int, v double")
    assert rows(reshape.items_to_columns(df, ["k"], "item", "v", ["a", "b"], order=["line"])) == [("t", 8.0, 5.0), ("u", None, None)]
    assert rows(reshape.items_to_columns(df, ["k"], "item", "v", ["a", "b"])) == [("t", 7.0, 5.0), ("u", None, None)]
    wide = spark.createDataFrame([("t", "a", 2, 1.0), ("t", "a", 1, 3.0)], "ticker string, item string, line int, `2024-03-31` double")
    out = reshape.statements_to_rows(wide, ["a"], order=["line"])
    assert rows(out) == [(dt.date(2024, 3, 31), "t", 3.0)]


def test_a_pivot_has_one_exchange(spark):
    df = spark.range(100).selectExpr("id % 7 as doc", "cast(id % 3 as string) as name", "cast(id as double) as v")
    for out in (reshape.pivot_mean(df, ["doc"], "name", "v", ["0", "1"]), reshape.items_to_columns(df, ["doc"], "name", "v", ["0", "1"])):
        plan = out._jdf.queryExecution().sparkPlan().toString() + out._jdf.queryExecution().executedPlan().toString()
        assert out._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1 and "SortAggregate" not in plan
