import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgermill.functions import scalar
from ledgermill.functions.predicates import Ref, apply_where
from ledgermill.operators import filters

DATA = [(1, 1.0, "F"), (2, None, "O"), (3, 3.0, None), (4, 4.0, "F"), (5, None, None)]


@pytest.mark.parametrize(
    "node,text",
    [
        (("x", ">", 1), "x > 1"),
        (("x", "!=", 3.0), "x != 3.0"),
        (("s", "==", "F"), "s == 'F'"),
        (("s", "in", ["F"]), "s in ['F']"),
        (("s", "not in", ["F"]), "s not in ['F']"),
        (("not", ("x", ">", 1)), "not (x > 1)"),
        (("and", ("x", ">=", 1), ("not", ("x", "<=", 3))), "x >= 1 and not (x <= 3)"),
        (("or", ("x", "<", 2), ("i", "==", 5)), "x < 2 or i == 5"),
        (("not", ("or", ("x", "<", 2), ("i", "==", 5))), "not (x < 2 or i == 5)"),
        (("not", ("not", ("x", ">", 1))), "not (not (x > 1))"),
        (("x", "==", Ref("i")), "x == i"),
        (("x", "!=", Ref("i")), "x != i"),
    ],
)
def test_predicates_match_pandas(spark, node, text):
    df = spark.createDataFrame(DATA, "i int, x double, s string")
    want = pd.DataFrame(DATA, columns=["i", "x", "s"]).query(text)
    assert sorted(r.i for r in apply_where(df, node).collect()) == sorted(want.i)


def test_where_forms(spark):
    df = spark.createDataFrame(DATA, "i int, x double, s string")
    assert apply_where(df, "x > 1 and s = 'F'").count() == 1
    assert apply_where(df, F.col("x") > 1).count() == 2
    assert apply_where(df, None) is df
    with pytest.raises(ValueError):
        apply_where(df, ("x", "~", 1))


def test_patterns(spark, rows):
    df = spark.createDataFrame([("TOPIX Core",), ("Old TOPIX",), (None,), ("Small",)], "s string")
    assert rows(filters.matches(df, "s", "TOPIX")) == [("Old TOPIX",), ("TOPIX Core",)]
    assert rows(filters.matches(df, "s", "TOPIX|Small", anchored=True)) == [("Small",), ("TOPIX Core",)]
    assert rows(filters.ends_with_any(df, "s", ["Core", "all"])) == [("Small",), ("TOPIX Core",)]
    assert filters.ends_with_any(df, "s", []).count() == 0


@pytest.fixture
def bars(spark):
    days = [dt.date(2024, 1, d) for d in range(1, 6)]
    return spark.createDataFrame([(c, d) for c in ("1", "2") for d in days], "Code string, Date date")


def test_slices(bars):
    cut = filters.table_slice
    assert cut(bars, "bars", code="1").count() == 5
    assert cut(bars, "bars", date="2024-01-02").count() == 2
    assert cut(bars, "bars", code="1", date="2024-01-02").count() == 1
    assert cut(bars, "bars", code="1", date_from="2024-01-02", date_to="2024-01-04").count() == 3
    assert cut(bars, "flows").count() == 10
    for bad in (
        {},
        {"date_from": "2024-01-01", "date": "2024-01-01"},
        {"code": "1", "date": "2024-01-01", "date_to": "2024-01-02"},
        {"date_from": "2024-01-01"},
        {"section": "x", "code": "1"},
    ):
        with pytest.raises(ValueError):
            cut(bars, "bars", **bad)
    with pytest.raises(ValueError):
        cut(bars, "summary", code="1", date_from="2024-01-01")


def test_date_bounds_on_all_kinds(spark):
    df = spark.sql(
        "select * from values (timestamp_ntz'2024-01-01 00:00:00'), (timestamp_ntz'2024-01-02 23:59:59'), "
        "(timestamp_ntz'2024-01-03 00:00:00') t(a)"
    ).selectExpr("a", "cast(a as date) d", "cast(a as timestamp) t", "cast(a as string) s")
    for c in "adts":
        assert filters.date_between(df, c, "2024-01-02", dt.date(2024, 1, 2)).count() == 1, c
        assert filters.date_cut(df, "2024-01-02", c).count() == 2, c


def test_scalars(spark):
    row = spark.range(1).select(
        scalar.stored_ticker(F.lit("T.T1.T")).alias("literal"),
        scalar.exchange_ticker(F.lit("13010")).alias("ticker"),
        scalar.months_before(F.lit(dt.date(2024, 3, 31))).alias("month"),
        scalar.days_before(F.lit(dt.date(2024, 3, 1)), 30).alias("days"),
        F.size(scalar.each_day(dt.date(2024, 1, 1), dt.date(2024, 1, 31))).alias("n"),
        scalar.parse_date(F.lit("2024-02-30")).alias("bad"),
    ).first()
    assert tuple(row) == ("T010", "1301.T", dt.date(2024, 2, 29), dt.date(2024, 1, 31), 31, None)
