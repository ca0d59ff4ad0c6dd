import datetime as dt

import pytest

from ledgermill.operators.project import impute_missing_columns, with_ingestion_metadata
from ledgermill.operators.validate import ValidationError, raise_if_bad, validate, validation_report
from ledgermill.spec import ColumnSpec, TableSpec

SPEC = TableSpec(
    (
        ColumnSpec("Column1", "String", nullable=False, unique=True),
        ColumnSpec("Column2", "String", nullable=False, unique=True, rename="second"),
    )
)


@pytest.fixture(params=[False, True], ids=["lazy", "staged"])
def stage(request):
    return request.param


def test_good_frame(spark, rows, stage):
    df = spark.createDataFrame([("A", 1, 0.5), ("B", 2, 0.5)], "Column1 string, Column2 int, extra double")
    out = validate(df, SPEC, stage)
    assert out.columns == ["Column1", "second"]
    assert rows(out) == [("A", "1"), ("B", "2")]


def test_missing_column(spark, stage):
    with pytest.raises(ValueError, match="Column2"):
        validate(spark.createDataFrame([("A",)], "Column1 string"), SPEC, stage)


def test_null_breaks_rule(spark, stage):
    df = spark.createDataFrame([("A", 1), (None, 2)], "Column1 string, Column2 int")
    with pytest.raises(ValidationError, match="Column1: 1 rows break the nullable rule"):
        validate(df, SPEC, stage)


def test_repeat_breaks_rule(spark, stage):
    df = spark.createDataFrame([("A", 1), ("A", 2)], "Column1 string, Column2 int")
    with pytest.raises(ValidationError, match="Column1: repeated"):
        validate(df, SPEC, stage)


def test_fraction_breaks_rule(spark, stage):
    spec = TableSpec((ColumnSpec("n", "Int"),))
    with pytest.raises(ValidationError, match="whole"):
        validate(spark.createDataFrame([("1",), ("2.5",)], "n string"), spec, stage)


def test_bad_text_becomes_null_and_can_break_not_null(spark, stage):
    spec = TableSpec((ColumnSpec("n", "Int", nullable=False),))
    with pytest.raises(ValidationError, match="nullable"):
        validate(spark.createDataFrame([("1",), ("x",)], "n string"), spec, stage)


def test_no_rules(spark, rows, stage):
    spec = TableSpec((ColumnSpec("n", "Int"), ColumnSpec("s", "String")))
    df = spark.createDataFrame([(1, "a"), (None, None)], "n int, s string")
    assert rows(validate(df, spec, stage)) == [(1, "a"), (None, None)]


def test_report(spark, rows):
    spec = TableSpec((ColumnSpec("a", "Int", nullable=False, unique=True), ColumnSpec("b", "String", nullable=False)))
    df = spark.createDataFrame([("1", "x"), ("1", None), ("2.5", "y"), (None, "z"), (None, "z")], "a string, b string")
    report = validation_report(df, spec)
    assert rows(report) == [("a", "nullable", 3), ("a", "unique", 1), ("a", "whole", 1), ("b", "nullable", 1)]
    with pytest.raises(ValidationError, match="a: 1 rows break the unique rule"):
        raise_if_bad(report)


def test_metadata(spark):
    df = spark.createDataFrame([(dt.date(2024, 5, 2), True, "north")], "counted_on date, complete boolean, region string")
    out = with_ingestion_metadata(df, "src", dt.datetime(2024, 1, 5, 10, 0, 0, 123456))
    assert out.columns == ["counted_on", "complete", "region", "ingestion_datetime", "ingestion_source"]
    row = out.first()
    assert row["ingestion_datetime"] == dt.datetime(2024, 1, 5, 10, 0, 0)
    assert row["ingestion_source"] == "src"
    assert df.columns == ["counted_on", "complete", "region"]
    now = with_ingestion_metadata(df)
    assert "ingestion_source" not in now.columns
    assert now.first()["ingestion_datetime"].microsecond == 0


def test_impute(spark):
    df = spark.createDataFrame([(1,)], "a int")
    spec = TableSpec((ColumnSpec("a", "Int"), ColumnSpec("b c", "Float"), ColumnSpec("d", "Date")))
    out = impute_missing_columns(df, spec)
    assert out.columns == ["a", "b c", "d"]
    assert tuple(out.first()) == (1, None, None)


def test_unique_columns_of_several_types_are_counted_together(spark, rows):
    spec = TableSpec(tuple(ColumnSpec(n, t, unique=True) for n, t in (("a", "Int"), ("b", "String"), ("c", "Float"), ("d", "Int"))))
    df = spark.createDataFrame([(1, "1", 1.0, 5), (1, "1", 2.0, 5), (2, None, None, 5), (None, None, None, None)], "a int, b string, c double, d int")
    report = validation_report(df, spec)
    assert rows(report.filter("rule = 'unique'"), "column_name", "n_bad") == [("a", 1), ("b", 1), ("c", 0), ("d", 2)]
    assert report._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 2
    with pytest.raises(ValidationError, match="a: repeated"):
        validate(df, spec)
