import datetime as dt
import math

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions.coerce import enforce_types, not_whole, to_double, to_long, to_spark_type, to_text
from ledgermill.spec import ColumnSpec, TableSpec

NUMBERS = [
    " 12 ", "1e3", "1_000", "0x10", "1,000", "+5", ".5", "5.", "", "nan", "NaN", "None", "true", "1d", "1f", "inf",
    "-inf", "+inf", "INFINITY", "-Infinity", "１２", "1 2", "1e", "e5", "1E+3", "--5", "1e400", "-1e400", "1.0", "1.5",
    "\t7\n", "- 5", "N/A", "1e-400", ".", " ", "+", "1.e3", "00012", "1.5e2", "-0", "9007199254740993",
]


def frame(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def column(df, c):
    return [r[0] for r in df.orderBy("i").select(c).collect()]


def as_pandas(values):
    out = pd.to_numeric(pd.Series([*values, "x"], dtype=object), errors="coerce")[:-1]
    return [None if pd.isna(v) else float(v) for v in out]


def test_double_from_text_matches_pandas(spark):
    assert column(frame(spark, NUMBERS), to_double(F.col("v"), T.StringType())) == as_pandas(NUMBERS)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789.+-eE dfnaNxi", max_size=9), min_size=1, max_size=40))
def test_double_from_any_text_matches_pandas(spark, values):
    got = column(frame(spark, values), to_double(F.col("v"), T.StringType()))
    for value, a, b in zip(values, got, as_pandas(values)):
        assert a == b or (a is not None and b is not None and math.isclose(a, b)), value


def test_long_from_text(spark):
    values = ["123", "abc", "", "456", "1e3", "7.0", "9007199254740993", "9223372036854775807", "1.5", "inf", None]
    want = [123, None, None, 456, 1000, 7, 9007199254740993, 9223372036854775807, None, None, None]
    df = frame(spark, values)
    assert column(df, to_long(F.col("v"), T.StringType())) == want
    flags = column(df, F.coalesce(not_whole(F.col("v"), T.StringType()), F.lit(False)))
    assert [v for v, bad in zip(values, flags) if bad] == ["1.5", "inf"]


def test_numbers_from_floats(spark):
    df = frame(spark, [1.0, 2.5, float("nan"), float("inf"), None, 1e300], "double")
    assert column(df, to_long(F.col("v"), T.DoubleType())) == [1, None, None, None, None, None]
    assert column(df, to_double(F.col("v"), T.DoubleType())) == [1.0, 2.5, None, float("inf"), None, 1e300]


def test_fraction_in_whole_number_column_fails(spark):
    with pytest.raises(Exception, match="not whole"):
        enforce_types(frame(spark, ["1", "1.5"]), {"i": "Int", "v": "Int"}).collect()


def test_null_heavy_frame(spark, rows):
    df = spark.createDataFrame(
        [("123", "1.1", "2023-01-01"), ("abc", "2.2", None), ("", None, "2023-01-03"), ("456", "4.4", "x")],
        "Column1 string, column2 string, column3 string",
    )
    out = enforce_types(df, {"Column1": "Int", "column2": "Float", "column3": "Date"})
    assert [f.dataType for f in out.schema] == [T.LongType(), T.DoubleType(), T.DateType()]
    assert [tuple(r) for r in out.collect()] == [
        (123, 1.1, dt.date(2023, 1, 1)),
        (None, 2.2, None),
        (None, None, dt.date(2023, 1, 3)),
        (456, 4.4, None),
    ]


def test_dates(spark):
    values = ["2024-01-05", "2024-13-01", "2024-01-05 10:00", "n/a", None, "20240105"]
    out = enforce_types(frame(spark, values), {"i": "Int", "v": "Date"})
    assert column(out, "v") == [dt.date(2024, 1, 5), None, None, None, None, None]
    spec = TableSpec((ColumnSpec("i", "Int"), ColumnSpec("v", "Date", format="yyyyMMdd")))
    assert column(enforce_types(frame(spark, values), spec), "v")[-1] == dt.date(2024, 1, 5)
    with pytest.raises(ValueError):
        enforce_types(frame(spark, [1], "int"), {"i": "Int", "v": "Date"})


def test_text_of_floats_matches_pandas(spark):
    values = [1e7, 1e16, 1.5e15, 1e-4, 1e-5, 0.1, 123456789.125, 1e22, -2.5e-7, 1e100, 1.5e16, 0.0, 100.0, 12345.678]
    values += [0.00025, 7654321.5, -98765432.1, float("nan"), float("inf"), -float("inf"), None]
    want = [None if pd.isna(v) else str(v) for v in pd.Series(values, dtype=object)]
    assert column(frame(spark, values, "double"), to_text(F.col("v"), T.DoubleType())) == want


def test_text_of_booleans(spark):
    assert column(frame(spark, [True, False, None], "boolean"), to_text(F.col("v"), T.BooleanType())) == [
        "True",
        "False",
        None,
    ]


def test_undeclared_column(spark):
    with pytest.raises(ValueError, match="No declared type"):
        enforce_types(frame(spark, ["a"]), {"v": "String"})


def test_alignment_turns_bad_values_into_null(spark):
    df = frame(spark, ["1", "bad"])
    assert column(df, to_spark_type(F.col("v"), T.StringType(), T.LongType())) == [1, None]
    assert column(df, to_spark_type(F.col("v"), T.StringType(), T.IntegerType())) == [1, None]


def test_other_types(spark):
    df = frame(spark, ["1", "x", None])
    out = enforce_types(df, {"i": "Int8", "v": "Decimal(10,2)"})
    assert [str(v) for v in column(out, "v")] == ["1.00", "None", "None"]
    assert out.schema["i"].dataType == T.ByteType()
