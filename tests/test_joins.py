import datetime as dt
import itertools

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgermill.functions.scalar import each_day
from ledgermill.operators import joins


def make(spark, prefix, values):
    return spark.createDataFrame([(k, f"{prefix}{i}", i) for i, k in enumerate(values)], f"k int, {prefix} string, n int")


def pandas_rows(a, b, how):
    out = a.toPandas().astype(object).merge(b.toPandas().astype(object), on="k", how=how)
    out = out.astype(object).where(out.notna(), None)
    return sorted((tuple(int(v) if isinstance(v, float) else v for v in r) for r in out.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("how,split", list(itertools.product(joins.JOIN_TYPES, [False, True])))
def test_join_matches_pandas(spark, rows, how, split):
    a = make(spark, "a", [1, 2, 2, None, 4, None])
    b = make(spark, "b", [2, None, 3, 4, 4])
    out = joins.null_safe_join(a, b, ["k"], how, split)
    assert out.columns == ["k", "a", "n_x", "b", "n_y"]
    assert rows(out) == pandas_rows(a, b, how)


def test_two_keys(spark, rows):
    a = spark.createDataFrame([(1, None, "x"), (1, 2, "y")], "k int, j int, a string")
    b = spark.createDataFrame([(1, None, "p"), (1, 3, "q")], "k int, j int, b string")
    assert rows(joins.null_safe_join(a, b, ["k", "j"], "left")) == [(1, 2, "y", None), (1, None, "x", "p")]


def test_key_types_must_agree(spark):
    a = spark.createDataFrame([(1,)], "k int")
    b = spark.createDataFrame([("1",)], "k string")
    with pytest.raises(ValueError, match="Join key"):
        joins.null_safe_join(a, b, ["k"])
    with pytest.raises(ValueError, match="not found"):
        joins.null_safe_join(a, b, ["z"])
    with pytest.raises(ValueError, match="join type"):
        joins.null_safe_join(a, a, ["k"], "cross")


@pytest.mark.parametrize("how", joins.JOIN_TYPES)
def test_row_counts_without_joining(spark, how):
    a, b = make(spark, "a", [1, 2, 2, None, 4, None]), make(spark, "b", [2, None, 3, 4, 4, None])
    got = joins.join_row_counts(a, b, ["k"], how).first()
    assert got["base_rows"] == 6
    assert got["joined_rows"] == joins.null_safe_join(a, b, ["k"], how).count()


def test_guard(spark, rows):
    base = make(spark, "a", [1, 2, 3])
    unique, repeated = make(spark, "b", [1, 2]), make(spark, "b", [1, 1])
    assert joins.join_chain(base, [(unique, ["k"], "left")]).count() == 3
    with pytest.raises(ValueError, match="from 3 to 4"):
        joins.join_chain(base, [(repeated, ["k"], "left")])
    with pytest.raises(ValueError, match="from 3 to 2"):
        joins.join_chain(base, [(unique, ["k"], "inner")])
    assert joins.join_chain(base, [(repeated, ["k"], "left")], row_guard=False).count() == 4
    # a repeated key that the base does not use changes nothing
    assert joins.join_chain(base, [(make(spark, "b", [9, 9]), ["k"], "left")]).count() == 3
    # a step without keys is skipped
    assert joins.join_chain(base, [(repeated, None, "left")]).columns == base.columns


def test_guard_looks_at_the_whole_chain(spark):
    base = make(spark, "a", [1, 2])
    doubling = spark.createDataFrame([(1, "p"), (1, "q"), (2, "r")], "k int, j string")
    halving = spark.createDataFrame([("p", 1), ("r", 1)], "j string, m int")
    out = joins.join_chain(base, [(doubling, ["k"], "left"), (halving, ["j"], "inner")])
    assert out.count() == 2


def test_anti_and_semi(spark, rows):
    a, b = make(spark, "a", [1, 2, None, 3]), make(spark, "b", [2, 2, None])
    assert rows(joins.anti_by_keys(a, b, ["k"]), "k") == [(1,), (3,)]
    assert rows(joins.semi_by_keys(a, b, ["k"]), "k") == [(2,), (None,)]
    codes = spark.createDataFrame([(2,), (None,), (2,)], "code int")
    assert rows(joins.in_codes(a, codes, "k"), "k") == [(2,)]


def test_repeated_keys_counts_nulls_as_equal(spark, rows):
    df = make(spark, "a", [1, None, None, 2])
    assert rows(joins.repeated_keys(df, ["k"])) == [(None, 2)]
    assert joins.has_repeated_keys(df, ["k"])
    assert not joins.has_repeated_keys(make(spark, "a", [1, None]), ["k"])


def test_grid_and_gaps(spark, rows):
    codes = spark.createDataFrame([("a",), ("b",)], "code string")
    days = each_day(dt.date(2024, 2, 28), dt.date(2024, 3, 1))
    grid = joins.request_grid(codes, days, "day")
    assert rows(grid) == [(c, dt.date(2024, m, d)) for c in "ab" for m, d in ((2, 28), (2, 29), (3, 1))]
    landed = spark.createDataFrame([("a", dt.date(2024, 2, 29)), ("x", dt.date(2024, 3, 1))], "code string, day date")
    gaps = joins.coverage_gaps(codes, days, landed, "code", "day")
    assert rows(gaps) == sorted(set(rows(grid)) - {("a", dt.date(2024, 2, 29))}, key=repr)


def test_grid_and_gaps_of_an_axis_table(spark, rows):
    codes = spark.createDataFrame([(c,) for c in "abc"], "code string")
    axis = spark.range(17).select(F.col("id").alias("v"))
    landed = spark.createDataFrame([("a", 3), ("b", 16)], "code string, v bigint")
    grid = sorted(((c, v) for c in "abc" for v in range(17)), key=repr)
    assert rows(joins.request_grid(codes, axis, "v")) == grid
    assert rows(joins.coverage_gaps(codes, axis, landed, "code", "v")) == [g for g in grid if g not in (("a", 3), ("b", 16))]


@pytest.mark.parametrize("n", [10, 6_000])
def test_axis_type_counts_the_same_at_every_length(spark, n):
    codes = spark.createDataFrame([("a",)], "code string")
    landed = spark.createDataFrame([("a", 3)], "code string, v int")
    axis = spark.range(n).select(F.col("id").alias("v"))
    gaps = joins.coverage_gaps(codes, axis, landed, "code", "v")
    assert gaps.schema["v"].dataType == landed.schema["v"].dataType and gaps.count() == n - 1
    with pytest.raises(ValueError, match="axis is string"):
        joins.coverage_gaps(codes, axis.select(F.col("v").cast("string")), landed, "code", "v").count()


def test_empty_axis(spark):
    codes = spark.createDataFrame([("a",)], "code string")
    assert joins.request_grid(codes, spark.range(0).select("id"), "d").count() == 0
    landed = spark.createDataFrame([("a", 3)], "code string, v bigint")
    assert joins.coverage_gaps(codes, spark.range(0).select("id"), landed, "code", "v").count() == 0


def test_gaps_of_values_the_landed_type_cannot_hold(spark, rows):
    codes = spark.createDataFrame([("a",), ("b",), (None,), ("b",)], "code string")
    landed = spark.createDataFrame([("a", 1), ("b", 2), (None, 2), ("x", 1), ("a", None)], "code string, v int")
    axis = spark.createDataFrame([(1.5,), (2.0,), (2.0,), (None,)], "v double")
    gaps = joins.coverage_gaps(codes, axis, landed, "code", "v")
    assert rows(gaps) == sorted([("a", 1.5), ("a", 2.0), ("b", 1.5), (None, 1.5)], key=repr)
    big = spark.createDataFrame([(2**53 + 1,)], "v bigint")
    near = spark.createDataFrame([("a", float(2**53))], "code string, v double")
    assert rows(joins.coverage_gaps(codes.where("code = 'a'"), big, near, "code", "v")) == [("a", 2**53 + 1)]
    noon = spark.createDataFrame([(dt.datetime(2024, 1, 2, 12),), (dt.datetime(2024, 1, 2),)], "d timestamp")
    days = spark.createDataFrame([("a", dt.date(2024, 1, 2))], "code string, d date")
    assert rows(joins.coverage_gaps(codes.where("code = 'a'"), noon, days, "code", "d")) == [("a", dt.datetime(2024, 1, 2, 12))]
    with pytest.raises(Exception, match="cannot hold the axis value"):
        joins.coverage_gaps(codes, big, landed, "code", "v").collect()


def test_gaps_of_codes_of_another_type(spark, rows):
    codes = spark.createDataFrame([(1,), (2,)], "code int")
    landed = spark.createDataFrame([(1, 7), (2**32 + 2, 7), (None, 7)], "code bigint, v int")
    axis = spark.createDataFrame([(7,)], "v int")
    assert rows(joins.coverage_gaps(codes, axis, landed, "code", "v")) == [(2, 7)]
    with pytest.raises(ValueError, match="codes are"):
        joins.coverage_gaps(codes, axis, landed.withColumn("code", F.col("code").cast("string")), "code", "v")


def test_gaps_over_many_words_and_slices(spark, rows, monkeypatch):
    import random

    monkeypatch.setattr(joins, "_NUMBERED_ROWS", 50)
    rng = random.Random(1)
    axis, codes = list(range(0, 900, 3)), ["a", "b", "c"]
    held = {(c, v) for c in codes for v in axis if rng.random() < 0.9}
    landed = spark.createDataFrame([*held, *held, ("z", 3), ("a", 1)], "code string, v bigint").repartition(5)
    frame = spark.createDataFrame([(v,) for v in axis], "v bigint")
    gaps = joins.coverage_gaps(spark.createDataFrame([(c,) for c in codes], "code string"), frame, landed, "code", "v")
    assert rows(gaps) == sorted({(c, v) for c in codes for v in axis} - held, key=repr)


def test_gaps_shuffle_the_landed_rows_once(spark):
    codes = spark.range(5).select(F.col("id").alias("code"))
    landed = spark.range(1000).selectExpr("id % 5 as code", "id as v")
    gaps = joins.coverage_gaps(codes, spark.range(500).select("id"), landed, "code", "v")
    plan = gaps._jdf.queryExecution().sparkPlan().toString()
    executed = gaps._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "SortAggregate" not in plan
    assert executed.count("Exchange hashpartitioning(code") == 1


def test_pandas_agrees_that_nulls_match():
    a, b = pd.DataFrame({"k": [None, 1.0]}), pd.DataFrame({"k": [None, 2.0], "v": [7, 8]})
    assert list(a.merge(b, on="k").v) == [7]
