import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgermill.operators import fill, medians, profile, sparse
from ledgermill.operators.chart import chart_feed
from ledgermill.spec import FillSpec


def numbers(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


@pytest.mark.parametrize(
    "method,want", [("mean", 3.25), ("median", 2.5), ("mode", 2.0), ("min", 2.0), ("max", 6.0), ("sum", 13.0), ("zero", 0.0)]
)
def test_methods(spark, rows, method, want):
    df = numbers(spark, [2.0, 2.0, None, 3.0, 6.0, float("nan")])
    out = fill.fill_nulls(df, {"v": method})
    assert rows(out, "v") == sorted([(2.0,), (2.0,), (3.0,), (6.0,), (want,), (want,)], key=repr)


def test_whole_numbers(spark):
    df = numbers(spark, [1, 2, None], "int")
    assert fill.fill_nulls(df, {"v": "mean"}).schema["v"].dataType.simpleString() == "double"
    assert fill.fill_nulls(df, {"v": "max"}).schema["v"].dataType.simpleString() == "int"
    assert [r.v for r in fill.fill_nulls(df, {"v": "mean"}).orderBy("i").collect()] == [1.0, 2.0, 1.5]


def test_all_missing(spark, rows):
    df = numbers(spark, [None, None])
    assert rows(fill.fill_nulls(df, {"v": "sum"}), "v") == [(0.0,), (0.0,)]
    assert rows(fill.fill_nulls(df, {"v": "max"}), "v") == [(None,), (None,)]
    assert rows(fill.fill_nulls(df, {"v": "median"}), "v") == [(None,), (None,)]
    assert rows(fill.fill_nulls(df, {"v": "mode"}), "v") == [(None,), (None,)]


def test_constants_and_checks(spark, rows):
    df = spark.createDataFrame([("a", None, None), (None, 1, True)], "s string, n int, b boolean")
    out = fill.fill_nulls(df, [FillSpec("s", "CC"), FillSpec("n", 9), FillSpec("b", False), FillSpec("absent", "x")])
    assert rows(out) == [("CC", 1, True), ("a", 9, False)]
    with pytest.raises(ValueError, match="needs one of"):
        fill.fill_nulls(df, {"n": "average"})


def test_mode_takes_the_smallest_on_a_tie(spark):
    assert profile.exact_mode(numbers(spark, [5.0, 3.0, 5.0, 3.0, 1.0]), "v") == 3.0


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.one_of(st.integers(-50, 50), st.integers(-(10**6), 10**6)), min_size=1, max_size=200),
    st.integers(1, 30),
)
def test_median_by_narrowing(spark, values, last):
    """The search ends right also when it must narrow many times and the sketch is crude."""
    got = profile.exact_median(numbers(spark, [float(v) for v in values]), "v", accuracy=max(8, last))
    assert got == statistics.median(values)


def test_median_with_a_hot_value(spark):
    rng = random.Random(7)
    for hot in (0.0, 0.5, 1.0):
        values = [hot] * 1500 + [rng.random() for _ in range(3000)]
        assert profile.exact_median(numbers(spark, values), "v", accuracy=100) == statistics.median(values)
    halves = [1.0] * 1000 + [2.0] * 1000
    assert profile.exact_median(numbers(spark, halves), "v", accuracy=100) == 1.5


@pytest.mark.parametrize("size", [8, 30, 4096])
def test_medians_of_columns_and_groups_together(spark, size):
    rng = random.Random(size)
    data = [(rng.choice(["a", "b", None]) if i % 3 else "hot", rng.choice([None, rng.random(), 0.5, float("nan"), float("inf")]),
             rng.choice([None, rng.randint(-9, 9)]), None if i % 2 else 1e300) for i in range(900)]
    data += [("none", None, None, None), ("one", 7.0, 7, 7.0)]
    df = spark.createDataFrame(data, "g string, x double, `n n` int, v0 double").repartition(5)
    for by in ([], ["g"]):
        got = {tuple(r)[: len(by)]: tuple(r)[len(by):] for r in medians.exact_medians(df, ["x", "n n", "v0"], by, size).collect()}
        for key in {row[: len(by)] for row in data}:
            mine = [row for row in data if row[: len(by)] == key]
            want = []
            for i in (1, 2, 3):
                values = [r[i] for r in mine if r[i] is not None and r[i] == r[i]]
                want.append(statistics.median(values) if values else None)
            assert got[key] == pytest.approx(tuple(want), nan_ok=True), key
        assert len(got) == len({row[: len(by)] for row in data})
    assert medians.exact_medians(df.limit(0), ["x"]).first() in (None, (None,))
    assert medians.exact_medians(df.limit(0), ["x"], ["g"]).count() == 0


def test_statistics_pass_over_the_data_alike_for_any_number_of_columns(spark, tmp_path):
    """Jobs run for two and for twelve columns of each method are as many."""
    path = str(tmp_path / "t")
    spark.range(300).selectExpr(*[f"(id * {i + 3}) % 17 as c{i}" for i in range(24)]).write.parquet(path)
    df, tracker = spark.read.parquet(path), spark.sparkContext.statusTracker()
    jobs = []
    for n in (2, 24):
        spark.sparkContext.setJobGroup(f"statistics-{n}", "")
        methods = {f"c{i}": "median" if i % 2 else "mode" for i in range(n)}
        got = profile.fill_statistics(df, methods)
        jobs.append(len(tracker.getJobIdsForGroup(f"statistics-{n}")))
        assert got == {c: statistics.median(v) if m == "median" else min(statistics.multimode(v))
                       for c, m in methods.items() for v in [[r[0] for r in df.select(c).collect()]]}
        spark.sparkContext.setJobGroup("other", "")
    assert jobs[0] == jobs[1]


def test_approximate_median(spark):
    assert profile.fill_statistics(numbers(spark, [1.0, 2.0, 9.0]), {"v": "median"}, exact=False) == {"v": 2.0}


def test_group_fill(spark, rows):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("a", 3.0), (None, None), (None, 5.0), ("z", None)], "g string, v double"
    )
    out = fill.fill_nulls_by_group(df, ["g"], {"v": "mean"})
    assert rows(out) == [("a", 1.0), ("a", 2.0), ("a", 3.0), ("z", None), (None, 5.0), (None, 5.0)]
    assert ("z", 0.0) in rows(fill.fill_nulls_by_group(df, ["g"], {"v": "zero"}))
    assert ("z", 9.0) in rows(fill.fill_nulls_by_group(df, ["g"], {"v": 9}))
    assert ("a", 2.0) in rows(fill.fill_nulls_by_group(df, ["g"], {"v": "median"}))
    with pytest.raises(ValueError, match="not supported"):
        fill.fill_nulls_by_group(df, ["g"], {"v": "average"})


def test_group_mode_and_text(spark, rows):
    df = spark.createDataFrame(
        [("a", 3, "x"), ("a", 3, None), ("a", 1, "y"), ("a", None, "y"), ("b", 2, None), ("b", 1, None), ("b", None, None)],
        "g string, n int, s string",
    )
    out = fill.fill_nulls_by_group(df, ["g"], {"n": "mode", "s": "none"})
    assert out.schema["n"].dataType.simpleString() == "int"
    assert rows(out) == sorted(
        [("a", 3, "x"), ("a", 3, "none"), ("a", 1, "y"), ("a", 3, "y"), ("b", 2, "none"), ("b", 1, "none"), ("b", 1, "none")],
        key=repr,
    )
    assert ("a", 3, "y") in rows(fill.fill_nulls_by_group(df, ["g"], {"n": "mode", "s": "mode"}))


def test_sparse_columns(spark):
    nan = float("nan")
    data = [(1.0, 1.0, None), (2.0, None, None), (3.0, 3.0, nan), (None, nan, 4.0)]
    df = spark.createDataFrame(data, "A double, B double, C double")
    assert sparse.drop_sparse_columns(df, 0.5).columns == ["A"]
    assert sparse.drop_sparse_columns(df, 0.8).columns == ["A", "B", "C"]
    assert sparse.drop_sparse_columns(df.limit(0), 0.5).columns == ["A", "B", "C"]


def test_null_fractions_and_counts(spark, rows):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x"), (4, "y")], "a int, `b c` string")
    assert rows(profile.null_fractions(df)) == [("a", 0.25), ("b c", 0.5)]
    assert rows(profile.null_fractions(df.limit(0))) == [("a", None), ("b c", None)]
    assert profile.row_count(df).first()["n"] == 4
    assert profile.empty_test(df.filter("a > 9")).first()["is_empty"]
    assert not profile.empty_test(df).first()["is_empty"]


def test_chart_feed(spark, rows):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 30), ("b", 1, 5)], "local_code string, day int, volume int")
    assert rows(chart_feed(df, ["day", "volume"], "volume", code="a")) == [(1, 10, 30), (2, 30, 30)]
    everyone = chart_feed(df, ["local_code", "day"], "volume")
    assert rows(everyone) == [("a", 1, 30), ("a", 2, 30), ("b", 1, 5)]
    assert chart_feed(df, ["day"], "volume", code="zz").count() == 0


def test_sums_of_narrow_integers_widen(spark, rows):
    df = spark.createDataFrame([("a", 100), ("a", 120), ("b", None)], "k string, v tinyint")
    assert rows(fill.fill_values(df, {"v": 220}), "v") == [(100,), (120,), (220,)]
    df = spark.createDataFrame([("a", 2**31 - 1), ("a", 2**31 - 1), ("a", None)], "k string, v int")
    assert (2**32 - 2,) in rows(fill.fill_nulls_by_group(df, ["k"], {"v": "sum"}), "v")


def test_fitted_fill_takes_decimals(spark, rows):
    from decimal import Decimal

    from ledgermill.plans.chain import NullFiller

    df = spark.createDataFrame([(Decimal("1.50"),), (Decimal("3.25"),), (None,)], "v decimal(10,2)")
    filled = NullFiller(fills={"v": "max"}).fit(df).transform(df)
    assert rows(filled, "v").count((Decimal("3.25"),)) == 2
