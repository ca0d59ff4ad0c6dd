"""Plans that must hold at any size, and hot keys."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from ledgermill.checks.catalogue import QUERIES
from ledgermill.operators import combine, filters, joins, merge
from ledgermill.plans.windows import LoadWindow
from ledgermill.sinks import tables


@contextmanager
def settings(spark, **values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_plan_gathers_or_multiplies(spark, sf, name):
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(QUERIES[name](spark, sf))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "Window", "BatchEvalPython", "FlatMapGroups"):
        assert bad not in text
    # a single partition only ever receives pre-aggregated or limited rows
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "partial" in lines[i + 1] or "Limit" in lines[i + 1], text


@pytest.mark.parametrize(
    "name,pushed",
    [
        ("filter_predicate", "GreaterThan(o_totalprice,100000.0)"),
        ("filter_ne_keeps_null", "o_orderstatus"),
        ("filter_date_cut", "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)"),
        ("table_slice", "EqualTo(l_suppkey,3)"),
        ("latest_window", "GreaterThanOrEqual(o_orderdate"),
        ("filter_suffix_any", "StringEndsWith(p_name,gear)"),
    ],
)
def test_filters_reach_the_scan(spark, sf, name, pushed):
    scan = [x for x in plan(QUERIES[name](spark, sf)).splitlines() if "FileScan" in x][0]
    assert pushed in scan


def test_columns_are_pruned(spark, sf):
    for name, wanted in (("scan_project", 3), ("pivot_mean", 3), ("metadata_last_wins", 6)):
        scan = [x for x in plan(QUERIES[name](spark, sf)).splitlines() if "FileScan" in x][0]
        assert scan.split("ReadSchema: struct<")[1].count(":") <= wanted, name


def test_inline_codes_reach_the_scan(spark, sf):
    df = joins.in_codes(spark.read.parquet(f"{sf}/customer.parquet"), [1, 5], "c_custkey")
    assert "In(c_custkey, [1,5])" in plan(df)


HOT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.shuffle.partitions": "8",
}


def hot(spark, n, key, name):
    """A third of the rows hold one key (null here: null keys match null keys and are hot in practice)."""
    rows = spark.range(0, n, 1, 16)
    return rows.select(F.expr(f"if(id % 3 = 0, {key}, id)").alias("k"), F.concat(F.lit(name), F.col("id")).alias(name))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("key", ["null", "7"])
def test_hot_keys_are_split(spark, how, key):
    with settings(spark, **HOT):
        left = hot(spark, 60_000, key, "a")
        right = spark.range(0, 60_000, 2, 16).select(F.expr(f"if(id = 0, {key}, id)").alias("k"), F.col("id").alias("b"))
        right = right.filter("k is null or k <> 7 or b = 0")
        out = joins.null_safe_join(left, right, ["k"], how)
        n = out.count()
        joined = out.select("k", "a", "b")
        joined.collect()
        assert "skew=true" in plan(joined)
        counts = joins.join_row_counts(left, right, ["k"], how).first()
        assert counts["joined_rows"] == n


def test_hot_other_side_of_an_outer_join_is_split(spark, rows):
    with settings(spark, **HOT):
        left = spark.range(0, 3_000, 1, 8).select(F.col("id").alias("k"), F.col("id").alias("a"))
        right = hot(spark, 60_000, "5", "b")
        out = joins.null_safe_join(left, right, ["k"], "left", split_hot=True)
        got = rows(out)
        out.collect()
        assert "skew=true" in plan(out)
        assert got == rows(joins.null_safe_join(left, right, ["k"], "left"))


def test_upsert_splits_a_hot_stored_key(spark):
    with settings(spark, **HOT):
        stored = hot(spark, 60_000, "7", "a")
        new = spark.range(0, 100, 1, 4).select(F.col("id").alias("k"), F.lit("new").alias("a"))
        kept = merge.kept_rows(stored, new, ["k"])
        kept.collect()
        assert "skew=true" in plan(kept)
        assert kept.filter("k = 7").count() == 0


@pytest.mark.parametrize("has_null", [True, False])
def test_insert_splits_a_hot_stored_key(spark, has_null):
    small = dict.fromkeys((k for k in HOT if k.endswith("InBytes")), "3000")  # one repeated key compresses well
    with settings(spark, **{**HOT, **small, "spark.sql.adaptive.forceOptimizeSkewedJoin": "false"}):
        stored = spark.range(0, 400_000, 1, 32).selectExpr("if(id % 3 = 0 or id > 1000, 7, id) as k", "'a' as a")
        new = spark.range(0, 100, 1, 4).select(F.col("id").alias("k"), F.lit("new").alias("a"))
        added = merge.new_rows(stored, new, ["k"], repeated=False, has_null=has_null)
        assert {r["k"] for r in added.collect()} == {k for k in range(100) if k % 3 == 0}
        assert "skew=true" in plan(added)


def test_hot_group_is_reduced_before_the_shuffle(spark):
    """One group holds every row: each task sends one row."""
    df = spark.range(0, 100_000, 1, 8).select(F.lit(1).alias("k"), F.col("id").alias("at"), F.col("id").alias("v"))
    for out in (
        combine.newest_per_key(df, ["k"], ["at"]),
        combine.last_value(df, ["k"], "v", ["at"]),
        joins.repeated_keys(df, ["k"]),
    ):
        assert "partial_" in plan(out)
        assert out.count() == 1


def test_small_delta_leaves_the_stored_table_unshuffled(spark, tmp_path):
    spark.range(0, 50_000, 1, 4).selectExpr("id as k", "cast(id as string) v").write.parquet(str(tmp_path / "t"))
    spark.range(0, 50, 1, 2).selectExpr("id * 3 as k", "'n' as v").write.parquet(str(tmp_path / "d"))
    stored, delta = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "d"))
    kept = plan(merge.kept_rows(stored, delta, ["k"]))
    assert "BroadcastHashJoin" in kept and "Exchange hashpartitioning" not in kept
    added = plan(merge.new_rows(stored, delta, ["k"]))
    stored_branch = [x for x in added.splitlines() if f"{tmp_path}/t" in x]
    assert len(stored_branch) == 1 and "ReadSchema: struct<k:bigint>" in stored_branch[0]
    assert "SortMergeJoin" not in added


def test_touched_partitions_are_the_only_ones_read(spark, tmp_path):
    path = str(tmp_path / "t")
    stored = spark.range(0, 1000, 1, 2).selectExpr("id as k", "cast(id % 10 as int) as p")
    tables.write_table(stored, path, "upsert", ["k", "p"], partition_by=["p"])
    new = spark.createDataFrame([(3, 3), (4, 4)], "k bigint, p int")
    touched = tables._touched(tables.read_table(spark, path), new, ["p"])
    touched.collect()
    assert "PartitionFilters: [p#" in plan(touched) and "IN (" in plan(touched)
    read = {r[0].split("/")[-2] for r in touched.select(F.input_file_name()).distinct().collect()}
    assert read == {"p=3", "p=4"}


def test_window_prunes_a_partitioned_table(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-10')) as Date, 1 as v")
    tables.write_table(days, path, "overwrite", partition_by=["Date"])
    df = LoadWindow(None, None).apply(tables.read_table(spark, path), "Date")
    assert df.count() == 10
    cut = filters.date_cut(tables.read_table(spark, path), "2024-01-09", "Date")
    scan = [x for x in plan(cut).splitlines() if "FileScan" in x][0]
    assert "PartitionFilters: [isnotnull(Date" in scan and cut.count() == 2


def test_partitioned_writes_do_not_make_a_file_per_task(spark, tmp_path):
    path = tmp_path / "t"
    df = spark.range(0, 10_000, 1, 32).selectExpr("id", "cast(id % 4 as int) as p")
    tables.write_table(df, str(path), "overwrite", partition_by=["p"])
    for p in range(4):
        assert len(list((path / f"p={p}").glob("*.parquet"))) <= 2
