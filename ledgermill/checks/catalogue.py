"""Every operator as a query over the given tables, next to the SQL that must give the same rows.

Queries call the package's operators; the SQL is written independently of them. Disk queries write into fresh folders of
the shared scratch folder and read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill import schemas
from ledgermill.checks import samples
from ledgermill.functions import scalar
from ledgermill.functions.coerce import enforce_types
from ledgermill.functions.predicates import apply_where
from ledgermill.functions.text import NULL_WORDS, csv_options
from ledgermill.operators import chart, combine, fill, filters, joins, merge, profile, project, reshape, sparse
from ledgermill.operators import filings as filing_ops
from ledgermill.operators import validate as validation
from ledgermill.plans import chain, ingest, windows
from ledgermill.plans.extract import extract
from ledgermill.scratch import scratch_path, write_scratch
from ledgermill.sinks import tables
from ledgermill.sources import archives, envelopes, files, filings, workbooks
from ledgermill.spec import ColumnSpec, ExtractSpec, FillSpec, IngestSpec, JoinSpec, TableRef, TableSpec, TargetSpec
from ledgermill.streaming import upsert as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function name with its oracle SQL."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        ORACLE[fn.__name__] = " ".join(sql.split())
        return fn

    return register


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return files.scan_table(spark, TableRef(path=f"{d}/{name}.parquet"))


def _spread(df: DataFrame) -> DataFrame:
    """A table scan with at least one partition per core, for work that is heavy per row."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _null_every(df: DataFrame, key: str, n: int, column: str):
    return F.when(F.col(key) % n != 0, F.col(column))


# ---- scans and projections -------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def scan_project(spark, d):
    return project.retain(_read(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"])


@query("SELECT s_suppkey AS supplier_id, s_name AS supplier_name FROM supplier")
def rename_project(spark, d):
    spec = TableSpec(
        (ColumnSpec("s_suppkey", "Int", rename="supplier_id"), ColumnSpec("s_name", rename="supplier_name"))
    )
    return project.project_spec(_read(spark, d, "supplier"), spec)


@query("SELECT c_custkey, 'synthetic' AS ingestion_source FROM customer")
def add_ingestion_source(spark, d):
    df = project.with_ingestion_metadata(_read(spark, d, "customer"), "synthetic")
    return project.retain(df, ["c_custkey", "ingestion_source"])


@query("SELECT n_nationkey, 'JP' AS market, 1 AS batch FROM nation")
def constant_columns(spark, d):
    df = project.with_constants(_read(spark, d, "nation"), {"market": "JP", "batch": 1})
    return project.retain(df, ["n_nationkey", "market", "batch"])


@query("SELECT r_regionkey, r_name, CAST(NULL AS DOUBLE) AS r_area FROM region")
def impute_missing_columns(spark, d):
    return project.impute_missing_columns(_read(spark, d, "region"), {"r_name": "String", "r_area": "Float"})


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS mostly_full FROM orders"""
)
def drop_sparse_columns(spark, d):
    df = _read(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("mostly_full"),
        F.when(F.col("o_orderkey") % 2 != 0, F.col("o_custkey")).alias("half_full"),
    )
    return sparse.drop_sparse_columns(df, 0.5)


# ---- filters ---------------------------------------------------------------------------------------------------------


@query(
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderstatus IN ('F','O')"""
)
def filter_predicate(spark, d):
    df = apply_where(_read(spark, d, "orders"), "o_totalprice > 100000 and o_orderstatus in ('F', 'O')")
    return project.retain(df, ["o_orderkey", "o_totalprice"])


@query(
    """WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS st FROM orders)
    SELECT o_orderkey, st FROM t WHERE st IS DISTINCT FROM 'F'"""
)
def filter_ne_keeps_null(spark, d):
    df = _read(spark, d, "orders")
    df = df.select("o_orderkey", _null_every(df, "o_orderkey", 7, "o_orderstatus").alias("st"))
    return apply_where(df, ("st", "!=", "F"))


@query(
    """WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS p,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS st FROM orders)
    SELECT o_orderkey, p, st FROM t
    WHERE NOT coalesce(p > 200000, FALSE) AND (NOT coalesce(st IN ('F', 'O'), FALSE) OR coalesce(p < 50000, FALSE))"""
)
def filter_structured(spark, d):
    df = _read(spark, d, "orders")
    df = df.select(
        "o_orderkey",
        _null_every(df, "o_orderkey", 7, "o_totalprice").alias("p"),
        _null_every(df, "o_orderkey", 5, "o_orderstatus").alias("st"),
    )
    return apply_where(
        df, ("and", ("not", ("p", ">", 200000)), ("or", ("st", "not in", ["F", "O"]), ("p", "<", 50000)))
    )


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'")
def filter_date_cut(spark, d):
    df = filters.date_cut(_read(spark, d, "orders"), "1997-01-01", "o_orderdate")
    return project.retain(df, ["o_orderkey", "o_orderdate"])


@query("SELECT p_partkey, p_type FROM part WHERE regexp_matches(p_type, 'NOM')")
def filter_regex_contains(spark, d):
    return project.retain(filters.matches(_read(spark, d, "part"), "p_type", "NOM"), ["p_partkey", "p_type"])


@query("SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^(?:hot|red)')")
def filter_regex_prefix(spark, d):
    df = filters.matches(_read(spark, d, "part"), "p_name", "hot|red", anchored=True)
    return project.retain(df, ["p_partkey", "p_name"])


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%gear' OR p_name LIKE '%bolt'")
def filter_suffix_any(spark, d):
    df = filters.ends_with_any(_read(spark, d, "part"), "p_name", ["gear", "bolt"])
    return project.retain(df, ["p_partkey", "p_name"])


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'O'
    AND l_partkey IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#3')"""
)
def filter_eq_and_semi(spark, d):
    rows = filters.equals_all(_read(spark, d, "lineitem"), {"l_returnflag": "N", "l_linestatus": "O"})
    codes = filters.equals_all(_read(spark, d, "part"), {"p_brand": "Brand#3"})
    return project.retain(
        joins.in_codes(rows, codes, "l_partkey", "p_partkey"), ["l_orderkey", "l_linenumber", "l_partkey"]
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_suppkey = 3
    AND l_shipdate >= TIMESTAMP '1997-01-01 00:00:00' AND l_shipdate <= TIMESTAMP '1998-12-31 00:00:00'"""
)
def table_slice(spark, d):
    df = filters.table_slice(
        _read(spark, d, "lineitem"),
        "bars",
        code=3,
        date_from="1997-01-01",
        date_to="1998-12-31",
        code_column="l_suppkey",
        date_column="l_shipdate",
    )
    return project.retain(df, ["l_orderkey", "l_linenumber", "l_shipdate"])


@query(
    """SELECT o_orderkey, o_orderdate FROM orders
    WHERE CAST(o_orderdate AS DATE) >= (SELECT CAST(max(o_orderdate) AS DATE) - 30 FROM orders)"""
)
def latest_window(spark, d):
    return project.retain(
        windows.latest_rows(_read(spark, d, "orders"), "o_orderdate", 30), ["o_orderkey", "o_orderdate"]
    )


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (1, 5, 9, 13)")
def code_list_semi(spark, d):
    codes = enforce_types(files.code_list(spark, ["1", "5", "9", "13"]), {"code": "Int"})
    return project.retain(joins.in_codes(_read(spark, d, "customer"), codes, "c_custkey"), ["c_custkey", "c_name"])


# ---- joins -----------------------------------------------------------------------------------------------------------


@query(
    """WITH o AS (SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_custkey END AS k FROM orders),
    c AS (SELECT CASE WHEN c_custkey = 0 THEN NULL ELSE c_custkey END AS k, c_name FROM customer
    WHERE c_custkey = 0 OR c_mktsegment <> 'BUILDING')
    SELECT o.o_orderkey, o.k, c.c_name FROM o LEFT JOIN c ON o.k IS NOT DISTINCT FROM c.k"""
)
def join_left_null_safe(spark, d):
    o = _read(spark, d, "orders").select("o_orderkey", F.expr("if(o_custkey % 5 = 0, null, o_custkey)").alias("k"))
    c = _read(spark, d, "customer").filter("c_custkey = 0 or c_mktsegment <> 'BUILDING'")
    c = c.selectExpr("if(c_custkey = 0, null, c_custkey) as k", "c_name")
    return joins.null_safe_join(o, c, ["k"], "left")


@query(
    """WITH o AS (SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_custkey END AS k FROM orders),
    c AS (SELECT CASE WHEN c_custkey = 0 THEN NULL ELSE c_custkey END AS k, c_name FROM customer
    WHERE c_custkey = 0 OR c_mktsegment <> 'BUILDING')
    SELECT o.o_orderkey, c.k, c.c_name FROM o RIGHT JOIN c ON o.k IS NOT DISTINCT FROM c.k"""
)
def join_right_split(spark, d):
    o = _read(spark, d, "orders").select("o_orderkey", F.expr("if(o_custkey % 5 = 0, null, o_custkey)").alias("k"))
    c = _read(spark, d, "customer").filter("c_custkey = 0 or c_mktsegment <> 'BUILDING'")
    c = c.selectExpr("if(c_custkey = 0, null, c_custkey) as k", "c_name")
    return joins.null_safe_join(o, c, ["k"], "right", split_hot=True)


@query(
    """WITH a AS (SELECT n_nationkey AS k, n_name AS nm FROM nation WHERE n_regionkey <= 2),
    b AS (SELECT n_nationkey AS k, upper(n_name) AS nm FROM nation WHERE n_regionkey >= 2)
    SELECT coalesce(a.k, b.k) AS k, a.nm AS nm_x, b.nm AS nm_y FROM a FULL JOIN b ON a.k IS NOT DISTINCT FROM b.k"""
)
def join_outer_suffix(spark, d):
    n = _read(spark, d, "nation")
    a = n.filter("n_regionkey <= 2").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("nm"))
    b = n.filter("n_regionkey >= 2").select(F.col("n_nationkey").alias("k"), F.upper("n_name").alias("nm"))
    return joins.null_safe_join(a, b, ["k"], "outer")


@query(
    """SELECT l.l_orderkey, l.l_linenumber, o.o_orderdate, c.c_mktsegment FROM lineitem l
    LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey"""
)
def join_chain(spark, d):
    o = _read(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    c = _read(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    df = joins.join_chain(
        _read(spark, d, "lineitem"), [(o, ["l_orderkey"], "left"), (c, ["o_custkey"], "left")], row_guard=True
    )
    return project.retain(df, ["l_orderkey", "l_linenumber", "o_orderdate", "c_mktsegment"])


@query(
    """SELECT (SELECT count(*) FROM nation) AS base_rows,
    (SELECT count(*) FROM nation n LEFT JOIN supplier s ON n.n_nationkey = s.s_nationkey) AS joined_rows"""
)
def join_guard_report(spark, d):
    n = _read(spark, d, "nation").select(F.col("n_nationkey").alias("k"))
    s = _read(spark, d, "supplier").select(F.col("s_nationkey").alias("k"))
    return joins.join_row_counts(n, s, ["k"], "left")


@query(
    """SELECT (SELECT count(*) FROM orders) AS base_rows,
    (SELECT count(*) FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey) AS joined_rows"""
)
def guard_counts_frames(spark, d):
    o = _read(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    c = _read(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    return joins.guard_report(o, joins.null_safe_join(o, c, ["k"], "inner"))


@query(
    """SELECT n_nationkey, d.day_no FROM nation
    CROSS JOIN (SELECT DISTINCT l_linenumber AS day_no FROM lineitem) d"""
)
def join_cross_requests(spark, d):
    codes = _read(spark, d, "nation").select("n_nationkey")
    return joins.request_grid(codes, _read(spark, d, "lineitem").select("l_linenumber"), "day_no")


@query(
    """SELECT c_custkey AS code, CAST(range AS DATE) AS day FROM customer
    CROSS JOIN range(DATE '2024-01-01', DATE '2024-02-01', INTERVAL 1 DAY)"""
)
def request_days(spark, d):
    import datetime as dt

    codes = _read(spark, d, "customer").select(F.col("c_custkey").alias("code"))
    return joins.request_grid(codes, scalar.each_day(dt.date(2024, 1, 1), dt.date(2024, 1, 31)), "day")


@query(
    """WITH g AS (SELECT c_custkey FROM customer), t AS (SELECT DISTINCT o_orderstatus AS st FROM orders)
    SELECT g.c_custkey, t.st FROM g CROSS JOIN t WHERE NOT EXISTS
    (SELECT 1 FROM orders o WHERE o.o_custkey = g.c_custkey AND o.o_orderstatus = t.st)"""
)
def coverage_gaps(spark, d):
    landed = _read(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("st"))
    return joins.coverage_gaps(
        _read(spark, d, "customer").select("c_custkey"), landed.select("st"), landed, "c_custkey", "st"
    )


@query(
    """WITH a AS (SELECT DISTINCT CAST(l_linenumber AS DOUBLE) / 2 AS step FROM lineitem)
    SELECT s.s_suppkey, a.step FROM supplier s CROSS JOIN a WHERE NOT EXISTS (SELECT 1 FROM lineitem l
    WHERE l.l_suppkey = s.s_suppkey AND l.l_linenumber = a.step AND l.l_partkey % 3 = 0)"""
)
def coverage_gaps_fractions(spark, d):
    """An axis of doubles against a whole-number column: halves are missing everywhere."""
    lines = _read(spark, d, "lineitem")
    landed = lines.where("l_partkey % 3 = 0").select(F.col("l_suppkey").alias("s_suppkey"), F.col("l_linenumber").alias("step"))
    axis = lines.select((F.col("l_linenumber").cast("double") / 2).alias("step"))
    return joins.coverage_gaps(_read(spark, d, "supplier").select("s_suppkey"), axis, landed, "s_suppkey", "step")


# ---- statistics and fills --------------------------------------------------------------------------------------------


@query(
    """WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS v FROM orders),
    s AS (SELECT avg(v) AS a, median(v) AS m, min(v) AS lo, max(v) AS hi, sum(v) AS su FROM t)
    SELECT o_orderkey, round(coalesce(CAST(v AS DOUBLE), a), 4) AS f_mean, coalesce(CAST(v AS DOUBLE), m) AS f_median,
    coalesce(v, lo) AS f_min, coalesce(v, hi) AS f_max, coalesce(CAST(v AS BIGINT), CAST(su AS BIGINT)) AS f_sum,
    coalesce(v, 0) AS f_zero FROM t CROSS JOIN s"""
)
def fill_statistics(spark, d):
    df = _read(spark, d, "orders")
    methods = {f"f_{m}": m for m in ("mean", "median", "min", "max", "sum", "zero")}
    df = df.select("o_orderkey", *[_null_every(df, "o_orderkey", 7, "o_custkey").alias(c) for c in methods])
    return fill.fill_nulls(df, methods).withColumn("f_mean", F.round("f_mean", 4))


@query(
    """WITH t AS (SELECT l_orderkey, l_linenumber,
    CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS v FROM lineitem),
    m AS (SELECT v AS mv FROM (SELECT v, count(*) AS n FROM t WHERE v IS NOT NULL GROUP BY v) g
    ORDER BY n DESC, v ASC LIMIT 1)
    SELECT l_orderkey, l_linenumber, coalesce(v, mv) AS v FROM t CROSS JOIN m"""
)
def fill_mode(spark, d):
    df = _read(spark, d, "lineitem")
    v = F.when(F.col("l_orderkey") % 9 != 0, F.col("l_quantity").cast("bigint")).alias("v")
    return fill.fill_nulls(df.select("l_orderkey", "l_linenumber", v), {"v": "mode"})


@query(
    """SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END, 'Unknown') AS st
    FROM orders"""
)
def fill_constant(spark, d):
    df = _read(spark, d, "orders")
    df = df.select("o_orderkey", _null_every(df, "o_orderkey", 7, "o_orderstatus").alias("st"))
    return fill.fill_nulls(df, {"st": "Unknown"})


@query(
    """WITH t AS (SELECT l_orderkey, l_linenumber, l_suppkey,
    CASE WHEN l_orderkey % 6 = 0 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS v FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_suppkey,
    round(coalesce(CAST(v AS DOUBLE), avg(v) OVER (PARTITION BY l_suppkey)), 4) AS v FROM t"""
)
def fill_group_mean(spark, d):
    df = _read(spark, d, "lineitem")
    v = F.when(F.col("l_orderkey") % 6 != 0, F.col("l_quantity").cast("bigint")).alias("v")
    out = fill.fill_nulls_by_group(df.select("l_orderkey", "l_linenumber", "l_suppkey", v), ["l_suppkey"], {"v": "mean"})
    return out.withColumn("v", F.round("v", 4))


@query(
    """WITH t AS (SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_orderkey % 6 <> 0 THEN CAST(l_quantity AS BIGINT) END AS q,
    CASE WHEN l_orderkey % 5 <> 0 THEN l_extendedprice END AS p FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_suppkey, coalesce(CAST(q AS DOUBLE), median(q) OVER (PARTITION BY l_suppkey)) AS q,
    round(coalesce(p, median(p) OVER (PARTITION BY l_suppkey)), 4) AS p FROM t"""
)
def fill_group_median(spark, d):
    df = _read(spark, d, "lineitem")
    q = F.when(F.col("l_orderkey") % 6 != 0, F.col("l_quantity").cast("bigint")).alias("q")
    p = F.when(F.col("l_orderkey") % 5 != 0, F.col("l_extendedprice")).alias("p")
    df = df.select("l_orderkey", "l_linenumber", "l_suppkey", q, p)
    return fill.fill_nulls_by_group(df, ["l_suppkey"], {"q": "median", "p": "median"}).withColumn("p", F.round("p", 4))


@query(
    """WITH t AS (SELECT event_id, user_id, CASE WHEN value < 5 THEN NULL ELSE event_type END AS kind FROM events),
    m AS (SELECT user_id, kind AS top FROM (SELECT user_id, kind, row_number() OVER
    (PARTITION BY user_id ORDER BY count(*) DESC, kind) AS rn FROM t WHERE kind IS NOT NULL GROUP BY user_id, kind) g
    WHERE rn = 1)
    SELECT event_id, t.user_id, coalesce(kind, top) AS kind FROM t LEFT JOIN m ON t.user_id = m.user_id"""
)
def fill_group_mode(spark, d):
    df = _read(spark, d, "events").selectExpr(
        "event_id", "user_id", "if(value < 5, null, event_type) as kind"
    )
    return fill.fill_nulls_by_group(df, ["user_id"], {"kind": "mode"})


@query(
    """SELECT 'st' AS column_name,
    round(CAST(sum(CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 6) AS null_frac FROM orders"""
)
def null_fraction(spark, d):
    df = _read(spark, d, "orders")
    df = df.select(_null_every(df, "o_orderkey", 7, "o_orderstatus").alias("st"))
    return profile.null_fractions(df).withColumn("null_frac", F.round("null_frac", 6))


@query("SELECT count(*) AS n FROM lineitem")
def row_count(spark, d):
    return profile.row_count(_read(spark, d, "lineitem"))


@query("SELECT count(*) = 0 AS is_empty FROM orders WHERE o_totalprice < 0")
def empty_test(spark, d):
    return profile.empty_test(_read(spark, d, "orders").filter("o_totalprice < 0"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END IS NULL AS is_missing
    FROM orders"""
)
def null_test(spark, d):
    df = _read(spark, d, "orders")
    return df.select("o_orderkey", scalar.is_missing(_null_every(df, "o_orderkey", 7, "o_orderstatus")).alias("is_missing"))


# ---- coercion and validation -----------------------------------------------------------------------------------------


@query(
    """SELECT event_id, TRY_CAST(CASE WHEN event_id % 10 = 0 THEN 'bad' ELSE CAST(user_id AS VARCHAR(20)) END AS DOUBLE)
    AS v FROM events"""
)
def coerce_float(spark, d):
    v = F.expr("if(event_id % 10 = 0, 'bad', cast(user_id as string))").alias("v")
    return enforce_types(_read(spark, d, "events").select("event_id", v), {"event_id": "Int", "v": "Float"})


@query(
    """SELECT event_id, TRY_CAST(CASE WHEN event_id % 10 = 0 THEN '' ELSE CAST(user_id AS VARCHAR(20)) END AS BIGINT)
    AS v FROM events"""
)
def coerce_int(spark, d):
    v = F.expr("if(event_id % 10 = 0, '', cast(user_id as string))").alias("v")
    return enforce_types(_read(spark, d, "events").select("event_id", v), {"event_id": "Int", "v": "Int"})


@query(
    """SELECT event_id, TRY_CAST(CASE WHEN event_id % 10 = 0 THEN 'n/a'
    ELSE '2024-01-' || CAST(10 + event_id % 20 AS VARCHAR(2)) END AS DATE) AS d FROM events"""
)
def coerce_date(spark, d):
    v = F.expr("if(event_id % 10 = 0, 'n/a', '2024-01-' || cast(10 + event_id % 20 as string))").alias("d")
    return enforce_types(_read(spark, d, "events").select("event_id", v), {"event_id": "Int", "d": "Date"})


@query(
    """SELECT event_id, TRY_CAST(CASE WHEN event_id % 10 = 0 THEN 'x' ELSE '2024-01-05 10:00:00' END AS TIMESTAMP) AS t
    FROM events"""
)
def coerce_timestamp(spark, d):
    v = F.expr("if(event_id % 10 = 0, 'x', '2024-01-05 10:00:00')").alias("t")
    return enforce_types(_read(spark, d, "events").select("event_id", v), {"event_id": "Int", "t": "Datetime"})


@query(
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR(20)) AS s,
    TRY_CAST(CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'x' END AS BOOLEAN) AS b FROM orders"""
)
def coerce_string(spark, d):
    df = _read(spark, d, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("s"), F.expr("if(o_orderkey % 2 = 0, 'true', 'x')").alias("b")
    )
    return enforce_types(df, {"o_orderkey": "Int", "s": "String", "b": "Bool"})


@query(
    """SELECT 'o_custkey' AS column_name, 'unique' AS rule, CAST(count(*) - count(DISTINCT o_custkey) AS BIGINT) AS n_bad
    FROM orders UNION ALL SELECT 'o_orderstatus', 'nullable',
    CAST(sum(CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END) AS BIGINT) FROM orders"""
)
def validate_report(spark, d):
    df = _read(spark, d, "orders")
    df = df.withColumn("o_orderstatus", _null_every(df, "o_orderkey", 7, "o_orderstatus"))
    spec = TableSpec((ColumnSpec("o_custkey", "Int", unique=True), ColumnSpec("o_orderstatus", nullable=False)))
    return validation.validation_report(df, spec)


@query(
    """SELECT CAST(c_custkey AS VARCHAR(20)) AS code, TRY_CAST(c_acctbal AS DOUBLE) AS balance FROM customer"""
)
def validate_frame(spark, d):
    spec = TableSpec(
        (
            ColumnSpec("c_custkey", "String", nullable=False, unique=True, rename="code"),
            ColumnSpec("c_acctbal", "Float", rename="balance"),
        )
    )
    return validation.validate(_read(spark, d, "customer"), spec)


# ---- scalar functions ------------------------------------------------------------------------------------------------


@query(
    """SELECT o_orderkey, replace(substr(CAST(100000 + o_custkey AS VARCHAR(10)), 1, 4) || '.T', '.T', '0') AS code
    FROM orders"""
)
def code_normalise(spark, d):
    code = F.expr("cast(100000 + o_custkey as string)")
    return _read(spark, d, "orders").select(
        "o_orderkey", scalar.stored_ticker(scalar.exchange_ticker(code)).alias("code")
    )


@query(
    """SELECT o_orderkey, CAST(o_orderdate - INTERVAL '1' MONTH AS DATE) AS m1, CAST(o_orderdate AS DATE) - 30 AS d30
    FROM orders"""
)
def date_arithmetic(spark, d):
    date = F.col("o_orderdate")
    return _read(spark, d, "orders").select(
        "o_orderkey", scalar.months_before(date, 1).alias("m1"), scalar.days_before(date, 30).alias("d30")
    )


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d, CAST(o_orderdate AS DATE) AS parsed FROM orders")
def date_text(spark, d):
    text = scalar.date_text(F.col("o_orderdate"))
    return _read(spark, d, "orders").select("o_orderkey", text.alias("d"), scalar.parse_date(text).alias("parsed"))


# ---- reshape and combine ---------------------------------------------------------------------------------------------


@query(
    """SELECT l_suppkey, round(avg(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) END), 4) AS A,
    round(avg(CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT) END), 4) AS N,
    round(avg(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) END), 4) AS R
    FROM lineitem GROUP BY l_suppkey"""
)
def pivot_mean(spark, d):
    df = _read(spark, d, "lineitem").select("l_suppkey", "l_returnflag", F.col("l_quantity").cast("bigint").alias("v"))
    wide = reshape.pivot_mean(df, ["l_suppkey"], "l_returnflag", "v", ["A", "N", "R"])
    return wide.select("l_suppkey", *[F.round(c, 4).alias(c) for c in "ANR"])


@query(
    """SELECT o_orderkey, max(CASE WHEN item = 'price' THEN v END) AS price, max(CASE WHEN item = 'cust' THEN v END)
    AS cust FROM (SELECT o_orderkey, 'price' AS item, o_totalprice AS v FROM orders
    UNION ALL SELECT o_orderkey, 'cust', CAST(o_custkey AS DOUBLE) FROM orders) u GROUP BY o_orderkey"""
)
def transpose_statement(spark, d):
    df = _read(spark, d, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_custkey").cast("double").alias("cust")
    )
    long = reshape.unpivot(df, ["o_orderkey"], ["price", "cust"], "item", "v")
    return reshape.items_to_columns(long, ["o_orderkey"], "item", "v", ["price", "cust"])


@query(
    """SELECT DATE '2023-03-31' AS date, CAST(o_orderkey AS VARCHAR) AS ticker, o_totalprice AS "Total Revenue",
    CAST(o_custkey AS DOUBLE) AS "Net Income" FROM orders
    UNION ALL SELECT DATE '2024-03-31', CAST(o_orderkey AS VARCHAR), 0.5 * o_totalprice,
    CAST(2 * o_custkey AS DOUBLE) FROM orders"""
)
def statement_matrix(spark, d):
    row = F.struct
    df = _read(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("ticker"),
        F.inline(
            F.array(
                row(
                    F.lit("Total Revenue").alias("item"),
                    F.col("o_totalprice").alias("2023-03-31"),
                    (F.lit(0.5) * F.col("o_totalprice")).alias("2024-03-31"),
                ),
                row(
                    F.lit("Net Income").alias("item"),
                    F.col("o_custkey").cast("double").alias("2023-03-31"),
                    (F.col("o_custkey") * 2).cast("double").alias("2024-03-31"),
                ),
            )
        ),
    )
    return reshape.statements_to_rows(df, ["Total Revenue", "Net Income"])


@query(
    """SELECT event_id, get_k AS k FROM
    (SELECT event_id, CAST(regexp_replace(props, '[^0-9]', '', 'g') AS BIGINT) AS get_k FROM events) t"""
)
def kv_to_row(spark, d):
    entries = F.from_json("props", "map<string,string>")
    return reshape.map_to_row(_read(spark, d, "events"), ["event_id"], entries, {"k": "bigint"})


@query(
    """SELECT event_id, event_type AS kind, regexp_replace(props, '[^0-9]', '', 'g') AS k FROM events"""
)
def kv_pairs_to_row(spark, d):
    pairs = _read(spark, d, "events").select(
        "event_id",
        F.explode(
            F.map_concat(
                F.from_json("props", "map<string,string>"), F.create_map(F.lit("kind"), F.col("event_type"))
            )
        ),
    )
    return reshape.pairs_to_row(pairs, ["event_id"], "key", "value", ["kind", "k"])


@query(
    """SELECT l_orderkey, l_linenumber, 'discount' AS field, l_discount AS v FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 'tax', CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE l_tax END
    FROM lineitem WHERE l_orderkey % 4 <> 0"""
)
def stack_wide_to_long(spark, d):
    df = _read(spark, d, "lineitem")
    df = df.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_discount").alias("discount"),
        _null_every(df, "l_orderkey", 4, "l_tax").alias("tax"),
    )
    return reshape.stack_columns(df, ["l_orderkey", "l_linenumber"], ["discount", "tax"])


@query(
    """SELECT CAST(o_orderdate AS DATE) AS date, '1301.T' AS ticker, o_totalprice AS "Open", CAST(NULL AS DOUBLE) AS "High"
    FROM orders WHERE o_orderkey % 3 <> 0
    UNION ALL SELECT CAST(o_orderdate AS DATE), '1305.T', CAST(o_custkey AS DOUBLE), 2.0 * o_totalprice FROM orders"""
)
def wide_prices(spark, d):
    df = _read(spark, d, "orders")
    wide = df.select(
        F.col("o_orderdate").cast("date").alias("Date"),
        _null_every(df, "o_orderkey", 3, "o_totalprice").alias("1301.T|Open"),
        F.col("o_custkey").alias("1305.T|Open"),
        (F.lit(2.0) * F.col("o_totalprice")).alias("1305.T|High"),
    )
    return reshape.prices_to_rows(wide, ["1301.T", "1305.T"], ["Open", "High"])


@query(
    """SELECT CAST(ts AS DATE) AS date, user_id AS ticker, value AS amount FROM events WHERE event_type = 'purchase'"""
)
def series_to_rows(spark, d):
    df = filters.equals_all(_read(spark, d, "events"), {"event_type": "purchase"})
    df = df.select(F.col("user_id").alias("ticker"), F.create_map(F.col("ts").cast("date"), F.col("value")).alias("series"))
    return reshape.series_to_rows(df, "ticker", "series", amount="amount")


@query(
    """SELECT c_custkey AS id, c_acctbal AS bal, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_acctbal, CAST(NULL AS VARCHAR(20)) FROM supplier"""
)
def union_by_name(spark, d):
    c = _read(spark, d, "customer").selectExpr("c_custkey as id", "c_acctbal as bal", "c_mktsegment as segment")
    s = _read(spark, d, "supplier").selectExpr("s_acctbal as bal", "s_suppkey as id")
    return combine.union_parts([c, s])


@query("SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows(spark, d):
    return combine.distinct_rows(_read(spark, d, "events"), ["user_id", "event_type"])


@query("SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return joins.repeated_keys(_read(spark, d, "lineitem"), ["l_orderkey"])


@query(
    """SELECT l_orderkey, flag AS last_flag FROM (SELECT l_orderkey, l_returnflag AS flag, row_number() OVER
    (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn
    FROM lineitem) t WHERE rn = 1"""
)
def metadata_last_wins(spark, d):
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]
    return combine.last_value(_read(spark, d, "lineitem"), ["l_orderkey"], "l_returnflag", order, "last_flag")


@query(
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) t WHERE rn = 1"""
)
def newest_per_key(spark, d):
    rows = combine.newest_per_key(_read(spark, d, "events"), ["user_id"], ["ts", "event_id"])
    return project.retain(rows, ["user_id", "event_id", "event_type", "value"])


@query(
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_quantity,
    max(l_quantity) OVER (PARTITION BY l_suppkey) AS axis_max FROM lineitem WHERE l_suppkey = 3"""
)
def chart_feed(spark, d):
    return _chart(spark, d, 3)


@query(
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_quantity,
    max(l_quantity) OVER (PARTITION BY l_suppkey) AS axis_max FROM lineitem"""
)
def chart_feed_all(spark, d):
    return _chart(spark, d, None)


def _chart(spark, d, code):
    columns = ["l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_quantity"]
    return chart.chart_feed(_read(spark, d, "lineitem"), columns, "l_quantity", "l_suppkey", code)


# ---- write modes -----------------------------------------------------------------------------------------------------

_E_N = """WITH e AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'),
    n AS (SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00') """
_INCREMENTAL = _E_N + """SELECT * FROM e UNION ALL SELECT * FROM n
    WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.o_orderkey = n.o_orderkey)"""
_UPSERT = _E_N + """SELECT * FROM e WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.o_orderkey = e.o_orderkey)
    UNION ALL SELECT * FROM n"""


def _halves(df):
    """A stored table up to 1999 and a later delivery from 1998 on: between them every row, with two years in both."""
    stored = filters.date_between(df, "o_orderdate", None, "1999-12-31")
    return stored, filters.date_cut(df, "1998-01-01", "o_orderdate")


def _stored_and_new(spark, d):
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    stored, new = _halves(_read(spark, d, "orders"))
    return stored.select(*columns), new.withColumn("o_orderstatus", F.lit("X")).select(*columns)


def _merged(spark, d, mode):
    stored, new = _stored_and_new(spark, d)
    return merge.merge(stored, new, ["o_orderkey"], mode)


@query(_E_N + "SELECT * FROM n")
def write_overwrite(spark, d):
    return _merged(spark, d, "overwrite")


@query(_E_N + "SELECT * FROM e UNION ALL SELECT * FROM n")
def write_append(spark, d):
    return _merged(spark, d, "append")


@query(_INCREMENTAL)
def write_incremental(spark, d):
    return _merged(spark, d, "incremental")


@query(_UPSERT)
def write_upsert(spark, d):
    return _merged(spark, d, "upsert")


_EVOLVE = """WITH e AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'),
    n AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00')
    SELECT o_orderkey, o_orderstatus, CAST(NULL AS DOUBLE) AS o_totalprice FROM e
    WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.o_orderkey = e.o_orderkey)
    UNION ALL SELECT o_orderkey, CAST(NULL AS VARCHAR(10)), o_totalprice FROM n"""


@query(_EVOLVE)
def write_upsert_evolve(spark, d):
    stored, new = _stored_and_new(spark, d)
    return merge.merge(stored.drop("o_totalprice"), new.drop("o_orderstatus"), ["o_orderkey"], "upsert", evolve=True)


@query(
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR(20)) AS o_custkey FROM orders
    WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'
    UNION ALL SELECT o_orderkey, 'C' || CAST(o_custkey AS VARCHAR(20)) FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'"""
)
def write_type_align(spark, d):
    stored, new = _halves(_read(spark, d, "orders"))
    new = new.withColumn("o_custkey", F.expr("'C' || cast(o_custkey as string)"))
    return merge.merge(*[x.select("o_orderkey", "o_custkey") for x in (stored, new)], mode="append")


@query(
    """SELECT 'v' AS column_name, CAST(sum(CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_lost
    FROM orders"""
)
def align_losses(spark, d):
    orders = _read(spark, d, "orders")
    stored = orders.select("o_orderkey", F.expr("if(o_orderkey % 10 = 0, 'bad', '7')").alias("v"))
    return merge.misaligned_counts(stored, orders.selectExpr("o_orderkey", "o_custkey as v"))


def _disk(spark, d, mode, fmt="parquet", by=()):
    stored, new = _halves(_read(spark, d, "orders").withColumn("year", F.year("o_orderdate")))
    new = new.withColumn("o_orderstatus", F.lit("X"))
    path, keys = scratch_path(spark, "table"), ["o_orderkey", *by]
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    tables.write_table(stored.select(*columns, *by), path, "overwrite", keys, fmt, by)
    tables.write_table(new.select(*columns, *by), path, mode, keys, fmt, by)
    return tables.read_table(spark, path, fmt).select(*columns)


@query(_UPSERT)
def table_upsert(spark, d):
    return _disk(spark, d, "upsert")


@query(_UPSERT)
def table_upsert_partitions(spark, d):
    return _disk(spark, d, "upsert", by=["year"])


@query(_INCREMENTAL)
def table_incremental(spark, d):
    return _disk(spark, d, "incremental")


@query(_UPSERT)
def table_upsert_csv(spark, d):
    return _disk(spark, d, "upsert", "csv")


@query(
    """SELECT o_orderkey, o_orderstatus, CAST(NULL AS DOUBLE) AS o_totalprice FROM orders
    WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'
    UNION ALL SELECT o_orderkey, CAST(NULL AS VARCHAR(10)), o_totalprice FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'"""
)
def table_append_evolve(spark, d):
    stored, new = _stored_and_new(spark, d)
    path = scratch_path(spark, "table")
    tables.write_table(stored.drop("o_totalprice"), path)
    tables.write_table(new.drop("o_orderstatus"), path, "append", evolve=True)
    return tables.read_table(spark, path)


# ---- files -----------------------------------------------------------------------------------------------------------


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def csv_roundtrip(spark, d):
    path = scratch_path(spark, "csv")
    tables.write_table(_read(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), path, fmt="csv")
    spec = TableSpec((ColumnSpec("c_custkey", "Int"), ColumnSpec("c_name"), ColumnSpec("c_mktsegment")))
    return files.scan_csv(spark, path, spec)


#: Null words as SQL, for files of others.
_NULL_WORDS = ", ".join("'" + w + "'" for w in NULL_WORDS)


@query(f"""SELECT doc_id, CASE WHEN text NOT IN ({_NULL_WORDS}) THEN text END AS text, lang, doc_id % 2 = 0 AS even FROM documents""")
def csv_multiline_split(spark, d):
    """Files of another writer: quoted line breaks as they are, truth values as text, no types given."""
    path = scratch_path(spark, "foreign-csv")
    even = (F.col("doc_id") % 2 == 0).alias("even")
    _read(spark, d, "documents").select("doc_id", "text", "lang", even).write.options(**csv_options()).csv(path)
    return files.scan_csv(spark, path)


@query(
    r"""SELECT doc_id, lang, CASE doc_id % 8 WHEN 0 THEN '' WHEN 1 THEN 'NA' WHEN 2 THEN 'null' WHEN 3 THEN NULL
    WHEN 4 THEN repeat(' ', 2) || text || chr(10) WHEN 5 THEN '\N' || chr(13) || '\\n' || text || '\' ELSE text END AS text
    FROM documents"""
)
def csv_text_roundtrip(spark, d):
    text = F.col("text")
    forms = ["", "NA", "null", None, F.concat(F.lit("  "), text, F.lit("\n")),
             F.concat(F.lit("\\N\r\\\\n"), text, F.lit("\\"))]
    spelled = text
    for i, form in enumerate(forms):
        spelled = F.when(F.col("doc_id") % 8 == i, form if form is None or not isinstance(form, str) else F.lit(form)).otherwise(spelled)
    path = scratch_path(spark, "csv-text")
    docs = _read(spark, d, "documents").select("doc_id", "lang", spelled.alias("text"))
    tables.write_table(docs.where("doc_id % 3 = 0"), path, fmt="csv")
    tables.write_table(docs.where("doc_id % 3 <> 0"), path, "append", fmt="csv")
    return tables.read_table(spark, path, "csv")


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def parquet_roundtrip(spark, d):
    path = scratch_path(spark, "parquet")
    tables.write_table(_read(spark, d, "nation"), path, compression="zstd", partition_by=["n_regionkey"])
    return files.scan_table(spark, TableRef(path=path, fmt="parquet"))


@query(
    """SELECT n_nationkey AS id, n_name AS name, n_regionkey AS parent FROM nation
    UNION ALL SELECT r_regionkey, r_name, CAST(NULL AS INTEGER) FROM region"""
)
def dir_scan_union(spark, d):
    path = scratch_path(spark, "folder")
    parts = [
        _read(spark, d, "nation").selectExpr("n_nationkey as id", "n_name as name", "n_regionkey as parent"),
        _read(spark, d, "region").selectExpr("r_name as name", "r_regionkey as id"),
    ]
    for part in parts:
        part.write.mode("append").options(**csv_options()).csv(path)
    spec = TableSpec((ColumnSpec("id", "Int32"), ColumnSpec("name"), ColumnSpec("parent", "Int32")))
    return files.load_flat_files(spark, path, load_all=True, spec=spec)


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS "Code", strftime(o_orderdate, '%Y-%m-%d') AS "Date", o_totalprice AS "C"
    FROM orders UNION ALL SELECT CAST(o_custkey AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d'), 0.5 * o_totalprice
    FROM orders WHERE o_orderstatus = 'F'"""
)
def scan_json_envelope(spark, d):
    path = scratch_path(spark, "envelopes")
    date, price = scalar.date_text(F.col("o_orderdate")), F.col("o_totalprice")
    first = F.struct(F.col("o_orderkey").cast("string").alias("Code"), date.alias("Date"), price.alias("C"))
    second = F.struct(
        F.col("o_custkey").cast("string").alias("Code"), date.alias("Date"), (F.lit(0.5) * price).alias("C")
    )
    records = F.when(F.col("o_orderstatus") == "F", F.array(first, second)).otherwise(F.array(first))
    samples.land_envelopes(_read(spark, d, "orders"), path, records)
    record = T.StructType().add("Code", "string").add("Date", "string").add("C", "double")
    return envelopes.scan_envelopes(spark, path, record, multiline=False)


def _land_filing_index(spark, d):
    path = scratch_path(spark, "index")
    entry = F.struct(
        F.col("o_orderkey").cast("string").alias("docID"),
        F.col("o_custkey").cast("string").alias("secCode"),
        F.lit("010").alias("ordinanceCode"),
        F.expr("if(o_orderpriority <> '1-URGENT', '030000', '030001')").alias("formCode"),
    )
    results = F.when(F.col("o_orderpriority") != "5-LOW", F.array(entry))
    samples.land_envelopes(_read(spark, d, "orders"), path, results, "results")
    return envelopes.scan_filing_index(spark, path, multiline=False)


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS "docID", CAST(o_custkey AS VARCHAR) AS "secCode",
    CASE WHEN o_orderpriority <> '1-URGENT' THEN '030000' ELSE '030001' END AS "formCode" FROM orders
    WHERE o_orderpriority <> '5-LOW'"""
)
def scan_filing_index(spark, d):
    return _land_filing_index(spark, d).select("docID", "secCode", "formCode")


@query("SELECT doc_id, text FROM documents")
def scan_archive_members(spark, d):
    rows = _spread(_read(spark, d, "documents")).select(
        F.format_string("doc/%d.txt", "doc_id").alias("member"), F.encode("text", "UTF-8").alias("content")
    )
    members = archives.expand_archives(samples.zip_rows(rows), r"\.txt$")
    doc_id = F.regexp_extract("member", r"(\d+)\.txt$", 1).cast("bigint")
    return members.select(doc_id.alias("doc_id"), F.decode("content", "UTF-8").alias("text"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def scan_workbooks(spark, d):
    df = _read(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    sheet = workbooks.workbook_table(samples.workbooks(df), ["c_custkey", "c_name", "c_acctbal"])
    return enforce_types(sheet, {"c_custkey": "Int", "c_name": "String", "c_acctbal": "Float"})


@query(
    """WITH t AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS source_path, l_partkey,
    l_suppkey, CAST(l_quantity AS BIGINT) AS q FROM lineitem)
    SELECT source_path, CAST(0 AS BIGINT) AS fact_index, 'Part' AS local_name, CAST(l_partkey AS VARCHAR) AS value,
    'CurrentYearInstant' AS context_id FROM t
    UNION ALL SELECT source_path, 1, 'Supplier', CAST(l_suppkey AS VARCHAR), 'CurrentYearInstant' FROM t
    UNION ALL SELECT source_path, 2, 'Quantity', CAST(q AS VARCHAR), 'Prior1YearInstant' FROM t"""
)
def scan_filing_facts(spark, d):
    xml = samples.filing_document(
        [
            ("Part", "CurrentYearInstant", F.col("l_partkey")),
            ("Supplier", "CurrentYearInstant", F.col("l_suppkey")),
            ("Quantity", "Prior1YearInstant", F.col("l_quantity").cast("bigint")),
        ]
    )
    documents = _spread(_read(spark, d, "lineitem")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("source_path"), F.encode(xml, "UTF-8").alias("content")
    )
    facts = filings.filing_facts(documents)
    return facts.select("source_path", "fact_index", "local_name", "value", "context_id")


# ---- filings ---------------------------------------------------------------------------------------------------------


def _metadata(standard: str) -> list:
    """Metadata facts of a document row: the security code is the document's own number."""
    values = {
        "SecurityCodeDEI": F.col("doc"),
        "EDINETCodeDEI": F.concat(F.lit("E"), F.col("doc")),
        "CurrentFiscalYearStartDateDEI": F.lit("2024-04-01"),
        "CurrentFiscalYearEndDateDEI": F.lit("2025-03-31"),
        "AccountingStandardsDEI": F.col(standard),
    }
    context, label = F.lit("FilingDateInstant"), F.lit(None)
    return [(F.lit(tag), context, value, label) for tag, value in values.items()]


@query(
    """WITH m(tag, attr) AS (SELECT * FROM (VALUES ('AF','sales'),('NO','sales'),('RF','profit')) x(tag, attr)),
    f AS (SELECT DISTINCT l_suppkey AS doc, l_returnflag || l_linestatus AS tag, l_linenumber AS ctx, l_quantity AS v
    FROM lineitem)
    SELECT doc, round(avg(CASE WHEN attr = 'sales' THEN CAST(v AS BIGINT) END), 4) AS sales,
    round(avg(CASE WHEN attr = 'profit' THEN CAST(v AS BIGINT) END), 4) AS profit
    FROM f JOIN m ON f.tag = m.tag WHERE ctx IN (1, 2) GROUP BY doc"""
)
def facts_wide(spark, d):
    rows = _read(spark, d, "lineitem").withColumn("doc", F.col("l_suppkey").cast("string"))
    context = (
        F.when(F.col("l_linenumber") == 1, "S100_CurrentYearDuration")
        .when(F.col("l_linenumber") == 2, "S100_CurrentYearInstant_NonConsolidatedMember")
        .otherwise("Prior1YearDuration")
    )
    tag, value = F.concat("l_returnflag", "l_linestatus"), F.col("l_quantity").cast("bigint")
    values = samples.fact_rows(rows, F.col("doc"), [(tag, context, value, F.lit(None))])
    documents = rows.select("doc").distinct().withColumn("standard", F.lit("Std"))
    facts = combine.union_parts([values, samples.fact_rows(documents, F.col("doc"), _metadata("standard"))])
    wide = filing_ops.normalise_filing_facts(
        facts, {"Std": {"AF": "sales", "NO": "sales", "RF": "profit"}}, ["sales", "profit"]
    )
    return wide.select(
        F.col("source_path").cast("bigint").alias("doc"), *[F.round(c, 4).alias(c) for c in ("sales", "profit")]
    )


@query(
    """WITH f AS (SELECT DISTINCT l_orderkey AS doc, l_linenumber AS ctx, l_returnflag AS tag, l_partkey, l_suppkey,
    CAST(l_quantity AS BIGINT) AS v FROM lineitem), s AS (SELECT o_orderkey AS doc, o_orderstatus AS standard FROM orders)
    SELECT f.doc, s.standard, round(avg(CASE WHEN tag = 'A' THEN v END), 4) AS sales,
    round(avg(CASE WHEN tag = 'N' THEN v END), 4) AS profit FROM f JOIN s ON f.doc = s.doc
    WHERE s.standard <> 'P' AND tag IN ('A', 'N') AND ctx <= 4 GROUP BY f.doc, s.standard"""
)
def facts_by_standard(spark, d):
    rows = _read(spark, d, "lineitem").withColumn("doc", F.col("l_orderkey").cast("string"))
    ending = F.element_at(F.array(*[F.lit(c) for c in filing_ops.CURRENT_YEAR_CONTEXTS]), F.col("l_linenumber"))
    context = F.when(F.col("l_linenumber") <= 4, F.concat(F.lit("X"), F.expr("cast(l_linenumber as string)"), ending))
    context = F.when(F.col("l_linenumber") <= 4, context).otherwise("Prior1YearInstant")
    label = F.concat_ws("/", "l_partkey", "l_suppkey")
    values = samples.fact_rows(
        rows, F.col("doc"), [(F.col("l_returnflag"), context, F.col("l_quantity").cast("bigint"), label)]
    )
    documents = _read(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("doc"), "o_orderstatus")
    facts = combine.union_parts([values, samples.fact_rows(documents, F.col("doc"), _metadata("o_orderstatus"))])
    tags = {"A": "sales", "N": "profit"}
    wide = filing_ops.normalise_filing_facts(facts, {"F": tags, "O": tags}, ["sales", "profit"])
    return wide.select(
        F.col("source_path").cast("bigint").alias("doc"),
        F.col("Account standard").alias("standard"),
        *[F.round(c, 4).alias(c) for c in ("sales", "profit")],
    )


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS source_path FROM orders WHERE o_orderstatus = 'P'"""
)
def filings_without_standard(spark, d):
    documents = _read(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("doc"), "o_orderstatus")
    facts = samples.fact_rows(documents, F.col("doc"), _metadata("o_orderstatus"))
    return filing_ops.filings_without_standard(facts, {"F": {"a": "b"}, "O": {"a": "b"}})


_FLOATS = [c for c in schemas.FILING_COLUMNS[5:20] if c not in ("Net sales", "Operating profit", "Employees")]


@query(
    """SELECT CAST(o_custkey AS VARCHAR) AS "Ticker", 'E' || CAST(o_custkey AS VARCHAR) AS "Edinet code",
    DATE '2024-04-01' AS "Period start date", DATE '2025-03-31' AS "Period end date",
    CASE o_orderstatus WHEN 'F' THEN 'Japan GAAP' ELSE 'IFRS' END AS "Account standard",
    CASE o_orderstatus WHEN 'F' THEN (2 * o_custkey + 1) / 2.0 ELSE CAST(o_orderkey AS DOUBLE) END AS "Net sales",
    CASE o_orderstatus WHEN 'F' THEN CAST(o_orderkey AS DOUBLE) END AS "Operating profit",
    CAST(o_orderkey % 1000 AS DOUBLE) AS "Employees",
    CAST(o_orderkey AS VARCHAR) || '.zip/XBRL/PublicDoc/report.xbrl' AS source_path, 'landed' AS ingestion_source, """
    + ", ".join(f'CAST(NULL AS DOUBLE) AS "{c}"' for c in _FLOATS)
    + """ FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority NOT IN ('5-LOW', '1-URGENT')
    AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"""
)
def ingest_filings(spark, d):
    now, plain = "CurrentYearDuration", "CurrentYearInstant_NonConsolidatedMember"
    customer, order = F.col("o_custkey"), F.col("o_orderkey")
    standard = F.expr("case o_orderstatus when 'F' then 'Japan GAAP' when 'O' then 'IFRS' else 'Other' end")
    xml = samples.filing_document(
        samples.metadata_facts(
            {
                "SecurityCodeDEI": customer,
                "EDINETCodeDEI": F.concat(F.lit("E"), customer.cast("string")),
                "CurrentFiscalYearStartDateDEI": F.lit("2024-04-01"),
                "CurrentFiscalYearEndDateDEI": F.lit("2025-03-31"),
                "AccountingStandardsDEI": standard,
            }
        )
        + [
            ("NetSalesSummaryOfBusinessResults", now, customer),
            ("NetSalesSummaryOfBusinessResults", plain, customer + 1),
            ("NetSalesSummaryOfBusinessResults", "Prior1YearDuration", order),
            ("NetSalesIFRSSummaryOfBusinessResults", now, order),
            ("OperatingIncome", now, order),
            ("NumberOfEmployees", "CurrentYearInstant", order % 1000),
            ("OperatingRevenue1", now, F.lit("n/a")),
        ]
    )
    archive = samples.zip_documents(
        _spread(_read(spark, d, "orders")).select(
            F.format_string("%d.zip", order).alias("path"),
            F.lit("XBRL/PublicDoc/report.xbrl").alias("member"),
            F.encode(xml, "UTF-8").alias("content"),
        )
    )
    codes = filters.equals_all(_read(spark, d, "customer"), {"c_mktsegment": "BUILDING"})
    codes = codes.select(F.col("c_custkey").cast("string").alias("code"))
    spec = TableSpec(  # the same company files many times here, so the key is not unique and is left out
        tuple(ColumnSpec(c.name, c.type, c.nullable) for c in schemas.FILINGS.columns), "filings"
    )
    return ingest.ingest_filings(_land_filing_index(spark, d), archive, "landed", codes, spec)


# ---- extracts, ingests, streams --------------------------------------------------------------------------------------


@query(
    """SELECT * FROM (SELECT o.o_orderkey AS order_id,
    coalesce(CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE o.o_orderstatus END, 'Unknown') AS status,
    c.c_mktsegment AS segment, o.o_totalprice AS price FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey) t
    WHERE price > 1000 AND segment = 'BUILDING'"""
)
def extract_frame(spark, d):
    return extract(spark, _extract_spec(spark, d))


def _extract_spec(spark, d, **options) -> ExtractSpec:
    orders = _read(spark, d, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.expr("if(o_orderkey % 7 = 0, null, o_orderstatus)").alias("o_orderstatus"),
        "o_totalprice",
    )
    customer = _read(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    final = TableSpec(
        (
            ColumnSpec("o_orderkey", "Int", nullable=False, unique=True, rename="order_id", primary_key=True),
            ColumnSpec("o_orderstatus", "String", nullable=False, rename="status"),
            ColumnSpec("c_mktsegment", "String", rename="segment"),
            ColumnSpec("o_totalprice", "Float", rename="price"),
        ),
        "order_extract",
    )
    return ExtractSpec(
        base=TableRef(frame=orders),
        joins=[JoinSpec(TableRef(frame=customer), ["o_custkey"], "left")],
        fills=[FillSpec("o_orderstatus", "Unknown")],
        where="o_totalprice > 1000 and c_mktsegment = 'BUILDING'",
        final=final,
        **options,
    )


@query(
    """SELECT o.o_orderkey AS order_id,
    coalesce(CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE o.o_orderstatus END, 'Unknown') AS status,
    c.c_mktsegment AS segment, o.o_totalprice AS price FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    WHERE o.o_totalprice > 1000 AND c.c_mktsegment = 'BUILDING'"""
)
def snapshot_cache(spark, d):
    folder = scratch_path(spark, "cache")
    df = extract(spark, _extract_spec(spark, d))
    path = tables.snapshot(df, folder, "20240105100000")
    types = {"order_id": "Int", "status": "String", "segment": "String", "price": "Float"}
    return files.scan_csv(spark, path, TableSpec(tuple(ColumnSpec(c, t) for c, t in types.items())))


@query(
    """WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS v,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS st FROM orders)
    SELECT o_orderkey, coalesce(v, (SELECT max(v) FROM t)) AS v, lower(coalesce(st, 'Unknown')) AS st FROM t"""
)
def chain_stages(spark, d):
    df = _read(spark, d, "orders").select(
        "o_orderkey",
        F.expr("if(o_orderkey % 7 = 0, null, o_custkey)").alias("v"),
        F.expr("if(o_orderkey % 5 = 0, null, o_orderstatus)").alias("st"),
        F.expr("if(o_orderkey % 2 = 0, null, o_totalprice)").alias("half"),
    )
    stages = [
        {"kind": "drop_sparse", "threshold": 0.5},
        {"kind": "fill_nulls", "fills": {"v": "max", "st": "Unknown"}},
        {"kind": "lower", "stage": lambda frame: frame.withColumn("st", F.lower("st"))},
    ]
    return chain.run_chain(df, stages)[1]


@query(
    """SELECT event_id, CAST(ts AS DATE) AS event_date, event_type AS kind, value, 'synthetic' AS ingestion_source
    FROM events"""
)
def ingest_events(spark, d):
    spec = TableSpec(
        (
            ColumnSpec("event_id", "Int", nullable=False, unique=True, primary_key=True),
            ColumnSpec("ts", "Date", rename="event_date"),
            ColumnSpec("event_type", "String", rename="kind"),
            ColumnSpec("value", "Float"),
            ColumnSpec("ingestion_source", "String", nullable=False),
        ),
        "events",
    )
    job = IngestSpec(
        source=_read(spark, d, "events"),
        ingestion_source="synthetic",
        stages=[{"kind": "drop_sparse"}],
        retain=["event_id", "ts", "event_type", "value"],
        table=spec,
    )
    return ingest.ingest(spark, job)


@query(
    """SELECT CAST(l_partkey AS VARCHAR(20)) AS ticker, CAST(l_shipdate AS DATE) AS disc_date, l_extendedprice AS sales,
    'synthetic' AS ingestion_source FROM lineitem
    WHERE l_partkey IN (SELECT p_partkey FROM part WHERE regexp_matches(p_type, 'ECONOMY'))"""
)
def ingest_summary(spark, d):
    spec = TableSpec(
        (
            ColumnSpec("Code", "String", nullable=False, rename="ticker"),
            ColumnSpec("DiscDate", "Date", nullable=False, rename="disc_date"),
            ColumnSpec("Sales", "Float", rename="sales"),
            ColumnSpec("ingestion_source", "String", nullable=False),
        ),
        "summary",
    )
    landed = _read(spark, d, "lineitem").selectExpr(
        "l_partkey as Code", "l_shipdate as DiscDate", "l_extendedprice as Sales"
    )
    codes = ingest.select_codes(_read(spark, d, "part"), "p_type", "ECONOMY", code_column="p_partkey")
    return ingest.ingest_summary(landed, "synthetic", codes, spec=spec)


@query(
    """SELECT CAST(o_orderdate AS DATE) AS "PubDate", o_orderstatus AS "Section", CAST(o_custkey AS DOUBLE) AS "PropSell",
    'synthetic' AS ingestion_source FROM orders WHERE o_orderstatus = 'F'
    AND o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1998-01-01 00:00:00'"""
)
def ingest_flows(spark, d):
    names = ["PubDate", "Section", "PropSell", "ingestion_source"]
    spec = TableSpec(tuple(c for c in schemas.INVESTOR_FLOWS.columns if c.name in names), "flows")
    landed = _read(spark, d, "orders").selectExpr(
        "o_orderdate as PubDate", "o_orderstatus as Section", "cast(o_custkey as string) as PropSell"
    )
    window = windows.resolve_window("flows", start_date="1997-01-01", end_date="1997-12-31")
    return ingest.ingest_flows(landed, "synthetic", "F", window, spec)


_BARS = """WITH e AS (SELECT o_orderkey AS ticker, CAST(o_orderdate AS DATE) AS date, o_totalprice AS close_price
    FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'), n AS (SELECT o_orderkey AS ticker,
    CAST(o_orderdate AS DATE) AS date, 0.5 * o_totalprice AS close_price FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00')
    SELECT * FROM e WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.ticker = e.ticker AND n.date = e.date)
    UNION ALL SELECT * FROM n"""


def _bar_spec(*extra: ColumnSpec) -> TableSpec:
    return TableSpec(
        (
            ColumnSpec("Code", "Int", nullable=False, rename="ticker", primary_key=True),
            ColumnSpec("Date", "Date", nullable=False, rename="date", primary_key=True),
            ColumnSpec("AdjC", "Float", rename="close_price"),
            *extra,
        ),
        "bars",
    )


def _landed_bars(spark, d):
    stored, new = _halves(_read(spark, d, "orders"))
    new = new.withColumn("o_totalprice", F.lit(0.5) * F.col("o_totalprice"))
    return [x.selectExpr("o_orderkey as Code", "o_orderdate as Date", "o_totalprice as AdjC") for x in (stored, new)]


@query(_BARS)
def ingest_bars_upsert(spark, d):
    target = ingest.upsert_target(scratch_path(spark, "bars"))
    for landed in _landed_bars(spark, d):
        ingest.ingest_bars(landed, "synthetic", spec=_bar_spec(), target=target)
    return tables.read_table(spark, target.path)


@query(_BARS)
def stream_upsert(spark, d):
    year = ColumnSpec("year", "Int32", nullable=False, primary_key=True, partition_key=True)
    target = TargetSpec(scratch_path(spark, "streamed"), mode="upsert")
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "stream-state")
    for wave in _landed_bars(spark, d):
        wave = wave.withColumn("year", F.year("Date"))
        wave.write.mode("append").parquet(landing)
        rows = stream.read_landing(spark, landing, wave.schema)
        stream.upsert_stream(rows, _bar_spec(year), target, checkpoint).awaitTermination()
    return tables.read_table(spark, target.path).select("ticker", "date", "close_price")


@query(
    """SELECT CAST(o_orderdate AS DATE) AS date, replace(CAST(o_custkey AS VARCHAR(20)) || '.T', '.T', '0') AS ticker,
    max(o_totalprice) AS total_revenue, CAST(NULL AS DOUBLE) AS net_income, 'synthetic' AS ingestion_source FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'
    GROUP BY CAST(o_orderdate AS DATE), replace(CAST(o_custkey AS VARCHAR(20)) || '.T', '.T', '0')"""
)
def ingest_statement(spark, d):
    spec = TableSpec(
        (
            ColumnSpec("date", "Date", nullable=False, primary_key=True),
            ColumnSpec("ticker", "String", nullable=False, primary_key=True),
            ColumnSpec("total_revenue", "Float"),
            ColumnSpec("net_income", "Float"),
            ColumnSpec("ingestion_source", "String", nullable=False),
        ),
        "income",
    )
    long = (
        _read(spark, d, "orders")
        .groupBy(
            F.col("o_orderdate").cast("date").alias("date"),
            F.concat(F.col("o_custkey").cast("string"), F.lit(".T")).alias("ticker"),
        )
        .agg(F.max("o_totalprice").alias("value"))
        .withColumn("item", F.lit("total_revenue"))
    )
    rows = reshape.items_to_columns(long, ["date", "ticker"], "item", "value", ["total_revenue"])
    return ingest.finish(ingest.statement_rows(rows, spec, "1997-01-01"), spec, "synthetic")


@query(
    """SELECT CAST(o_orderdate AS DATE) AS "Date", '13010' AS "Ticker", o_totalprice AS "Open", o_totalprice AS "High",
    o_totalprice AS "Low", o_totalprice AS "Close", CAST(o_custkey AS DOUBLE) AS "Volume", 'synthetic' AS ingestion_source
    FROM orders WHERE o_orderkey % 3 <> 0"""
)
def ingest_prices(spark, d):
    df = _read(spark, d, "orders")
    wide = df.select(
        F.col("o_orderdate").cast("date").alias("Date"),
        *[_null_every(df, "o_orderkey", 3, "o_totalprice").alias(f"1301.T|{f}") for f in schemas.PRICE_FIELDS[:4]],
        _null_every(df, "o_orderkey", 3, "o_custkey").alias("1301.T|Volume"),
    )
    return ingest.ingest_prices(wide, "synthetic", ["13010", "99990"])


# ---- times, slices, code files, repeated items -----------------------------------------------------------------------


@query(
    """SELECT c_custkey, TIMESTAMP '2024-01-05 10:20:30' AS ingestion_datetime, 'synthetic' AS ingestion_source FROM customer"""
)
def add_ingestion_time(spark, d):
    import datetime as dt

    at = dt.datetime(2024, 1, 5, 10, 20, 30, 999_999)
    df = project.with_ingestion_metadata(_read(spark, d, "customer"), "synthetic", at)
    return project.retain(df, ["c_custkey", "ingestion_datetime", "ingestion_source"])


@query("SELECT o_orderkey, TRUE AS whole_second, TRUE AS is_now FROM orders")
def current_time(spark, d):
    """The time of the query, in whole seconds."""
    now, micros = scalar.now_whole_seconds(), F.unix_micros(F.current_timestamp())
    age = micros - F.unix_micros(now)
    whole = (F.unix_micros(now) % 1_000_000 == 0).alias("whole_second")
    return _read(spark, d, "orders").select("o_orderkey", whole, ((age >= 0) & (age < 1_000_000)).alias("is_now"))


@query(
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate FROM lineitem WHERE l_suppkey = 3
    AND CAST(l_shipdate AS DATE) = (SELECT CAST(min(l_shipdate) AS DATE) FROM lineitem WHERE l_suppkey = 3)"""
)
def table_slice_summary(spark, d):
    """Both a code and a single day."""
    df = _read(spark, d, "lineitem")
    day = df.where("l_suppkey = 3").agg(F.min("l_shipdate").cast("date").alias("day")).first()["day"]
    df = filters.table_slice(df, "summary", code=3, date=day, code_column="l_suppkey", date_column="l_shipdate")
    return project.retain(df, ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate"])


@query(
    """SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderstatus = 'F'
    AND o_orderdate >= TIMESTAMP '1997-03-01 00:00:00'"""
)
def table_slice_flows(spark, d):
    """A section and a range that is open at its end."""
    df = filters.table_slice(
        _read(spark, d, "orders"),
        "flows",
        section="F",
        date_from="1997-03-01",
        date_column="o_orderdate",
        section_column="o_orderstatus",
    )
    return project.retain(df, ["o_orderkey", "o_orderstatus", "o_orderdate"])


@query(
    """SELECT o_orderkey, o_orderdate FROM orders
    WHERE CAST(o_orderdate AS DATE) = (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)"""
)
def table_slice_day(spark, d):
    """A single day of all codes."""
    df = _read(spark, d, "orders")
    day = df.agg(F.max("o_orderdate").cast("date").alias("day")).first()["day"]
    return project.retain(filters.table_slice(df, "bars", date=day, date_column="o_orderdate"), ["o_orderkey", "o_orderdate"])


@query(
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN
    (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"""
)
def code_list_file(spark, d):
    """Codes landed as lines of a list: dashes, quotes and comments around them, repeated ones, blank lines between."""
    path = scratch_path(spark, "codes")
    customers = _read(spark, d, "customer").where("c_mktsegment = 'BUILDING'")
    forms = F.array(
        F.format_string('  - "%d"  # wanted', "c_custkey"), F.format_string("%d", "c_custkey"), F.lit(""), F.lit("# none")
    )
    customers.select(F.explode(forms).alias("value")).write.text(path)
    orders = _read(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_custkey").cast("string").alias("code"))
    return joins.in_codes(orders, files.code_list(spark, path=path), "code").select("o_orderkey", "o_custkey")


@query(
    """SELECT l_suppkey, (min({'o': l_orderkey, 'n': l_linenumber, 'v': l_extendedprice}) FILTER (l_returnflag = 'A')).v AS "A",
    (min({'o': l_orderkey, 'n': l_linenumber, 'v': l_extendedprice}) FILTER (l_returnflag = 'N')).v AS "N",
    CAST(NULL AS DOUBLE) AS "none" FROM lineitem GROUP BY l_suppkey"""
)
def items_first_in_order(spark, d):
    """Items that repeat: the first one by order and line counts."""
    return reshape.items_to_columns(
        _read(spark, d, "lineitem"),
        ["l_suppkey"],
        "l_returnflag",
        "l_extendedprice",
        ["A", "N", "none"],
        order=["l_orderkey", "l_linenumber"],
    )


# ---- what becomes of filings -----------------------------------------------------------------------------------------


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS source_path, CASE WHEN o_orderkey % 5 = 0 THEN 'no facts'
    WHEN o_orderstatus = 'P' THEN 'unknown accounting standard P' WHEN o_orderkey % 7 = 0 THEN 'no Edinet code, Period end date'
    ELSE 'no value' END AS reason FROM orders WHERE o_orderkey % 5 = 0 OR o_orderstatus = 'P' OR o_orderkey % 7 = 0
    OR NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'A')"""
)
def filing_ledger(spark, d):
    """Why documents give no row; with the rows given they make up all documents."""
    orders = _read(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("doc"), "o_orderkey", "o_orderstatus")
    cut = F.col("o_orderkey") % 7 == 0
    metadata = [
        (tag, context, F.when(~(cut & tag.isin("EDINETCodeDEI", "CurrentFiscalYearEndDateDEI")), value), label)
        for tag, context, value, label in _metadata("o_orderstatus")
    ]
    known = orders.where("o_orderkey % 5 <> 0")
    lines = _read(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("doc"), "l_returnflag", "l_quantity")
    lines = lines.join(known.select("doc"), "doc", "left_semi")
    quantity = F.col("l_quantity").cast("bigint")
    values = samples.fact_rows(
        lines, F.col("doc"), [(F.col("l_returnflag"), F.lit("X_CurrentYearDuration"), quantity, F.lit(None))]
    )
    facts = combine.union_parts([values, samples.fact_rows(known, F.col("doc"), metadata)]).filter("value is not null")
    tags = {"A": "sales"}
    return filing_ops.filing_ledger(facts, orders.select(F.col("doc").alias("source_path")), {"F": tags, "O": tags})


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS "docID", CASE WHEN o_orderkey % 10 > 1 THEN
    CAST(o_orderkey AS VARCHAR) || '.zip/XBRL/PublicDoc/report.xbrl' END AS source_path,
    CASE o_orderkey % 10 WHEN 0 THEN 'no archive' WHEN 1 THEN 'no public document' WHEN 2 THEN 'no facts'
    WHEN 3 THEN 'unknown accounting standard Other' WHEN 4 THEN 'no accounting standard' WHEN 5 THEN 'no Edinet code'
    WHEN 6 THEN 'no value' END AS reason
    FROM orders WHERE o_orderpriority NOT IN ('5-LOW', '1-URGENT')"""
)
def filing_outcomes(spark, d):
    """Every wanted filing, from those without an archive to those that give a row."""
    order, case = F.col("o_orderkey"), F.col("o_orderkey") % 10
    sales = F.when(case == 6, "n/a").otherwise(order.cast("string"))
    xml = samples.filing_document(
        samples.metadata_facts(
            {
                "SecurityCodeDEI": F.col("o_custkey"),
                "EDINETCodeDEI": F.when(case != 5, F.lit("E1")),
                "CurrentFiscalYearStartDateDEI": F.lit("2024-04-01"),
                "CurrentFiscalYearEndDateDEI": F.lit("2025-03-31"),
                "AccountingStandardsDEI": F.when(case == 3, "Other").when(case != 4, "IFRS"),
            }
        )
        + [("NetSalesIFRSSummaryOfBusinessResults", "CurrentYearDuration", sales)]
    )
    archive = samples.zip_documents(
        _spread(_read(spark, d, "orders").where(case != 0)).select(
            F.format_string("%d.zip", order).alias("path"),
            F.when(case == 1, "XBRL/AuditDoc/report.xbrl").otherwise("XBRL/PublicDoc/report.xbrl").alias("member"),
            F.encode(F.when(case == 2, F.lit("<cut off")).otherwise(xml), "UTF-8").alias("content"),
        )
    )
    return ingest.filing_outcomes(_land_filing_index(spark, d), write_scratch(archive, "archives"), skip_bad=True)


# ---- whole jobs and guards -------------------------------------------------------------------------------------------


def _statement_matrix(df: DataFrame, item: str) -> DataFrame:
    """One item of every customer, a column per year end."""
    years = [
        F.sum(F.when(F.year("o_orderdate") == y, F.col("o_totalprice"))).alias(f"{y}-12-31") for y in (1996, 1997, 1998)
    ]
    ticker = F.concat(F.col("o_custkey").cast("string"), F.lit(".T")).alias("ticker")
    return df.groupBy(ticker, F.lit(item).alias("item")).agg(*years)


@query(
    """WITH t AS (SELECT CAST(o_custkey AS VARCHAR) || '0' AS ticker, make_date(year(o_orderdate), 12, 31) AS day,
    sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS f, sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS o
    FROM orders GROUP BY ALL),
    grid AS (SELECT ticker, make_date(y, 12, 31) AS day FROM (SELECT DISTINCT ticker FROM t) own, (VALUES (1997), (1998)) x(y)),
    pairs AS (SELECT g.ticker, g.day, round(t.f, 2) AS f, round(t.o, 2) AS o FROM grid g LEFT JOIN t ON g.ticker = t.ticker AND g.day = t.day)
    SELECT 'income_statement' AS "table", ticker, day AS date, f AS amount, o AS second FROM pairs
    UNION ALL SELECT 'balance_sheet', ticker, day, f, NULL FROM pairs
    UNION ALL SELECT 'dividends', ticker, DATE '1998-06-30', round(sum(coalesce(f, 0) + coalesce(o, 0)), 2), NULL FROM
    (SELECT ticker, sum(f) AS f, sum(o) AS o FROM t GROUP BY ticker) GROUP BY ticker
    UNION ALL SELECT 'outcome cash_flow no path', NULL, NULL, NULL, NULL
    UNION ALL SELECT 'outcome written', NULL, NULL, 3, NULL
    UNION ALL SELECT 'outcome with an empty table: nothing', NULL, NULL, NULL, NULL"""
)
def ingest_four_statements(spark, d):
    """The whole job twice: three targets and one skipped table; then one empty table, which aborts all four."""
    orders = _read(spark, d, "orders").withColumn("o_totalprice", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")))
    closed, still = (
        orders.withColumn("o_totalprice", F.when(F.col("o_orderstatus") == s, F.col("o_totalprice"))) for s in "FO"
    )
    matrices = {
        "income_statement": combine.union_parts(
            [_statement_matrix(closed, "Total Revenue"), _statement_matrix(still, "Net Income")]
        ),
        "balance_sheet": _statement_matrix(closed, schemas.BALANCE_SHEET_ITEMS[0]),
        "cash_flow": _statement_matrix(closed, schemas.CASH_FLOW_ITEMS[0]),
    }
    ticker = F.concat(F.col("o_custkey").cast("string"), F.lit(".T")).alias("ticker")
    paid = orders.groupBy(ticker).agg(F.coalesce(F.sum("o_totalprice"), F.lit(0.0)).alias("v"))
    days = F.array(*[F.lit(day).cast("date") for day in ("1995-06-30", "1998-06-30")])
    paid = paid.select("ticker", F.map_from_arrays(days, F.array("v", "v")).alias("series"))
    targets = {name: scratch_path(spark, name) for name in ingest.STATEMENT_SPECS if name != "cash_flow"}
    for _ in range(2):
        done = ingest.ingest_statements(matrices, paid, "synthetic", "1997-01-01", targets=targets)
    empty = {**matrices, "cash_flow": matrices["cash_flow"].limit(0)}
    fresh = {name: scratch_path(spark, name) for name in ingest.STATEMENT_SPECS}
    nothing = ingest.ingest_statements(empty, paid, "synthetic", "1997-01-01", targets=fresh) is None
    nothing = nothing and not any(tables.table_exists(spark, path) for path in fresh.values())
    outcomes = [(f"outcome {name} {was}", None) for name, was in done.items() if was != "written"]
    outcomes.append(("outcome written", float(sum(was == "written" for was in done.values()))))
    outcomes.append((f"outcome with an empty table: {'nothing' if nothing else 'something'}", None))
    said = spark.createDataFrame(outcomes, "table string, amount double").selectExpr(
        "table", "cast(null as string) as ticker", "cast(null as date) as date", "amount", "cast(null as double) as second"
    )

    def stored(name: str, amount: str, second: str | None = None) -> DataFrame:
        df = tables.read_table(spark, targets[name])
        df = df.withColumnsRenamed({"Date": "date", "Ticker": "ticker"})
        other = F.round(f"`{second}`", 2) if second else F.lit(None).cast("double")
        return df.select(
            F.lit(name).alias("table"), "ticker", "date", F.round(f"`{amount}`", 2).alias("amount"), other.alias("second")
        )

    return combine.union_parts(
        [
            stored("income_statement", "Total Revenue", "Net Income"),
            stored("balance_sheet", schemas.BALANCE_SHEET_ITEMS[0]),
            stored("dividends", "Dividends"),
            said,
        ]
    )


@query(
    """SELECT CAST(o_orderdate AS DATE) AS "Date", '^N' || CAST(o_custkey % 2 AS VARCHAR) AS "Ticker", max(o_totalprice) AS "Close",
    'synthetic' AS ingestion_source FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'
    AND o_orderdate < TIMESTAMP '1998-01-01 00:00:00' GROUP BY ALL"""
)
def ingest_index_prices(spark, d):
    """Market indexes keep their symbols; a day on which one has no price gives it no row."""
    close = [F.max(F.when(F.col("o_custkey") % 2 == i, F.col("o_totalprice"))).alias(f"^N{i}|Close") for i in (0, 1)]
    wide = _read(spark, d, "orders").groupBy(F.col("o_orderdate").cast("date").alias("Date")).agg(*close)
    kept = ("date", "ticker", "Close", "ingestion_source")
    spec = TableSpec(tuple(c for c in schemas.EXCHANGE_PRICES.columns if c.name in kept), "index_prices")
    window = windows.resolve_window("prices", start_date="1997-01-01", end_date="1997-12-31")
    return ingest.ingest_prices(wide, "synthetic", ["^N0", "^N1"], listed=False, window=window, spec=spec)


@query(
    """WITH o AS (SELECT 'orders' AS name, count(*) AS n FROM orders), c AS (SELECT 'customer' AS name, count(*) AS n FROM customer)
    SELECT name, 'written' AS outcome, n FROM o UNION ALL SELECT name, 'written', n FROM c
    UNION ALL SELECT 'part', 'no path', 0 UNION ALL SELECT 'orders', 'aborted', 0 UNION ALL SELECT 'none', 'aborted', 0"""
)
def write_several_tables(spark, d):
    """Several tables of one job; one without a path is skipped, and one without rows stops them all."""
    paths = {name: scratch_path(spark, name) for name in ("orders", "customer", "again")}
    orders, customers = (_read(spark, d, name) for name in ("orders", "customer"))
    job = {
        "orders": (orders, ["o_orderkey"], paths["orders"]),
        "customer": (customers, [], paths["customer"]),
        "part": (_read(spark, d, "part"), [], None),
    }
    done = tables.write_tables(job, "append")
    stopped = tables.write_tables(
        {"orders": (orders, [], paths["again"]), "none": (customers.where("c_custkey < 0"), [], paths["again"])}, "append"
    )
    wrong = tables.table_exists(spark, paths["again"])
    outcomes = [(name, was, paths.get(name) if was == "written" else None) for name, was in done.items()]
    outcomes += [(name, was, paths["again"] if wrong else None) for name, was in stopped.items()]
    parts = []
    for name, was, path in outcomes:
        held = tables.read_table(spark, path) if path else customers.where("c_custkey < 0")
        held = held.agg(F.count(F.lit(1)).alias("n"))
        parts.append(held.select(F.lit(name).alias("name"), F.lit(was).alias("outcome"), "n"))
    return combine.union_parts(parts)


@query(_BARS)
def catalogue_upsert(spark, d):
    """Bars landed twice into a table of the catalogue."""
    name = "ledger_" + uuid.uuid4().hex
    target = TargetSpec(scratch_path(spark, name), mode="upsert", table=name)
    for landed in _landed_bars(spark, d):
        out = ingest.ingest_bars(landed, "synthetic", spec=_bar_spec(), target=target)
    return out


@query(
    """WITH r AS (SELECT count(*) AS n FROM (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 1) x)
    SELECT 'upsert with repeated keys' AS write, CASE WHEN n > 0 THEN 'DuplicateKeyError' ELSE 'written' END AS outcome FROM r
    UNION ALL SELECT 'upsert with distinct keys', 'written' UNION ALL SELECT 'incremental with repeated keys', 'written'
    UNION ALL SELECT 'key not stored', 'ValueError' UNION ALL SELECT 'key not delivered', 'ValueError'
    UNION ALL SELECT 'no key', 'ValueError' UNION ALL SELECT 'unknown mode', 'ValueError'
    UNION ALL SELECT 'column not found', 'ValueError'"""
)
def write_guards(spark, d):
    """What each write that a key or column guard looks at comes to."""
    orders = _read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    path = scratch_path(spark, "guarded")
    tables.write_table(orders.where("o_orderkey % 2 = 0"), path)
    other = orders.withColumn("k", F.lit(1))
    attempts = {
        "upsert with repeated keys": lambda: tables.write_table(orders, path, "upsert", ["o_custkey"]),
        "upsert with distinct keys": lambda: tables.write_table(orders, path, "upsert", ["o_orderkey"]),
        "incremental with repeated keys": lambda: tables.write_table(orders, path, "incremental", ["o_custkey"]),
        "key not stored": lambda: tables.write_table(other, path, "upsert", ["k"], evolve=True),
        "key not delivered": lambda: tables.write_table(orders.drop("o_orderkey"), path, "upsert", ["o_orderkey"]),
        "no key": lambda: tables.write_table(orders, path, "upsert"),
        "unknown mode": lambda: tables.write_table(orders, path, "archive", ["o_orderkey"]),
        "column not found": lambda: project.retain(orders, ["o_orderkey", "absent"]),
    }
    outcomes = []
    for name, attempt in attempts.items():
        try:
            attempt()
            outcomes.append((name, "written"))
        except ValueError as e:
            outcomes.append((name, type(e).__name__))
    return spark.createDataFrame(outcomes, "write string, outcome string")


@query(
    """SELECT 'nullable c_acctbal' AS rule, CASE WHEN count(*) FILTER (c_custkey % 7 = 0) > 0 THEN
    'c_acctbal: ' || count(*) FILTER (c_custkey % 7 = 0) || ' rows break the nullable rule' ELSE 'fine' END AS outcome FROM customer
    UNION ALL SELECT 'unique c_mktsegment', CASE WHEN count(*) > count(DISTINCT c_mktsegment)
    THEN 'c_mktsegment: repeated values break the unique rule' ELSE 'fine' END FROM customer
    UNION ALL SELECT 'unique c_custkey', 'fine'"""
)
def validate_outcomes(spark, d):
    """Validations that fail on their first broken rule, staged and not."""
    df = _read(spark, d, "customer")
    df = df.select("c_custkey", "c_mktsegment", _null_every(df, "c_custkey", 7, "c_acctbal").alias("c_acctbal"))
    key = ColumnSpec("c_custkey", "Int", unique=True)
    specs = {
        "nullable c_acctbal": TableSpec((key, ColumnSpec("c_acctbal", "Float", nullable=False))),
        "unique c_mktsegment": TableSpec((key, ColumnSpec("c_mktsegment", unique=True))),
        "unique c_custkey": TableSpec((key,)),
    }
    outcomes = []
    for i, (name, spec) in enumerate(specs.items()):
        try:
            validation.validate(df.select(*spec.source_names), spec, stage=i == 0)
            outcomes.append((name, "fine"))
        except validation.ValidationError as e:
            outcomes.append((name, str(e)))
    return spark.createDataFrame(outcomes, "rule string, outcome string")
