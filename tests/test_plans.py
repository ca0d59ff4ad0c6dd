import datetime as dt

import json


import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.operators.validate import ValidationError
from ledgermill.plans import chain, ingest
from ledgermill.plans.extract import extract
from ledgermill.plans.windows import LoadWindow, latest_rows, resolve_window
from ledgermill.sinks.tables import read_table
from ledgermill.sources.envelopes import scan_envelopes, scan_filing_index
from ledgermill.spec import ColumnSpec, ExtractSpec, FillSpec, IngestSpec, JoinSpec, TableRef, TableSpec, TargetSpec

TODAY = dt.date(2024, 3, 31)


def day(text):
    return dt.date.fromisoformat(text)


@pytest.mark.parametrize(
    "kind,options,start,end",
    [
        ("summary", {"latest": True}, "2024-03-01", "2024-03-31"),
        ("summary", {"start_date": "2024-01-01", "end_date": "2024-01-31"}, "2024-01-01", "2024-01-31"),
        ("summary", {"single_date": "whole"}, None, None),
        ("summary", {"single_date": "2024-01-05"}, "2024-01-05", "2024-01-05"),
        ("bars", {"latest": True}, "2024-03-30", "2024-03-30"),
        ("flows", {"latest": True}, "2024-03-24", "2024-03-31"),
        ("flows", {}, None, None),
        ("filings", {}, "2024-02-29", "2024-03-31"),
        ("filings", {"end_date": "2024-01-15"}, "2023-12-15", "2024-01-15"),
        ("statements", {}, "2024-03-01", None),
        ("statements", {"cut_date": "2023-01-01"}, "2023-01-01", None),
        ("prices", {}, "2024-03-31", "2024-03-31"),
        ("prices", {"period": "5d"}, "2024-03-27", "2024-03-31"),
        ("prices", {"period": "1mo"}, "2024-02-29", "2024-03-31"),
        ("prices", {"period": "1y"}, "2023-03-31", "2024-03-31"),
        ("prices", {"period": "ytd"}, "2024-01-01", "2024-03-31"),
        ("prices", {"period": "max"}, None, "2024-03-31"),
        ("prices", {"start_date": "2024-01-01", "end_date": "2024-01-31"}, "2024-01-01", "2024-01-31"),
    ],
)
def test_windows(kind, options, start, end):
    want = LoadWindow(start and day(start), end and day(end))
    assert resolve_window(kind, today=TODAY, **options) == want


@pytest.mark.parametrize(
    "kind,options",
    [
        ("summary", {"latest": True, "single_date": "2024-01-01"}),
        ("bars", {"start_date": "2024-01-01", "latest": True}),
        ("prices", {"start_date": "2024-01-01", "end_date": "2024-01-02", "period": "1d"}),
        ("prices", {"start_date": "2024-01-01"}),
        ("prices", {"period": "soon"}),
        ("other", {}),
    ],
)
def test_bad_windows(kind, options):
    with pytest.raises(ValueError):
        resolve_window(kind, today=TODAY, **options)


def test_latest_rows(spark):
    df = spark.createDataFrame([(day("2024-01-01"),), (day("2024-01-31"),), (None,)], "d date")
    assert latest_rows(df, "d", 30).count() == 2
    assert latest_rows(df, "d", 29).count() == 1
    assert latest_rows(df.filter("d is null"), "d", 30).count() == 1


# ---- extract


@pytest.fixture
def tables(spark, tmp_path):
    (tmp_path / "dummy1.csv").write_text("Column1,Column3,Column4\nA,1,AA\nB,,BB\nC,5,\n")
    (tmp_path / "dummy.csv").write_text("Column1,Column2\nA,1\nB,2\nC,3\n")
    return tmp_path


FILLS = [FillSpec("Column1", "Unkown"), FillSpec("Column3", "max"), FillSpec("Column4", "CC")]


def test_extract(spark, rows, tables):
    spec = ExtractSpec(
        TableRef(path=str(tables / "dummy1.csv")),
        fills=FILLS,
        where="Column3 > 1",
        final=TableSpec((ColumnSpec("Column1"), ColumnSpec("Column3", "Int"), ColumnSpec("Column4"))),
    )
    assert rows(extract(spark, spec)) == [("B", 5, "BB"), ("C", 5, "CC")]


def test_extract_with_join(spark, rows, tables):
    spec = ExtractSpec(
        TableRef(path=str(tables / "dummy1.csv")),
        joins=[JoinSpec(TableRef(path="dummy.csv", db=tables.name), ["Column1"], "left")],
        fills=FILLS,
        where=("Column3", ">", 1),
        final=TableSpec((ColumnSpec("Column1"), ColumnSpec("Column2", "Int"), ColumnSpec("Column3", "Int"))),
        snapshot_dir=str(tables / "cache"),
    )
    assert rows(extract(spark, spec, str(tables.parent))) == [("B", 2, 5), ("C", 3, 5)]
    assert len(list((tables / "cache").iterdir())) == 1


def test_statistics_come_after_the_join(spark, rows):
    base = spark.createDataFrame([(1, 10.0), (2, None), (3, 50.0)], "k int, v double")
    keep = spark.createDataFrame([(1, "x"), (2, "y")], "k int, s string")
    spec = ExtractSpec(
        TableRef(frame=base), [JoinSpec(TableRef(frame=keep), ["k"], "inner")], [FillSpec("v", "max")], row_guard=False
    )
    assert rows(extract(spark, spec), "k", "v") == [(1, 10.0), (2, 10.0)]
    spec = ExtractSpec(TableRef(frame=base), [JoinSpec(TableRef(frame=keep), ["k"], "left")], [FillSpec("v", "max")], "k = 2")
    assert rows(extract(spark, spec), "k", "v") == [(2, 50.0)]


def test_extract_guard(spark):
    base = spark.createDataFrame([(1,)], "k int")
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k int, s string")
    spec = ExtractSpec(TableRef(frame=base), [JoinSpec(TableRef(frame=twice), ["k"], "left")])
    with pytest.raises(ValueError, match="row count"):
        extract(spark, spec)


# ---- chain


def test_chain_stages_come_back_fitted(spark, rows):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None), (None, 3.0, "b")], "A int, B double, C string")
    stages = [
        {"kind": "drop_sparse", "threshold": 0.5},
        {"kind": "fill_nulls", "fills": {"A": "max", "C": "none"}},
        {"kind": "twice", "stage": lambda f: f.withColumn("A", F.col("A") * 2)},
        {"kind": "same", "stage": chain.FrameFunction(lambda f: f)},
    ]
    fitted, out = chain.run_chain(df, stages)
    assert list(fitted) == ["drop_sparse", "fill_nulls", "twice", "same"]
    assert isinstance(fitted["drop_sparse"], chain.SparseColumnModel)
    assert rows(out) == [(2, "a"), (4, "b"), (4, "none")]
    # what was learned on one frame is applied to another
    other = spark.createDataFrame([(None, 1.0, None)], "A int, B double, C string")
    applied = fitted["fill_nulls"].transform(fitted["drop_sparse"].transform(other))
    assert rows(applied) == [(2, "none")]


def test_stages_work_in_a_spark_pipeline(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, None), (None, None)], "A int, B double")
    model = Pipeline(stages=[chain.SparseColumnDropper(threshold=0.9), chain.NullFiller(fills={"A": "min"})]).fit(df)
    assert rows(model.transform(df)) == [(1,), (1,)]
    model.write().overwrite().save(str(tmp_path / "model"))
    assert rows(PipelineModel.load(str(tmp_path / "model")).transform(df)) == [(1,), (1,)]


@pytest.mark.parametrize("bad", ["x", {"kind": "nope"}, {"kind": "k", "stage": 3}])
def test_bad_stages(spark, bad):
    with pytest.raises(NotImplementedError):
        chain.run_chain(spark.range(1), [bad])


# ---- ingests


def test_generic_ingest(spark, rows, tables, tmp_path):
    spec = TableSpec(
        (ColumnSpec("Column1", primary_key=True), ColumnSpec("Column2", "Float"), ColumnSpec("ingestion_source", nullable=False))
    )
    job = IngestSpec(str(tables / "dummy.csv"), "file", retain=["Column1", "Column2"], table=spec)
    assert rows(ingest.ingest(spark, job)) == [("A", 1.0, "file"), ("B", 2.0, "file"), ("C", 3.0, "file")]
    target = TargetSpec(str(tmp_path / "out"), "csv", "upsert")
    for _ in range(2):
        ingest.ingest(spark, IngestSpec(str(tables / "dummy.csv"), "file", table=spec, target=target))
    assert read_table(spark, target.path, "csv").count() == 3


def test_bars_job_end_to_end(spark, rows, tmp_path):
    """Master and bars land as envelopes, the latest day of the wanted codes is merged, twice."""
    landing = tmp_path / "bars"
    landing.mkdir()
    master = [{"Code": "13010", "ScaleCat": "TOPIX Small"}, {"Code": "13050", "ScaleCat": None}, {"Code": "9", "ScaleCat": "Not TOPIX"}]
    (tmp_path / "master.json").write_text(json.dumps({"data": master}))
    for i, d in enumerate(("2024-03-29", "2024-03-30")):
        data = [
            {"Code": c, "Date": d, "AdjO": 1.0, "AdjH": 2.0, "AdjL": 0.5, "AdjC": 1.5, "AdjVo": 100.0 + i}
            for c in ("13010", "13050", "9")
        ]
        (landing / f"{i}.json").write_text(json.dumps({"data": data}))
    codes = ingest.select_codes(
        scan_envelopes(spark, str(tmp_path / "master.json"), TableSpec((ColumnSpec("Code"), ColumnSpec("ScaleCat")))),
        "ScaleCat",
        "^TOPIX*",
        anchored=True,
    )
    assert rows(codes) == [("13010",)]
    record = TableSpec(tuple(c for c in schemas.DAILY_BARS.columns if c.name != "ingestion_source"))
    landed = scan_envelopes(spark, str(landing), record)
    target = ingest.upsert_target(str(tmp_path / "stored"))
    window = resolve_window("bars", latest=True, today=TODAY)
    for _ in range(2):
        ingest.ingest_bars(landed, "landed", codes, window, target=target)
    out = read_table(spark, target.path)
    assert out.columns == schemas.DAILY_BARS.stored_names
    assert rows(out) == [(dt.date(2024, 3, 30), "13010", 1.0, 2.0, 0.5, 1.5, 101, "landed")]
    assert ingest.ingest_bars(landed, "landed", codes, LoadWindow(TODAY, TODAY), target=target) is None


def test_summary_schema_rules(spark):
    base = dict.fromkeys(schemas.SUMMARY.source_names, "1")
    base |= {c: "2024-01-05" for c in ("DiscDate", "CurPerSt", "CurPerEn", "CurFYSt", "CurFYEn")}
    names = [c for c in base if c != "ingestion_source"]
    schema = ", ".join(f"`{c}` string" for c in names)
    one = spark.createDataFrame([tuple(base[c] for c in names)], schema)
    out = ingest.ingest_summary(one, "landed")
    assert out.first()["Ticker"] == "1"
    with pytest.raises(ValidationError, match="DiscNo"):
        ingest.ingest_summary(one.union(one), "landed")


def test_flows(spark):
    names = [c for c in schemas.FLOW_COLUMNS if c != "ingestion_source"]
    row = tuple("2024-01-05" if c.endswith("Date") else "TSEPrime" if c == "Section" else "1.5" for c in names)
    landed = spark.createDataFrame([row], ", ".join(f"`{c}` string" for c in names))
    assert ingest.ingest_flows(landed, "landed", "TSEPrime").first()["BankBal"] == 1.5
    assert ingest.ingest_flows(landed, "landed", "TSEGrowth") is None


def statements(spark):
    def matrix(item):
        return spark.createDataFrame(
            [("7203.T", item, 1.0, 2.0), ("9999.T", item, 5.0, 6.0)], "ticker string, item string, `2023-03-31` double, `2024-03-31` double"
        )

    matrices = {
        "income_statement": matrix("Total Revenue"),
        "balance_sheet": matrix("Total Assets"),
        "cash_flow": matrix("Free Cash Flow"),
    }
    dividends = spark.createDataFrame(
        [("7203.T", {day("2024-03-30"): 10.0, day("2022-03-30"): 5.0})], "ticker string, series map<date,double>"
    )
    return matrices, dividends


def test_four_statements(spark, rows, tmp_path):
    matrices, dividends = statements(spark)
    codes = spark.createDataFrame([("72030",)], "code string")
    out = ingest.ingest_statements(matrices, dividends, "landed", "2024-01-01", codes)
    assert rows(out["income_statement"], "Date", "Ticker", "Total Revenue", "EBIT", "ingestion_source") == [
        (day("2024-03-31"), "72030", 2.0, None, "landed")
    ]
    assert out["balance_sheet"].columns == schemas.BALANCE_SHEET.stored_names
    assert rows(out["dividends"]) == [(day("2024-03-30"), "72030", 10.0, "landed")]

    targets = {name: str(tmp_path / name) for name in ingest.STATEMENT_SPECS if name != "cash_flow"}
    for _ in range(2):
        done = ingest.ingest_statements(matrices, dividends, "landed", "2024-01-01", targets=targets)
        assert done == {"income_statement": "written", "balance_sheet": "written", "cash_flow": "no path", "dividends": "written"}
    assert read_table(spark, targets["balance_sheet"]).count() == 2
    assert ingest.ingest_statements(matrices, dividends, "landed", "2024-03-31", targets=targets) is None


def test_prices(spark, rows):
    wide = spark.createDataFrame(
        [(day("2024-01-04"), 1.0, 2.0, 0.5, 1.5, 100.0, 9.0), (day("2024-01-05"), None, None, None, None, None, 9.0)],
        "Date date, `1301.T|Open` double, `1301.T|High` double, `1301.T|Low` double, `1301.T|Close` double, "
        "`1301.T|Volume` double, `^N225|Open` double",
    )
    out = ingest.ingest_prices(wide, "landed", ["13010", "40050"])
    assert rows(out) == [(day("2024-01-04"), "13010", 1.0, 2.0, 0.5, 1.5, 100.0, "landed")]
    with pytest.raises(ValidationError, match="High"):
        ingest.ingest_prices(wide, "landed", ["^N225"], listed=False)
    assert ingest.ingest_prices(wide, "landed", ["40050"]) is None


def test_filings_job(spark, rows, tmp_path):
    from tests.test_sources import zipped

    def xml(code, sales):
        meta = {
            "SecurityCodeDEI": code,
            "EDINETCodeDEI": "E" + code,
            "AccountingStandardsDEI": "Japan GAAP",
            "CurrentFiscalYearStartDateDEI": "2024-04-01",
            "CurrentFiscalYearEndDateDEI": "2025-03-31",
        }
        facts = "".join(f'<f:{t} contextRef="FilingDateInstant">{v}</f:{t}>' for t, v in meta.items())
        facts += f'<f:NetSalesSummaryOfBusinessResults contextRef="CurrentYearDuration">{sales}</f:NetSalesSummaryOfBusinessResults>'
        return f'<x xmlns:f="urn:f">{facts}</x>'

    index = [
        {"docID": "S1", "secCode": "72030", "ordinanceCode": "010", "formCode": "030000"},
        {"docID": "S2", "secCode": "13010", "ordinanceCode": "010", "formCode": "030000"},
        {"docID": "S3", "secCode": "72030", "ordinanceCode": "010", "formCode": "043000"},
    ]
    (tmp_path / "index.json").write_text(json.dumps({"results": index}))
    for doc, code, sales in (("S1", "72030", 10), ("S2", "13010", 20), ("S3", "72030", 30)):
        (tmp_path / f"{doc}.zip").write_bytes(zipped({"XBRL/PublicDoc/r.xbrl": xml(code, sales), "XBRL/x.txt": ""}))
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(str(tmp_path)).select("path", "content")
    codes = spark.createDataFrame([("72030",)], "code string")
    target = ingest.upsert_target(str(tmp_path / "stored"))
    index = scan_filing_index(spark, str(tmp_path / "index.json"))
    for _ in range(2):
        ingest.ingest_filings(index, archives, "landed", codes, target=target)
    assert rows(read_table(spark, target.path), "Ticker", "Net sales") == [("72030", 10.0)]
    assert ingest.ingest_filings(index, archives, "landed", codes.filter("code = 'none'"), target=target) is None

