import datetime as dt

import pytest

from ledgermill.sinks.tables import read_table
from ledgermill.spec import ColumnSpec, TableSpec, TargetSpec
from ledgermill.streaming.upsert import merge_batch, read_landing, upsert_stream

SPEC = TableSpec(
    (
        ColumnSpec("Code", "String", nullable=False, rename="Ticker", primary_key=True),
        ColumnSpec("Date", "Date", nullable=False, primary_key=True, partition_key=True),
        ColumnSpec("C", "Float", rename="Close"),
        ColumnSpec("ingestion_source", "String", nullable=False),
    )
)
SCHEMA = "Code string, Date string, C string"
D1, D2 = dt.date(2024, 1, 4), dt.date(2024, 1, 5)


@pytest.fixture
def job(spark, tmp_path):
    landing, state = str(tmp_path / "landing"), str(tmp_path / "state")
    target = TargetSpec(str(tmp_path / "table"), mode="upsert")

    def land(*data):
        spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.mode("append").json(landing)

    def run(target=target, **options):
        rows = read_landing(spark, landing, spark.createDataFrame([], SCHEMA).schema, "json", **options)
        upsert_stream(rows, SPEC, target, state, source="landed").awaitTermination()

    return land, run, target


def test_waves_are_merged(spark, rows, job):
    land, run, target = job
    land(("1", "2024-01-04", "1.5"), ("2", "2024-01-04", "bad"))
    run()
    assert rows(read_table(spark, target.path), "Ticker", "Date", "Close") == [("1", D1, 1.5), ("2", D1, None)]
    land(("2", "2024-01-04", "2.5"), ("1", "2024-01-05", "3.5"))
    run()
    run()  # nothing new
    want = [("1", D1, 1.5), ("1", D2, 3.5), ("2", D1, 2.5)]
    assert rows(read_table(spark, target.path), "Ticker", "Date", "Close") == want


def test_many_small_batches(spark, rows, job):
    land, run, target = job
    for i in range(4):
        land(("1", "2024-01-04", str(i)), (str(i + 10), "2024-01-05", "0"))
    run(max_files_per_trigger=1)
    out = rows(read_table(spark, target.path), "Ticker", "Close")
    assert out[0] == ("1", 3.0) and len(out) == 5


def test_batch_again_changes_nothing(spark, rows, tmp_path):
    target = TargetSpec(str(tmp_path / "table"), mode="upsert")
    batch = spark.createDataFrame(
        [("1", "2024-01-04", "1", 1), ("1", "2024-01-04", "2", 2), ("2", "2024-01-04", "9", 1)], SCHEMA + ", at int"
    )
    for _ in range(2):
        merge_batch(batch, SPEC, target, ["at"], "landed")
    assert rows(read_table(spark, target.path), "Ticker", "Close") == [("1", 2.0), ("2", 9.0)]
    merge_batch(batch.limit(0), SPEC, target, ["at"], "landed")


def test_insert_only(spark, rows, tmp_path):
    target = TargetSpec(str(tmp_path / "table"), mode="incremental")
    first = spark.createDataFrame([("1", "2024-01-04", "1", 1)], SCHEMA + ", at int")
    merge_batch(first, SPEC, target, ["at"], "landed")
    merge_batch(first.selectExpr("Code", "Date", "'7' as C", "at"), SPEC, target, ["at"], "landed")
    assert rows(read_table(spark, target.path), "Ticker", "Close") == [("1", 1.0)]


def test_bad_targets(spark, job, tmp_path):
    land, run, _ = job
    land(("1", "2024-01-04", "1"))
    with pytest.raises(ValueError, match="stream can only"):
        run(TargetSpec(str(tmp_path / "x"), mode="append"))
    rows = read_landing(spark, str(tmp_path / "landing"), spark.createDataFrame([], SCHEMA).schema, "json")
    with pytest.raises(ValueError, match="key columns"):
        upsert_stream(rows, TableSpec((ColumnSpec("Code"),)), TargetSpec("x", mode="upsert"), "y")
