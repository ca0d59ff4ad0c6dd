import uuid

import pytest

from ledgermill.hadoop import list_folders
from ledgermill.operators import merge
from ledgermill.plans.ingest import finish
from ledgermill.sinks.catalogue import catalogue_rows, write_catalogue_table
from ledgermill.spec import ColumnSpec, TableSpec, TargetSpec


@pytest.fixture
def table(spark, tmp_path):
    """A name that no table has, and where its files go."""
    name = f"t_{uuid.uuid4().hex}"
    yield name, str(tmp_path / name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def frame(spark, *data, schema="id int, value string"):
    return spark.createDataFrame(list(data), schema)


OLD, NEW = [(1, "A"), (2, "B"), (None, "n")], [(2, "B2"), (3, "C")]
AFTER = {
    "overwrite": NEW,
    "append": OLD + NEW,
    "incremental": [*OLD, (3, "C")],
    "upsert": [(1, "A"), (2, "B2"), (3, "C"), (None, "n")],
}


@pytest.mark.parametrize("mode", list(AFTER))
def test_modes(spark, rows, table, mode):
    name, path = table
    write_catalogue_table(frame(spark, *OLD), name, mode, ["id"], location=path)
    for _ in range(1 if mode == "append" else 2):
        write_catalogue_table(frame(spark, *NEW), name, mode, ["id"])
    assert rows(catalogue_rows(spark, name)) == sorted(AFTER[mode], key=repr)


def test_an_upsert_that_reads_its_target(spark, rows, table):
    name, path = table
    write_catalogue_table(frame(spark, *OLD), name, location=path)
    write_catalogue_table(spark.table(name).selectExpr("id", "upper(concat(value, '!')) as value"), name, "upsert", ["id"])
    assert rows(catalogue_rows(spark, name)) == sorted([(1, "A!"), (2, "B!"), (None, "N!")], key=repr)


def test_touched_partitions_only(spark, rows, table):
    name, path = table
    schema = "id int, value string, day string"
    write_catalogue_table(frame(spark, (1, "a", "x"), (2, "b", "y"), (3, "c", None), schema=schema), name, "append",
                          partition_by=["day"], location=path)
    before = {f: spark.read.parquet(f).inputFiles() for f in list_folders(spark, path)}
    write_catalogue_table(frame(spark, (2, "B", "y"), (4, "d", "z"), schema=schema), name, "upsert", ["id", "day"])
    assert rows(catalogue_rows(spark, name)) == sorted([(1, "a", "x"), (2, "B", "y"), (3, "c", None), (4, "d", "z")], key=repr)
    for folder, files in before.items():
        same = spark.read.parquet(folder).inputFiles() == files
        assert same == (not folder.endswith("day=y")), folder
    with pytest.raises(ValueError, match="partitioned by"):
        write_catalogue_table(frame(spark, (1, "a", "x"), schema=schema), name, "append", partition_by=["value"])


@pytest.mark.parametrize("mode", ["append", "incremental", "upsert"])
def test_new_columns_and_types(spark, rows, table, mode):
    name, path = table
    write_catalogue_table(frame(spark, (1, "5")), name, location=path)
    wider = frame(spark, (2, "6", 7.5), schema="id int, value string, extra double")
    write_catalogue_table(wider, name, mode, ["id"], evolve=True)
    assert rows(catalogue_rows(spark, name)) == sorted([(1, "5", None), (2, "6", 7.5)], key=repr)
    with pytest.raises(ValueError, match="extra"):
        write_catalogue_table(frame(spark, (3, "8")), name, mode, ["id"])
    number = frame(spark, (3, 8, 9.5), schema="id int, value int, extra double")
    write_catalogue_table(number, name, mode, ["id"])
    assert rows(catalogue_rows(spark, name)) == sorted([(1, 5, None), (2, 6, 7.5), (3, 8, 9.5)], key=repr)
    assert catalogue_rows(spark, name).schema["value"].dataType.simpleString() == "int"


def test_guards(spark, table):
    name, path = table
    twice = frame(spark, (1, "a"), (1, "b"))
    with pytest.raises(merge.DuplicateKeyError):
        write_catalogue_table(twice, name, "upsert", ["id"], location=path)
    write_catalogue_table(frame(spark, *OLD), name, location=path)
    with pytest.raises(merge.DuplicateKeyError):
        write_catalogue_table(twice, name, "upsert", ["id"])
    with pytest.raises(ValueError, match="not found in existing"):
        write_catalogue_table(frame(spark, *OLD), name, "upsert", ["key"], evolve=True)


def test_ingest_into_the_catalogue(spark, rows, table):
    name, path = table
    spec = TableSpec((ColumnSpec("id", "Int", nullable=False, primary_key=True), ColumnSpec("value")), "kept")
    target = TargetSpec(path, table=name, mode="upsert")
    finish(frame(spark, (1, "A"), (2, "B")), spec, None, target)
    out = finish(frame(spark, (2, "B2")), spec, None, target)
    assert rows(out) == [(1, "A"), (2, "B2")]
    with pytest.raises(ValueError, match="path or a table"):
        finish(frame(spark, (1, "A")), spec, None, TargetSpec())
