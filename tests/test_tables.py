import datetime as dt

import pytest

from ledgermill.hadoop import file_system, list_folders, path_exists
from ledgermill.operators import merge
from ledgermill.sinks import tables


@pytest.fixture(params=["parquet", "csv"])
def fmt(request):
    return request.param


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "db" / "table")


def frame(spark, *data, schema="id int, value string"):
    return spark.createDataFrame(list(data), schema)


def stored(spark, path, fmt, rows):
    return rows(tables.read_table(spark, path, fmt))


OLD, NEW = [(1, "A"), (2, "B")], [(2, "B2"), (3, "C")]
AFTER = {
    "overwrite": [(2, "B2"), (3, "C")],
    "append": [(1, "A"), (2, "B"), (2, "B2"), (3, "C")],
    "incremental": [(1, "A"), (2, "B"), (3, "C")],
    "upsert": [(1, "A"), (2, "B2"), (3, "C")],
}


@pytest.mark.parametrize("mode", list(AFTER))
def test_modes(spark, rows, path, fmt, mode):
    tables.write_table(frame(spark, *OLD), path, mode, ["id"], fmt)
    assert stored(spark, path, fmt, rows) == OLD
    tables.write_table(frame(spark, *NEW), path, mode, ["id"], fmt)
    assert stored(spark, path, fmt, rows) == AFTER[mode]
    assert rows(merge.merge(frame(spark, *OLD), frame(spark, *NEW), ["id"], mode)) == AFTER[mode]


@pytest.mark.parametrize("mode", ["overwrite", "incremental", "upsert"])
def test_repeating_a_write_changes_nothing(spark, rows, path, fmt, mode):
    tables.write_table(frame(spark, *OLD), path, "overwrite", fmt=fmt)
    for _ in range(3):
        tables.write_table(frame(spark, *NEW), path, mode, ["id"], fmt)
    assert stored(spark, path, fmt, rows) == AFTER[mode]


@pytest.mark.parametrize("mode", ["append", "incremental", "upsert"])
def test_evolution(spark, rows, path, fmt, mode):
    tables.write_table(frame(spark, (1, "A"), (2, "B")), path, fmt=fmt)
    new = frame(spark, (2, 2.5), (3, 3.5), schema="id int, new_col double")
    with pytest.raises(ValueError, match="value"):
        tables.write_table(new, path, mode, ["id"], fmt)
    tables.write_table(new, path, mode, ["id"], fmt, evolve=True)
    out = tables.read_table(spark, path, fmt)
    assert out.columns == ["id", "value", "new_col"]
    want = {
        "append": [(1, "A", None), (2, "B", None), (2, None, 2.5), (3, None, 3.5)],
        "incremental": [(1, "A", None), (2, "B", None), (3, None, 3.5)],
        "upsert": [(1, "A", None), (2, None, 2.5), (3, None, 3.5)],
    }
    assert rows(out) == want[mode]


def test_key_guards(spark, path):
    tables.write_table(frame(spark, *OLD), path)
    with pytest.raises(ValueError, match="existing data"):
        tables.write_table(frame(spark, *NEW), path, "upsert", ["nope"])
    with pytest.raises(ValueError, match="new data"):
        tables.write_table(frame(spark, ("B",), schema="value string"), path, "upsert", ["id"])
    tables.write_table(frame(spark, ("B",), schema="value string"), path, "upsert", ["id"], evolve=True)
    with pytest.raises(ValueError, match="needs key"):
        tables.write_table(frame(spark, *NEW), path, "upsert")
    with pytest.raises(ValueError, match="mode"):
        tables.write_table(frame(spark, *NEW), path, "archive")
    with pytest.raises(ValueError, match="format"):
        tables.write_table(frame(spark, *NEW), path, fmt="xml")


def test_repeated_new_keys(spark, rows, path):
    tables.write_table(frame(spark, *OLD), path)
    twice = frame(spark, (2, "p"), (2, "q"), (7, "r"), (7, "s"), (None, "t"), (None, "t"))
    with pytest.raises(merge.DuplicateKeyError):
        tables.write_table(twice, path, "upsert", ["id"])
    assert stored(spark, path, "parquet", rows) == OLD
    tables.write_table(twice, path, "incremental", ["id"])
    assert stored(spark, path, "parquet", rows) == [*OLD, (7, "r"), (7, "s"), (None, "t"), (None, "t")]


def test_null_keys_are_equal(spark, rows, path):
    tables.write_table(frame(spark, (None, "old"), (1, "A")), path)
    tables.write_table(frame(spark, (None, "new")), path, "upsert", ["id"])
    assert stored(spark, path, "parquet", rows) == [(1, "A"), (None, "new")]


PART = "id int, day date, value string"
D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))


def test_upsert_rewrites_only_touched_partitions(spark, rows, path):
    keys, by = ["id", "day"], ["day"]
    old = frame(spark, (1, D1, "a"), (2, D1, "b"), (1, D2, "c"), (1, None, "n"), schema=PART)
    tables.write_table(old, path, "upsert", keys, partition_by=by)
    fs, p, make = file_system(spark, path)
    untouched = f"{path}/day=2024-01-02"
    before = sorted(str(s.getPath()) for s in fs.listStatus(make(untouched)))
    new = frame(spark, (2, D1, "B"), (9, D3, "z"), (1, None, "N"), schema=PART)
    for _ in range(2):
        tables.write_table(new, path, "upsert", keys, partition_by=by)
    out = tables.read_table(spark, path)
    want = [(1, "a", D1), (1, "c", D2), (2, "B", D1), (9, "z", D3), (1, "N", None)]
    assert rows(out, "id", "value", "day") == sorted(want, key=repr)
    assert sorted(str(s.getPath()) for s in fs.listStatus(make(untouched))) == before


def test_later_writes_keep_the_partitioning(spark, rows, path):
    old = frame(spark, (1, D1, "a"), (2, D2, "b"), schema=PART)
    tables.write_table(old, path, partition_by=["day"])
    for mode, new in (("append", (3, D1, "c")), ("incremental", (4, D3, "d")), ("upsert", (2, D2, "B"))):
        tables.write_table(frame(spark, new, schema=PART), path, mode, ["id", "day"])
    assert rows(tables.read_table(spark, path), "id", "value") == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    assert sorted(f.rsplit("/", 1)[-1] for f in list_folders(spark, path)) == [f"day={d}" for d in (D1, D2, D3)]
    with pytest.raises(ValueError, match="partitioned by"):
        tables.write_table(old, path, "append", partition_by=["id"])


def test_partitioned_table_written_by_others(spark, rows, path):
    frame(spark, (1, D1, "a"), (2, D2, "b"), schema=PART).write.partitionBy("day").parquet(path)
    tables.write_table(frame(spark, (2, D2, "B"), schema=PART), path, "upsert", ["id", "day"])
    assert rows(tables.read_table(spark, path), "id", "value") == [(1, "a"), (2, "B")]
    assert len(list_folders(spark, path)) == 2


def test_empty_folder_is_no_table(spark, rows, path):
    file_system(spark, path)[0].mkdirs(file_system(spark, path)[1])
    assert not tables.table_exists(spark, path)
    tables.write_table(frame(spark, *OLD), path, "upsert", ["id"])
    assert stored(spark, path, "parquet", rows) == OLD


def test_some_touched_partitions(spark, rows, path):
    keys, by = ["id", "day"], ["day"]
    tables.write_table(frame(spark, (1, D1, "a"), (1, D2, "b"), (1, D3, "c"), schema=PART), path, "upsert", keys, partition_by=by)
    tables.write_table(frame(spark, (1, D1, "A"), (1, D2, "B"), schema=PART), path, "upsert", keys, partition_by=by)
    assert rows(tables.read_table(spark, path), "value") == [("A",), ("B",), ("c",)]


def test_two_partition_columns(spark, rows, path):
    schema = "id int, p string, q int, v string"
    keys, by = ["id", "p", "q"], ["p", "q"]
    tables.write_table(frame(spark, (1, "x", 1, "a"), (1, "y", 2, "b"), (2, None, 2, "c"), schema=schema), path, "upsert", keys, partition_by=by)
    new = frame(spark, (1, "y", 2, "B"), (2, None, 2, "C"), (3, "x", 2, "d"), schema=schema)
    tables.write_table(new, path, "upsert", keys, partition_by=by)
    assert rows(tables.read_table(spark, path), "v") == [("B",), ("C",), ("a",), ("d",)]


def test_partition_outside_the_key_moves_rows(spark, rows, path):
    tables.write_table(frame(spark, (1, D1, "a"), (2, D1, "b"), schema=PART), path, "upsert", ["id"], partition_by=["day"])
    tables.write_table(frame(spark, (1, D2, "A"), schema=PART), path, "upsert", ["id"], partition_by=["day"])
    assert rows(tables.read_table(spark, path), "id", "value") == [(1, "A"), (2, "b")]


def test_type_change_follows_new_data(spark, rows, path, fmt):
    tables.write_table(frame(spark, (1, "7"), (2, "bad")), path, fmt=fmt)
    tables.write_table(frame(spark, (3, 9), schema="id int, value bigint"), path, "append", fmt=fmt)
    assert stored(spark, path, fmt, rows) == [(1, 7), (2, None), (3, 9)]
    lost = merge.misaligned_counts(frame(spark, (1, "7"), (2, "bad")), frame(spark, (3, 9), schema="id int, value bigint"))
    assert rows(lost) == [("value", 1)]


def test_type_change_of_a_partitioned_table_keeps_every_partition(spark, rows, path):
    schema = "id int, p int, value string"
    for mode in ("upsert", "incremental"):
        tables.write_table(frame(spark, (1, 1, "7"), (2, 2, "8"), schema=schema), path, partition_by=["p"])
        new = frame(spark, (1, 1, 9), (3, 3, 10), schema="id int, p int, value bigint")
        tables.write_table(new, path, mode, ["id", "p"])
        first = 9 if mode == "upsert" else 7
        assert rows(tables.read_table(spark, path), "id", "value") == [(1, first), (2, 8), (3, 10)]


def test_csv_values_survive(spark, rows, path):
    schema = "id int, s string, d date, t timestamp, f double"
    data = [
        (1, 'say "hi", ok', D1, dt.datetime(2024, 1, 1, 10, 0, 0, 5), 0.1),
        (2, "back\\slash", None, None, 1e20),
        (3, "03", D2, dt.datetime(1999, 1, 1), None),
    ]
    tables.write_table(frame(spark, *data, schema=schema), path, fmt="csv")
    assert stored(spark, path, "csv", rows) == data


def test_cut_off_swap_is_undone(spark, rows, path):
    tables.write_table(frame(spark, *OLD), path)
    fs, p, make = file_system(spark, path)
    fs.rename(p, make(f"{path}.__old"))
    assert tables.table_exists(spark, path)
    assert stored(spark, path, "parquet", rows) == OLD  # reading leaves things as they are
    assert not path_exists(spark, path)
    tables.write_table(frame(spark, *NEW), path, "upsert", ["id"])
    assert stored(spark, path, "parquet", rows) == AFTER["upsert"]
    assert not path_exists(spark, f"{path}.__old")


def test_failed_write_keeps_the_table(spark, rows, path):
    tables.write_table(frame(spark, *OLD), path)
    broken = frame(spark, (1, "x")).selectExpr("id", "raise_error('boom') as value")
    with pytest.raises(Exception, match="boom"):
        tables.write_table(broken, path, "overwrite")
    assert stored(spark, path, "parquet", rows) == OLD


def test_existing_or_empty(spark, path):
    schema = frame(spark, *OLD).schema
    assert tables.existing_or_empty(spark, path, "parquet", schema).count() == 0
    tables.write_table(frame(spark, *OLD), path)
    assert tables.existing_or_empty(spark, path, "parquet", schema).count() == 2


def test_table_written_by_others(spark, rows, path, fmt):
    writer = frame(spark, *OLD).write
    writer.parquet(path) if fmt == "parquet" else writer.option("header", True).csv(path)
    tables.write_table(frame(spark, *NEW), path, "upsert", ["id"], fmt)
    assert stored(spark, path, fmt, rows) == AFTER["upsert"]


def test_several_tables(spark, rows, tmp_path):
    a, b = frame(spark, (1, "A")), frame(spark, (2, "B"))
    plan = {"a": (a, ["id"], str(tmp_path / "a")), "b": (b, ["id"], None)}
    assert tables.write_tables(plan, "upsert") == {"a": "written", "b": "no path"}
    assert stored(spark, str(tmp_path / "a"), "parquet", rows) == [(1, "A")]
    plan["b"] = (b.limit(0), ["id"], str(tmp_path / "b"))
    plan["a"] = (a, ["id"], str(tmp_path / "c"))
    assert tables.write_tables(plan, "upsert") == {"a": "aborted", "b": "aborted"}
    assert not path_exists(spark, str(tmp_path / "c"))


def test_snapshot(spark, tmp_path):
    path = tables.snapshot(frame(spark, *OLD), str(tmp_path), "20240105100000")
    assert path.endswith("cache_dataprep_20240105100000")
    assert spark.read.option("header", True).csv(path).count() == 2


ODD = ["", " ", "NA", "null", "NaN", None, "\\N", "\\", "\\\\", "\\n", "\\\\n", "a\nb", "\r\n", "\r", "x\\\ny", "\0", "\0a", "#c", '"', '""',
       ",", "  kept  ", "é \u0085", "N", "\\0", "\t"]


def test_csv_text_reads_back_as_written(spark, rows, path):
    data = [(i, text, text) for i, text in enumerate(ODD)]
    df = frame(spark, *data, schema="id int, `a b` string, c string")
    tables.write_table(df.where("id < 9"), path, fmt="csv")
    tables.write_table(df.where("id >= 9"), path, "append", fmt="csv")
    assert rows(tables.read_table(spark, path, "csv")) == sorted(data, key=repr)
    alone = df.select("c")
    tables.write_table(alone, path + "1", fmt="csv")
    assert rows(tables.read_table(spark, path + "1", "csv")) == rows(alone)


def test_csv_tables_from_before_keep_their_spelling(spark, rows, path):
    from ledgermill.functions.text import csv_options

    df = frame(spark, (1, "A\\b"), (2, "NA"))
    df.write.options(**csv_options()).csv(path)
    tables._write_layout(spark, path, df.schema, ())
    assert stored(spark, path, "csv", rows) == [(1, "A\\b"), (2, None)]
    tables.write_table(frame(spark, (3, "C\\n")), path, "append", fmt="csv")
    assert stored(spark, path, "csv", rows) == [(1, "A\\b"), (2, None), (3, "C\\n")]
    tables.write_table(frame(spark, (3, "null")), path, "upsert", ["id"], "csv")
    assert (3, "null") in stored(spark, path, "csv", rows)


def test_snapshot_reads_back(spark, rows, tmp_path):
    df = frame(spark, (1, "a\nb"), (2, None), (3, ""), (4, "NA"))
    at = tables.snapshot(df, str(tmp_path), "20240101000000")
    assert rows(tables.read_table(spark, at, "csv")) == rows(df)
    from ledgermill.sources.files import scan_csv

    assert rows(scan_csv(spark, at)) == rows(df)


def test_foreign_csv_table_with_line_breaks(spark, rows, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.csv").write_text('id,v\n1,"x\ny"\n2,NA\n')
    assert rows(tables.read_table(spark, str(tmp_path / "t"), "csv")) == [("1", "x\ny"), ("2", None)]


@pytest.mark.parametrize("mode", ["append", "incremental", "upsert"])
def test_emptied_partitioned_table(spark, rows, path, mode):
    df = frame(spark, (1, "A"), (2, "B"))
    tables.write_table(df.limit(0), path, partition_by=["value"])
    with pytest.raises(ValueError, match="value"):
        tables.write_table(frame(spark, (1,), schema="id int"), path, mode, ["id"])
    with pytest.raises(ValueError, match="not found in existing"):
        tables.write_table(df.withColumnRenamed("id", "key"), path, mode, ["key"], evolve=True)
    if mode == "upsert":
        with pytest.raises(merge.DuplicateKeyError):
            tables.write_table(df.union(df), path, mode, ["id"])
    tables.write_table(df, path, mode, ["id"])
    assert [f.rsplit("/", 1)[-1] for f in list_folders(spark, path)] == ["value=A", "value=B"]
    assert stored(spark, path, "parquet", rows) == [(1, "A"), (2, "B")]
