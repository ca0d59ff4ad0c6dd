import io
import json
import zipfile

import pytest

from pyspark.sql import types as T

from ledgermill.checks.samples import workbook_bytes
from ledgermill.sources import archives, envelopes, files, filings, records, workbooks
from ledgermill.spec import ColumnSpec, TableRef, TableSpec


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "dummy.csv").write_text("Column1,Column2\nA,1\nB,2\nC,3\n")
    (tmp_path / "dummy1.csv").write_text("Column1,Column3,Column4\nA,1,AA\nB,,BB\nC,5,\n")
    (tmp_path / "dummy.xlsx").write_bytes(workbook_bytes(["Column1", "Column2"], [["D", 4], ["E & <f>", None]]))
    (tmp_path / "notes.txt").write_text("skipped")
    (tmp_path / "deeper").mkdir()
    (tmp_path / "deeper" / "more.csv").write_text("Column1\nZ\n")
    return tmp_path


def test_single_files(spark, rows, folder):
    df = files.load_flat_files(spark, str(folder / "dummy.csv"))
    assert rows(df) == [("A", 1), ("B", 2), ("C", 3)]
    df = files.load_flat_files(spark, str(folder / "dummy1.csv"))
    assert rows(df) == [("A", 1, "AA"), ("B", None, "BB"), ("C", 5, None)]
    df = files.load_flat_files(spark, str(folder / "dummy.xlsx"))
    assert rows(df) == [("D", 4), ("E & <f>", None)]


def test_folder(spark, rows, folder):
    df = files.load_flat_files(spark, str(folder), load_all=True)
    assert sorted(df.columns) == ["Column1", "Column2", "Column3", "Column4"]
    assert df.count() == 8
    assert rows(df.filter("Column1 = 'C'"), "Column2", "Column3") == [(3, None), (None, 5)]


def test_bad_paths(spark, folder):
    with pytest.raises(ValueError, match="load_all"):
        files.load_flat_files(spark, str(folder))
    with pytest.raises(NotImplementedError):
        files.load_flat_files(spark, str(folder / "absent"))
    with pytest.raises(ValueError, match="No .csv"):
        files.load_flat_files(spark, str(folder / "notes.txt"))


def test_null_words_and_codes(spark, rows, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('code;n;t\n01301;1;"a;b"\nNA;null;n/a\n;-nan;"say ""x"""\n')
    spec = TableSpec((ColumnSpec("code"), ColumnSpec("n", "Int"), ColumnSpec("t")))
    out = files.scan_csv(spark, str(path), spec, sep=";")
    assert rows(out) == [("01301", 1, "a;b"), (None, None, 'say "x"'), (None, None, None)]
    assert files.scan_csv(spark, str(path), sep=";").schema["code"].dataType == T.LongType()


def test_table_refs(spark, rows, folder, tmp_path):
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(str(tmp_path / "db" / "t.parquet"))
    assert rows(files.scan_table(spark, TableRef(path="t.parquet", db="db"), str(tmp_path))) == [(1, "x")]
    assert files.scan_table(spark, TableRef(path=str(folder / "dummy.csv"))).count() == 3
    spec = TableSpec((ColumnSpec("Column1"), ColumnSpec("Column2", "Float")))
    typed = files.scan_table(spark, TableRef(path=str(folder / "dummy.csv"), spec=spec))
    assert typed.schema["Column2"].dataType == T.DoubleType()
    with pytest.raises(NotImplementedError):
        files.scan_table(spark, TableRef(path=str(folder / "notes.txt")))
    with pytest.raises(ValueError):
        files.scan_table(spark, TableRef())


def test_code_lists(spark, rows, tmp_path):
    assert rows(files.code_list(spark, ["13010", "13010", "13050"])) == [("13010",), ("13050",)]
    path = tmp_path / "codes.yaml"
    path.write_text('# codes\n- "13010"\n- 13050\n- "^N225"  # index\n\n1305A\n')
    assert rows(files.code_list(spark, path=str(path))) == [("13010",), ("13050",), ("1305A",), ("^N225",)]


def test_envelopes(spark, rows, tmp_path):
    for i, body in enumerate(
        [
            {"data": [{"Code": "13010", "Close": 1.5}, {"Code": "13050"}], "pagination_key": "x"},
            {"data": []},
            {"data": None},
            {"message": "none"},
        ]
    ):
        (tmp_path / f"{i}.json").write_text(json.dumps(body, indent=1))
    record = T.StructType().add("Code", "string").add("Close", "double")
    assert rows(envelopes.scan_envelopes(spark, str(tmp_path), record)) == [("13010", 1.5), ("13050", None)]
    text = envelopes.scan_envelopes(spark, str(tmp_path), TableSpec((ColumnSpec("Close", "Float"),)), with_source=True)
    assert text.columns == ["source_path", "Close"]
    assert text.filter("Close = '1.5'").count() == 1


def test_filing_index(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"results": [{"docID": "S1", "secCode": "72030", "formCode": "030000"}]}))
    (tmp_path / "b.json").write_text(json.dumps({"metadata": {}}))
    df = envelopes.scan_filing_index(spark, str(tmp_path))
    assert [r.docID for r in df.collect()] == ["S1"]
    assert df.columns == envelopes.FILING_INDEX_FIELDS


def zipped(members):
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for name, content in members.items():
            z.writestr(name, content)
    return held.getvalue()


XML = """<?xml version="1.0" encoding="UTF-8"?>
<xbrli:xbrl xmlns:xbrli="http://www.xbrl.org/2003/instance" xmlns:p="urn:p">
 <xbrli:context id="C"><xbrli:entity/></xbrli:context>
 <p:NetSales contextRef="C" unitRef="JPY">100 &amp; 1</p:NetSales>
 <p:Nil contextRef="C" xsi:nil="true" xmlns:xsi="urn:x"/>
 <p:Tuple><p:Inner contextRef="C">7</p:Inner></p:Tuple>
 <p:Name contextRef="D">売上</p:Name>
</xbrli:xbrl>"""


def test_archives(spark, rows, tmp_path):
    (tmp_path / "S1.zip").write_bytes(zipped({"a/x.txt": "hello", "b.bin": b"\x00", "empty/": ""}))
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "S2.zip").write_bytes(zipped({"x.txt": ""}))
    df = archives.scan_archives(spark, str(tmp_path))
    assert [(r.member, bytes(r.content)) for r in df.orderBy("member").collect()] == [
        ("a/x.txt", b"hello"),
        ("b.bin", b"\x00"),
        ("x.txt", b""),
    ]
    assert archives.scan_archives(spark, str(tmp_path), r"^a/").count() == 1
    assert archives.remove_archives(spark, df.selectExpr("archive as path")) == 2
    assert not (tmp_path / "S1.zip").exists()


def test_filing_scan(spark, rows, tmp_path):
    inside = tmp_path / "S1" / "XBRL" / "PublicDoc"
    inside.mkdir(parents=True)
    (inside / "r.xbrl").write_text(XML)
    (tmp_path / "S1" / "XBRL" / "AuditDoc").mkdir()
    (tmp_path / "S1" / "XBRL" / "AuditDoc" / "a.xbrl").write_text(XML)
    df = filings.scan_filings(spark, str(tmp_path))
    assert rows(df, "fact_index", "local_name", "value", "context_id", "unit_id") == [
        (0, "NetSales", "100 & 1", "C", "JPY"),
        (1, "Nil", None, "C", None),
        (2, "Name", "売上", "D", None),
    ]
    assert df.first()["source_path"].endswith("S1/XBRL/PublicDoc/r.xbrl")


def test_filing_members(spark):
    members = spark.createDataFrame(
        [("S1.zip", "XBRL/PublicDoc/r.xbrl", XML.encode()), ("S1.zip", "XBRL/PublicDoc/r_lab.xml", b"<a/>")],
        "archive string, member string, content binary",
    )
    facts = filings.filing_facts(filings.filing_documents(members))
    assert {r.source_path for r in facts.collect()} == {"S1.zip/XBRL/PublicDoc/r.xbrl"}


def test_bad_documents(spark):
    docs = spark.createDataFrame([("good", XML.encode()), ("bad", b"<a><b></a>")], "source_path string, content binary")
    with pytest.raises(Exception, match="not a well-formed document"):
        filings.filing_facts(docs).collect()
    assert {r.source_path for r in filings.filing_facts(docs, skip_bad=True).collect()} == {"good"}


def test_long_document_leaves_in_pieces(spark):
    many = "".join(f'<f:T contextRef="C">{i}</f:T>' for i in range(60_000))
    docs = spark.createDataFrame([("d", f'<x xmlns:f="urn:f">{many}</x>'.encode())], "source_path string, content binary")
    facts = filings.filing_facts(docs)
    row = facts.selectExpr("count(*) n", "sum(int(value)) s", "count_if(int(value) = fact_index) same").first()
    assert tuple(row) == (60_000, sum(range(60_000)), 60_000)


def test_workbooks_combine_by_header(spark, rows, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook_bytes(["id", "name"], [[1, "x"], [2, "NA"]]))
    (tmp_path / "b.xlsx").write_bytes(workbook_bytes(["name", "extra"], [["y", 2.5]]))
    df = workbooks.scan_workbooks(spark, str(tmp_path))
    assert df.columns == ["extra", "id", "name"]
    assert rows(df) == [("2.5", None, "y"), (None, "1", "x"), (None, "2", None)]
    assert workbooks.scan_workbooks(spark, str(tmp_path), ["id", "absent"]).columns == ["id", "absent"]


def test_workbook_cell_kinds(spark, rows, tmp_path):
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    shared = f'<sst xmlns="{main}"><si><t>id</t></si><si><r><t>na</t></r><r><t>me</t></r></si><si><t>q</t></si></sst>'
    sheet = (
        f'<worksheet xmlns="{main}"><sheetData>'
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row>'
        '<row r="2"><c r="A2"><v>5</v></c><c r="B2"><v>9</v></c><c r="C2" t="s"><v>2</v></c></row>'
        '<row r="3"><c r="A3" t="b"><v>1</v></c><c r="C3" t="e"><v>#N/A</v></c></row>'
        "</sheetData></worksheet>"
    )
    (tmp_path / "k.xlsx").write_bytes(zipped({"xl/worksheets/sheet1.xml": sheet, "xl/sharedStrings.xml": shared}))
    assert rows(workbooks.scan_workbooks(spark, str(tmp_path), ["id", "name"])) == [("5", "q"), ("True", None)]


def test_workbook_dates_and_sheet_order(spark, rows, tmp_path):
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    link = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"

    def sheet(*cells):
        header = '<row r="1"><c r="A1" t="inlineStr"><is><t>d</t></is></c></row>'
        lines = "".join(f'<row r="{i}">{c}</row>' for i, c in enumerate(cells, start=2))
        return f'<worksheet xmlns="{main}"><sheetData>{header}{lines}</sheetData></worksheet>'

    styles = (
        f'<styleSheet xmlns="{main}"><numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm"/>'
        '<numFmt numFmtId="165" formatCode="0 &quot;days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/>'
        '<xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>'
    )
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{link}"><sheets><sheet r:id="r2"/><sheet r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/>'
        '<Relationship Id="r2" Target="worksheets/sheet2.xml"/></Relationships>',
        "xl/styles.xml": styles,
        "xl/worksheets/sheet1.xml": sheet('<c r="A2"><v>0</v></c>'),
        "xl/worksheets/sheet2.xml": sheet(
            '<c r="A2" s="1"><v>45296</v></c>', '<c r="A3" s="2"><v>45296.5</v></c>', '<c r="A4" s="3"><v>7</v></c>'
        ),
    }
    (tmp_path / "d.xlsx").write_bytes(zipped(parts))
    assert rows(workbooks.scan_workbooks(spark, str(tmp_path), ["d"])) == [("2024-01-05 12:00:00",), ("2024-01-05",), ("7",)]


def test_only_named_archives_are_opened(spark, rows, tmp_path):
    for doc in ("S1", "S2", "S3"):
        (tmp_path / f"{doc}.zip").write_bytes(zipped({"x.txt": doc}))
    wanted = spark.createDataFrame([("S1",), ("S3",), ("S9",)], "docID string")
    members = archives.expand_archives(archives.scan_named_archives(spark, str(tmp_path), wanted))
    assert sorted(bytes(r.content) for r in members.collect()) == [b"S1", b"S3"]
    none = archives.scan_named_archives(spark, str(tmp_path), wanted.filter("docID = 'S9'"))
    assert none.count() == 0


# --- delimited files with line breaks in quotes ---


def _write(path, text):
    path.write_bytes(text.encode())
    return str(path)


def _tiny_splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.minPartitionNum", "200")


@pytest.fixture
def splits(spark):
    names = ("maxPartitionBytes", "openCostInBytes", "minPartitionNum")
    yield lambda size: _tiny_splits(spark, size)
    for name in names:
        spark.conf.unset(f"spark.sql.files.{name}")


def test_quoted_line_break_and_truth_values(spark, tmp_path):
    path = _write(tmp_path / "a.csv", 'id,text,flag\n1,"x\ny",True\n2,z,False\n')
    df = files.scan_csv(spark, path)
    assert [f.dataType for f in df.schema] == [T.LongType(), T.StringType(), T.BooleanType()]
    assert sorted(map(tuple, df.collect())) == [(1, "x\ny", True), (2, "z", False)]


@pytest.mark.parametrize("size", [7, 40, 300])
def test_records_over_many_splits(spark, tmp_path, splits, size):
    import csv
    import random

    rng = random.Random(size)
    pieces = ["a", " b", '"', '""', ",", "\n", "\n\n", "x" * 30, "é", "5\" pipe", "", "\t", "id,text"]
    rows = [(str(i), "".join(rng.choices(pieces, k=rng.randint(0, 9))), rng.choice(["u", 'v"w', "", "line\nbreak"])) for i in range(150)]
    folder = tmp_path / "many"
    folder.mkdir()
    for n, part in enumerate((rows[:90], rows[90:], [])):
        with open(folder / f"{n}.csv", "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f, lineterminator="\r\n" if n else "\n")
            out.writerow(["id", "text", "a\nb"])
            out.writerows(part)
    splits(size)
    got = records.scan_records(spark, str(folder))
    assert got.columns == ["id", "text", "a\nb"]
    assert got.rdd.getNumPartitions() > 8
    want = sorted((tuple(x or None for x in r) for r in rows), key=repr)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_every_line_function_like_a_parser(spark, tmp_path):
    import itertools

    def walk(line, inside):
        """A parser's walk over one line; True when it ends inside quotes."""
        i, state = 0, "in" if inside else "start"
        while i < len(line):
            c = line[i]
            if state == "in":
                if c == '"' and line[i + 1 : i + 2] == '"':
                    i += 1
                elif c == '"':
                    state = "junk"
            elif c == ",":
                state = "start"
            elif state == "start":
                state = "in" if c == '"' else "junk"
            i += 1
        return state == "in"

    lines = ["".join(x) for n in range(7) for x in itertools.product('",a', repeat=n)]
    path = _write(tmp_path / "lines.txt", "\n".join(lines))
    got = records._lines(spark, path, ",").collect()
    assert len(got) >= len(lines) - 1
    for r in got:
        assert (r["opens"], r["stays"]) == (walk(r["line"], False), walk(r["line"], True)), r["line"]


def test_long_quoted_lines_need_no_stack(spark, tmp_path):
    text = 'a""b,' * 100_000 + "\n" + "c" * 200_000
    path = _write(tmp_path / "long.csv", f'id,text\n1,"{text}"\n2,"x"\n')
    got = files.scan_csv(spark, path).collect()
    assert sorted((r["id"], len(r["text"])) for r in got) == [(1, len(text.replace('""', '"'))), (2, 1)]


def test_open_quote_ends_with_its_file(spark, tmp_path):
    folder = tmp_path / "open"
    folder.mkdir()
    _write(folder / "a.csv", 'id,t\n1,"never closed\nmore')
    _write(folder / "b.csv", "id,t\n2,fine\n")
    got = files.scan_csv(spark, str(folder)).collect()
    assert sorted((r["id"], r["t"].rstrip("\n").strip('"')) for r in got) == [(1, "never closed\nmore"), (2, "fine")]


def test_empty_and_header_only_files(spark, tmp_path):
    path = _write(tmp_path / "h.csv", 'id,"two\nlines"\n')
    df = files.scan_csv(spark, path)
    assert df.columns == ["id", "two\nlines"] and df.count() == 0
