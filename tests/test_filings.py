import datetime as dt

import pytest

from ledgermill import schemas
from ledgermill.operators import filings
from ledgermill.operators.validate import validate
from ledgermill.operators.project import with_ingestion_metadata

SCHEMA = (
    "source_path string, fact_index bigint, local_name string, value string, context_id string, unit_id string, label string"
)
NOW = "FilingX_CurrentYearDuration"


def document(path, standard="Japan GAAP", code="7203", values=(), skip=(), extra=()):
    meta = [
        ("SecurityCodeDEI", code),
        ("EDINETCodeDEI", "E00001"),
        ("AccountingStandardsDEI", standard),
        ("CurrentFiscalYearStartDateDEI", "2024-04-01"),
        ("CurrentFiscalYearEndDateDEI", "2025-03-31"),
    ]
    rows = [(t, v, "FilingDateInstant", None, None) for t, v in meta if t not in skip] + list(extra)
    rows += [(t, v, c, u, lab) for t, v, c, u, lab in values]
    return [(path, i, t, v, c, u, lab) for i, (t, v, c, u, lab) in enumerate(rows)]


def fact(tag, value, context=NOW, unit="JPY", label=None):
    return (tag, value, context, unit, label)


def normalise(spark, *documents):
    facts = spark.createDataFrame([r for d in documents for r in d], SCHEMA)
    return {r["source_path"]: r.asDict() for r in filings.normalise_filing_facts(facts).collect()}


EIGHT = document(
    "a.xbrl",
    values=[
        fact("NetSalesSummaryOfBusinessResults", "100000"),
        fact("OperatingIncome", "20000"),
        fact("ProfitLossAttributableToOwnersOfParentSummaryOfBusinessResults", "15000"),
    ],
)


def test_eight_facts(spark):
    out = normalise(spark, EIGHT)
    row = out["a.xbrl"]
    assert (row["Ticker"], row["Edinet code"], row["Account standard"]) == ("7203", "E00001", "Japan GAAP")
    assert (row["Net sales"], row["Operating profit"], row["Profit"]) == (100000.0, 20000.0, 15000.0)
    assert list(row) == [*filings.DOCUMENT_TAGS.values(), *filings.ATTRIBUTES, "source_path"]
    assert row["Equity"] is None


def test_mean_of_distinct_facts(spark):
    sales, revenue = "NetSalesSummaryOfBusinessResults", "RevenueSummaryOfBusinessResults"
    values = [
        fact(sales, "10"),
        fact(sales, "10"),  # the same fact again counts once
        fact(sales, "40", "CurrentYearDuration_NonConsolidatedMember"),
        fact(sales, "999", "Prior1YearDuration"),
        fact(sales, "999", "CurrentYearDuration_Segment"),
        fact(revenue, "10"),  # another tag of the attribute is another fact
        fact(sales, "bad", "CurrentYearInstant"),
        fact("Unknown", "5"),
    ]
    assert normalise(spark, document("d", values=values))["d"]["Net sales"] == pytest.approx(20.0)


def test_label_decides_when_given(spark):
    sales, revenue = "NetSalesSummaryOfBusinessResults", "RevenueSummaryOfBusinessResults"
    values = [fact(sales, "10", label="x"), fact(revenue, "10", label="x"), fact(revenue, "40", label="x")]
    assert normalise(spark, document("d", values=values))["d"]["Net sales"] == 25.0


def test_documents_without_rows(spark):
    value = [fact("NumberOfEmployees", "5")]
    out = normalise(
        spark,
        document("known", "IFRS", values=value),
        document("unknown standard", "Other GAAP", values=value),
        document("no standard", values=value, skip=["AccountingStandardsDEI"]),
        document("no code", values=value, skip=["SecurityCodeDEI"]),
        document("no numbers", values=[fact("NumberOfEmployees", "many")]),
        document("no facts"),
    )
    assert set(out) == {"known"}
    assert out["known"]["Employees"] == 5.0


def test_each_standard_reads_its_own_tags(spark):
    values = [fact("NetAssetsSummaryOfBusinessResults", "7"), fact("EquityIFRS", "8")]
    out = normalise(
        spark,
        document("jp", values=values),
        document("ifrs", "IFRS", values=values),
        document("us", "US GAAP", values=values),
    )
    assert {p: r["Equity"] for p, r in out.items()} == {"jp": 7.0, "ifrs": 8.0, "us": 7.0}


def test_last_metadata_wins(spark):
    extra = [("SecurityCodeDEI", "9999", "FilingDateInstant", None, None)]
    out = normalise(spark, document("d", values=[fact("NumberOfEmployees", "5")], extra=extra))
    assert out["d"]["Ticker"] == "9999"


def test_missing_standards_are_listed(spark):
    facts = spark.createDataFrame(document("a") + document("b", "?") + document("c", skip=["AccountingStandardsDEI"]), SCHEMA)
    assert sorted(r[0] for r in filings.filings_without_standard(facts).collect()) == ["b", "c"]


def test_dictionary_sizes():
    assert {s: len(t) for s, t in filings.TAG_DICTIONARY.items()} == {"Japan GAAP": 24, "IFRS": 25, "US GAAP": 18}
    assert len(filings.ATTRIBUTES) == 16
    assert {a for t in filings.TAG_DICTIONARY.values() for a in t.values()} == set(filings.ATTRIBUTES)


def test_validated_row(spark):
    facts = spark.createDataFrame(EIGHT, SCHEMA)
    df = with_ingestion_metadata(filings.normalise_filing_facts(facts), "landed")
    row = validate(df, schemas.FILINGS).first()
    assert row["Period start date"] == dt.date(2024, 4, 1)
    assert "Cash equilavents" not in row.asDict()


def test_ledger_and_rows_are_all_documents(spark):
    nothing = document("e.xbrl", values=[fact("Unknown", "1")])
    bad = [document("b.xbrl", standard="US rules", values=[fact("OperatingIncome", "1")]), document("c.xbrl", skip=("AccountingStandardsDEI",)),
           document("d.xbrl", skip=("EDINETCodeDEI",), values=[fact("OperatingIncome", "1")]), nothing,
           document("f.xbrl", values=[fact("OperatingIncome", "n/a")])]
    facts = spark.createDataFrame([r for d in [EIGHT, *bad] for r in d], SCHEMA)
    every = spark.createDataFrame([(f"{c}.xbrl",) for c in "abcdefg"], "source_path string")
    lost = {r["source_path"]: r["reason"] for r in filings.filing_ledger(facts, every).collect()}
    assert lost == {
        "b.xbrl": "unknown accounting standard US rules", "c.xbrl": "no accounting standard", "d.xbrl": "no Edinet code",
        "e.xbrl": "no value", "f.xbrl": "no value", "g.xbrl": "no facts",
    }
    given = {r["source_path"] for r in filings.normalise_filing_facts(facts).collect()}
    assert given | set(lost) == {f"{c}.xbrl" for c in "abcdefg"} and not given & set(lost)
    assert filings.filing_ledger(facts).count() == 5
