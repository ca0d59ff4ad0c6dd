import pytest

from ledgermill import schemas
from ledgermill.spec import ColumnSpec, TableSpec


def test_keys_use_stored_names():
    spec = TableSpec.from_dict(
        {
            "schemas": {
                "Code": {"type": "String", "primary_key": True, "new_column": "Ticker"},
                "Date": {"type": "Date", "primary_key": True, "partition_key": True},
                "v": {"type": "Float", "nullable": False, "unique": True},
            }
        }
    )
    assert spec.primary_keys == ["Ticker", "Date"]
    assert spec.partition_columns == ["Date"]
    assert spec.columns[2] == ColumnSpec("v", "Float", nullable=False, unique=True)
    assert [f.name for f in spec.stored_schema] == ["Ticker", "Date", "v"]


def test_no_keys():
    spec = TableSpec((ColumnSpec("a"),))
    assert spec.primary_keys == [] and spec.partition_columns == []


def test_bad_specs():
    with pytest.raises(ValueError):
        TableSpec((ColumnSpec("a", "Nope"),))
    with pytest.raises(ValueError):
        TableSpec((ColumnSpec("a"), ColumnSpec("a")))
    with pytest.raises(ValueError):
        TableSpec((ColumnSpec("a"), ColumnSpec("b", rename="a")))


@pytest.mark.parametrize(
    "name,columns,keys",
    [
        ("filings", 22, ["Ticker", "Edinet code", "Period start date", "Period end date"]),
        ("summary", 24, ["Ticker", "DocType", "CurPerType", "CurPerSt", "CurPerEn", "CurFYSt", "CurFYEn"]),
        ("investor_flows", 55, ["PubDate", "StDate", "EnDate", "Section"]),
        ("daily_bars", 8, ["Date", "Ticker"]),
        ("balance_sheet", 58, ["date", "ticker"]),
        ("cash_flow", 50, ["date", "ticker"]),
        ("income_statement", 48, ["Date", "Ticker"]),
        ("dividends", 4, ["date", "ticker"]),
        ("exchange_prices", 8, ["Date", "Ticker"]),
    ],
)
def test_shipped_specs(name, columns, keys):
    spec = schemas.ALL[name]
    assert len(spec.columns) == columns
    assert spec.primary_keys == keys
    assert spec.columns[-1] == ColumnSpec("ingestion_source", "String", nullable=False)


def test_shipped_details():
    assert [c.name for c in schemas.SUMMARY.columns if c.unique] == ["DiscNo"]
    assert "InsCoSell" not in schemas.INVESTOR_FLOWS.source_names
    assert schemas.DAILY_BARS.types["AdjVo"] == "Int"
    assert "Cash equilavents" not in schemas.FILINGS.source_names
