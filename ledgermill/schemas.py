"""The shipped table specs.

All values below are fixed: column names, their order, keys, renames and null rules of tables that already exist.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from ledgermill.spec import ColumnSpec, TableSpec


def _table(
    name: str,
    columns: Sequence[str],
    *,
    dates: Sequence[str] = (),
    texts: Sequence[str] = (),
    wholes: Sequence[str] = (),
    required: Sequence[str] = (),
    keys: Sequence[str] = (),
    unique: Sequence[str] = (),
    renames: Mapping[str, str] | None = None,
) -> TableSpec:
    """Columns are floats unless listed otherwise; ``keys`` are source names."""
    kinds = {**dict.fromkeys(dates, "Date"), **dict.fromkeys(texts, "String"), **dict.fromkeys(wholes, "Int")}
    return TableSpec(
        tuple(
            ColumnSpec(
                c,
                kinds.get(c, "Float"),
                nullable=c not in required,
                unique=c in unique,
                rename=(renames or {}).get(c),
                primary_key=c in keys,
            )
            for c in columns
        ),
        name,
    )


# Columns of the filing table.
FILING_COLUMNS = [
    "Ticker",
    "Edinet code",
    "Period start date",
    "Period end date",
    "Account standard",
    "Net sales",
    "Operating profit",
    "Earnings before interest and taxes",
    "Profit",
    "Comprehensive profit",
    "Operating cashflow",
    "Investing cashflow",
    "Financing cashflow",
    "Equity",
    "Total assests",
    "Equity to assets",
    "Book value per share",
    "Earning per share",
    "Price earnings ratios",
    "Employees",
    "source_path",
    "ingestion_source",
]

FILINGS = _table(
    "filings",
    FILING_COLUMNS,
    dates=["Period start date", "Period end date"],
    texts=["Ticker", "Edinet code", "Account standard", "source_path", "ingestion_source"],
    required=[
        "Ticker", "Edinet code", "Period start date", "Period end date", "Account standard", "Net sales",
        "source_path", "ingestion_source",
    ],
    keys=["Ticker", "Edinet code", "Period start date", "Period end date"],
)

# Columns of the statement-summary table.
SUMMARY_COLUMNS = [
    "DiscDate", "Code", "DiscNo", "DocType", "CurPerType", "CurPerSt", "CurPerEn", "CurFYSt", "CurFYEn",
    "Sales", "OP", "OdP", "NP", "EPS", "DEPS", "TA", "Eq", "EqAR", "BPS", "CFO", "CFI", "CFF", "CashEq",
    "ingestion_source",
]

SUMMARY = _table(
    "summary",
    SUMMARY_COLUMNS,
    dates=["DiscDate", "CurPerSt", "CurPerEn", "CurFYSt", "CurFYEn"],
    texts=["Code", "DiscNo", "DocType", "CurPerType", "ingestion_source"],
    required=[
        "DiscDate", "Code", "DiscNo", "DocType", "CurPerType", "CurPerSt", "CurPerEn", "CurFYSt", "CurFYEn",
        "Sales", "NP", "TA", "Eq", "EqAR", "ingestion_source",
    ],
    keys=["Code", "DocType", "CurPerType", "CurPerSt", "CurPerEn", "CurFYSt", "CurFYEn"],
    unique=["DiscNo"],
    renames={"Code": "Ticker"},
)

# Columns of the investor-flow table.
FLOW_COLUMNS = [
    "PubDate",
    "StDate",
    "EnDate",
    "Section",
    "PropSell",
    "PropBuy",
    "PropTot",
    "PropBal",
    "BrkSell",
    "BrkBuy",
    "BrkTot",
    "BrkBal",
    "TotSell",
    "TotBuy",
    "TotBal",
    "IndSell",
    "IndBuy",
    "IndTot",
    "IndBal",
    "FrgnSell",
    "FrgnBuy",
    "FrgnTot",
    "FrgnBal",
    "SecCoSell",
    "SecCoBuy",
    "SecCoTot",
    "SecCoBal",
    "InvTrSell",
    "InvTrBuy",
    "InvTrTot",
    "InvTrBal",
    "BusCoSell",
    "BusCoBuy",
    "BusCoTot",
    "BusCoBal",
    "OthCoSell",
    "OthCoBuy",
    "OthCoTot",
    "OthCoBal",
    "InsCoBuy",
    "InsCoTot",
    "InsCoBal",
    "BankSell",
    "BankBuy",
    "BankTot",
    "BankBal",
    "TrstBnkSell",
    "TrstBnkBuy",
    "TrstBnkTot",
    "TrstBnkBal",
    "OthFinSell",
    "OthFinBuy",
    "OthFinTot",
    "OthFinBal",
    "ingestion_source",
]

INVESTOR_FLOWS = _table(
    "investor_flows",
    FLOW_COLUMNS,
    dates=["PubDate", "StDate", "EnDate"],
    texts=["Section", "ingestion_source"],
    required=FLOW_COLUMNS,
    keys=["PubDate", "StDate", "EnDate", "Section"],
)

DAILY_BARS = _table(
    "daily_bars",
    ["Date", "Code", "AdjO", "AdjH", "AdjL", "AdjC", "AdjVo", "ingestion_source"],
    dates=["Date"],
    texts=["Code", "ingestion_source"],
    wholes=["AdjVo"],
    required=["Date", "Code", "ingestion_source"],
    keys=["Date", "Code"],
    renames={
        "Code": "Ticker",
        "AdjO": "Open price",
        "AdjH": "High price",
        "AdjL": "Low price",
        "AdjC": "Close price",
        "AdjVo": "Transaction volume",
    },
)

# Items of the balance sheet.
BALANCE_SHEET_ITEMS = [
    "Treasury Shares Number",
    "Ordinary Shares Number",
    "Share Issued",
    "Net Debt",
    "Total Debt",
    "Tangible Book Value",
    "Invested Capital",
    "Working Capital",
    "Net Tangible Assets",
    "Common Stock Equity",
    "Total Capitalization",
    "Total Equity Gross Minority Interest",
    "Minority Interest",
    "Stockholders Equity",
    "Other Equity Interest",
    "Treasury Stock",
    "Retained Earnings",
    "Additional Paid In Capital",
    "Capital Stock",
    "Common Stock",
    "Total Liabilities Net Minority Interest",
    "Total Non Current Liabilities Net Minority Interest",
    "Other Non Current Liabilities",
    "Non Current Pension And Other Postretirement Benefit Plans",
    "Tradeand Other Payables Non Current",
    "Non Current Deferred Taxes Liabilities",
    "Long Term Debt And Capital Lease Obligation",
    "Long Term Debt",
    "Current Liabilities",
    "Other Current Liabilities",
    "Current Debt And Capital Lease Obligation",
    "Current Debt",
    "Payables",
    "Total Tax Payable",
    "Accounts Payable",
    "Total Assets",
    "Total Non Current Assets",
    "Other Non Current Assets",
    "Non Current Deferred Taxes Assets",
    "Other Investments",
    "Investmentin Financial Assets",
    "Available For Sale Securities",
    "Long Term Equity Investment",
    "Goodwill And Other Intangible Assets",
    "Other Intangible Assets",
    "Net PPE",
    "Current Assets",
    "Other Current Assets",
    "Assets Held For Sale Current",
    "Inventory",
    "Accounts Receivable",
    "Gross Accounts Receivable",
    "Cash Cash Equivalents And Short Term Investments",
    "Other Short Term Investments",
    "Cash And Cash Equivalents",
]

# Items of the cash-flow statement.
CASH_FLOW_ITEMS = [
    "Free Cash Flow",
    "Repurchase Of Capital Stock",
    "Repayment Of Debt",
    "Issuance Of Debt",
    "Capital Expenditure",
    "End Cash Position",
    "Other Cash Adjustment Outside Changein Cash",
    "Beginning Cash Position",
    "Effect Of Exchange Rate Changes",
    "Changes In Cash",
    "Financing Cash Flow",
    "Net Other Financing Charges",
    "Common Stock Dividend Paid",
    "Net Common Stock Issuance",
    "Common Stock Payments",
    "Net Issuance Payments Of Debt",
    "Net Short Term Debt Issuance",
    "Net Long Term Debt Issuance",
    "Long Term Debt Payments",
    "Long Term Debt Issuance",
    "Investing Cash Flow",
    "Net Investment Purchase And Sale",
    "Sale Of Investment",
    "Net Investment Properties Purchase And Sale",
    "Sale Of Investment Properties",
    "Purchase Of Investment Properties",
    "Net Business Purchase And Sale",
    "Sale Of Business",
    "Purchase Of Business",
    "Net PPE Purchase And Sale",
    "Sale Of PPE",
    "Purchase Of PPE",
    "Operating Cash Flow",
    "Taxes Refund Paid",
    "Interest Received Cfo",
    "Interest Paid Cfo",
    "Dividend Received Cfo",
    "Change In Working Capital",
    "Change In Payable",
    "Change In Inventory",
    "Change In Receivables",
    "Other Non Cash Items",
    "Deferred Tax",
    "Depreciation And Amortization",
    "Depreciation",
    "Gain Loss On Sale Of PPE",
    "Net Income From Continuing Operations",
]

# Items of the income statement.
INCOME_STATEMENT_ITEMS = [
    "Tax Effect Of Unusual Items",
    "Tax Rate For Calcs",
    "Normalized EBITDA",
    "Total Unusual Items",
    "Total Unusual Items Excluding Goodwill",
    "Net Income From Continuing Operation Net Minority Interest",
    "Reconciled Depreciation",
    "Reconciled Cost Of Revenue",
    "EBITDA",
    "EBIT",
    "Net Interest Income",
    "Interest Expense",
    "Interest Income",
    "Normalized Income",
    "Net Income From Continuing And Discontinued Operation",
    "Total Expenses",
    "Diluted Average Shares",
    "Basic Average Shares",
    "Diluted EPS",
    "Basic EPS",
    "Diluted NI Availto Com Stockholders",
    "Net Income Common Stockholders",
    "Otherunder Preferred Stock Dividend",
    "Net Income",
    "Minority Interests",
    "Net Income Including Noncontrolling Interests",
    "Net Income Continuous Operations",
    "Tax Provision",
    "Pretax Income",
    "Other Non Operating Income Expenses",
    "Special Income Charges",
    "Other Special Charges",
    "Impairment Of Capital Assets",
    "Net Non Operating Interest Income Expense",
    "Interest Expense Non Operating",
    "Interest Income Non Operating",
    "Operating Income",
    "Operating Expense",
    "Other Operating Expenses",
    "Selling General And Administration",
    "General And Administrative Expense",
    "Gross Profit",
    "Cost Of Revenue",
    "Total Revenue",
    "Operating Revenue",
]


def _statement(name: str, items: Sequence[str], renames: Mapping[str, str] | None = None) -> TableSpec:
    return _table(
        name,
        ["date", "ticker", *items, "ingestion_source"],
        dates=["date"],
        texts=["ticker", "ingestion_source"],
        required=["date", "ticker", "ingestion_source"],
        keys=["date", "ticker"],
        renames=renames,
    )


BALANCE_SHEET = _statement("balance_sheet", BALANCE_SHEET_ITEMS)
CASH_FLOW = _statement("cash_flow", CASH_FLOW_ITEMS)
INCOME_STATEMENT = _statement("income_statement", INCOME_STATEMENT_ITEMS, {"date": "Date", "ticker": "Ticker"})

DIVIDENDS = _table(
    "dividends",
    ["date", "ticker", "Dividends", "ingestion_source"],
    dates=["date"],
    texts=["ticker", "ingestion_source"],
    required=["date", "ticker", "Dividends", "ingestion_source"],
    keys=["date", "ticker"],
)

PRICE_FIELDS = ["Open", "High", "Low", "Close", "Volume"]
EXCHANGE_PRICES = _table(
    "exchange_prices",
    ["date", "ticker", *PRICE_FIELDS, "ingestion_source"],
    dates=["date"],
    texts=["ticker", "ingestion_source"],
    required=["date", "ticker", *PRICE_FIELDS, "ingestion_source"],
    keys=["date", "ticker"],
    renames={"date": "Date", "ticker": "Ticker"},
)

ALL = {
    s.name: s
    for s in (
        FILINGS, SUMMARY, INVESTOR_FLOWS, DAILY_BARS, BALANCE_SHEET, CASH_FLOW, INCOME_STATEMENT, DIVIDENDS,
        EXCHANGE_PRICES,
    )
}
