"""Filing facts of all documents to one wide row per document.

Facts of every filing are handled in one go: document metadata (last occurrence wins), tag dictionary, current-year
contexts, distinct facts, numbers, mean per attribute.

No step gathers a document in one task: distinct, mean and last-wins are pre-aggregated, and the document metadata is
joined to the finished wide rows rather than to the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions.coerce import to_double
from ledgermill.names import col, require_columns
from ledgermill.operators.filters import ends_with_any
from ledgermill.operators.reshape import pivot_mean

# Tags of the document metadata and the columns they fill.
DOCUMENT_TAGS = {
    "SecurityCodeDEI": "Ticker",
    "EDINETCodeDEI": "Edinet code",
    "CurrentFiscalYearStartDateDEI": "Period start date",
    "CurrentFiscalYearEndDateDEI": "Period end date",
    "AccountingStandardsDEI": "Account standard",
}

# Endings of the context ids that mean the current year.
CURRENT_YEAR_CONTEXTS = [
    "CurrentYearDuration",
    "CurrentYearDuration_NonConsolidatedMember",
    "CurrentYearInstant",
    "CurrentYearInstant_NonConsolidatedMember",
]

# The attributes of a filing row (two of them misspelt in stored tables, and kept so).
ATTRIBUTES = [
    "Net sales",
    "Operating profit",
    "Earnings before interest and taxes",
    "Profit",
    "Comprehensive profit",
    "Operating cashflow",
    "Investing cashflow",
    "Financing cashflow",
    "Cash equilavents",
    "Equity",
    "Total assests",
    "Equity to assets",
    "Book value per share",
    "Earning per share",
    "Price earnings ratios",
    "Employees",
]

# Accounting standard -> tag -> attribute.
TAG_DICTIONARY = {
    "Japan GAAP": {
        "NetSalesSummaryOfBusinessResults": "Net sales",
        "OrdinaryIncomeSummaryOfBusinessResults": "Net sales",
        "OperatingRevenue1SummaryOfBusinessResults": "Net sales",
        "OperatingRevenue2SummaryOfBusinessResults": "Net sales",
        "RevenueKeyFinancialData": "Net sales",
        "RevenueSummaryOfBusinessResults": "Net sales",
        "OperatingIncomeINS": "Net sales",
        "OperatingIncome": "Operating profit",
        "OperatingRevenue1": "Operating profit",
        "IncomeBeforeIncomeTaxes": "Earnings before interest and taxes",
        "ProfitLossAttributableToOwnersOfParentSummaryOfBusinessResults": "Profit",
        "NetIncomeLossSummaryOfBusinessResults": "Profit",
        "ComprehensiveIncomeSummaryOfBusinessResults": "Comprehensive profit",
        "NetCashProvidedByUsedInOperatingActivitiesSummaryOfBusinessResults": "Operating cashflow",
        "NetCashProvidedByUsedInInvestingActivitiesSummaryOfBusinessResults": "Investing cashflow",
        "NetCashProvidedByUsedInFinancingActivitiesSummaryOfBusinessResults": "Financing cashflow",
        "CashAndCashEquivalentsSummaryOfBusinessResults": "Cash equilavents",
        "NetAssetsSummaryOfBusinessResults": "Equity",
        "TotalAssetsSummaryOfBusinessResults": "Total assests",
        "EquityToAssetRatioSummaryOfBusinessResults": "Equity to assets",
        "NetAssetsPerShareSummaryOfBusinessResults": "Book value per share",
        "BasicEarningsLossPerShareSummaryOfBusinessResults": "Earning per share",
        "PriceEarningsRatioSummaryOfBusinessResults": "Price earnings ratios",
        "NumberOfEmployees": "Employees",
    },
    "IFRS": {
        "RevenueIFRSSummaryOfBusinessResults": "Net sales",
        "SalesAndFinancialServicesRevenueIFRSKeyFinancialData": "Net sales",
        "OperatingRevenuesIFRSKeyFinancialData": "Net sales",
        "NetSalesIFRSKeyFinancialData": "Net sales",
        "NetSalesIFRSSummaryOfBusinessResults": "Net sales",
        "InsuranceRevenueIFRSKeyFinancialData": "Net sales",
        "OperatingProfitLossIFRSKeyFinancialData": "Operating profit",
        "OperatingProfitLossIFRS": "Operating profit",
        "ProfitLossBeforeTaxIFRSSummaryOfBusinessResults": "Earnings before interest and taxes",
        "ProfitLossBeforeTaxIFRS": "Earnings before interest and taxes",
        "ProfitBeforeFinancingAndIncomeTaxIFRSKeyFinancialData": "Earnings before interest and taxes",
        "ProfitLossAttributableToOwnersOfParentIFRSSummaryOfBusinessResults": "Profit",
        "ComprehensiveIncomeAttributableToOwnersOfParentIFRSSummaryOfBusinessResults": "Comprehensive profit",
        "ComprehensiveIncomeIFRSSummaryOfBusinessResults": "Comprehensive profit",
        "CashFlowsFromUsedInOperatingActivitiesIFRSSummaryOfBusinessResults": "Operating cashflow",
        "CashFlowsFromUsedInInvestingActivitiesIFRSSummaryOfBusinessResults": "Investing cashflow",
        "CashFlowsFromUsedInFinancingActivitiesIFRSSummaryOfBusinessResults": "Financing cashflow",
        "CashAndCashEquivalentsIFRSSummaryOfBusinessResults": "Cash equilavents",
        "EquityIFRS": "Equity",
        "TotalAssetsIFRSSummaryOfBusinessResults": "Total assests",
        "RatioOfOwnersEquityToGrossAssetsIFRSSummaryOfBusinessResults": "Equity to assets",
        "EquityToAssetRatioIFRSSummaryOfBusinessResults": "Book value per share",
        "BasicEarningsLossPerShareIFRSSummaryOfBusinessResults": "Earning per share",
        "PriceEarningsRatioIFRSSummaryOfBusinessResults": "Price earnings ratios",
        "NumberOfEmployees": "Employees",
    },
    "US GAAP": {
        "RevenuesUSGAAPSummaryOfBusinessResults": "Net sales",
        "OperatingIncomeLossUSGAAPSummaryOfBusinessResults": "Operating profit",
        "ProfitLossBeforeTaxUSGAAPSummaryOfBusinessResults": "Earnings before interest and taxes",
        "NetIncomeLossAttributableToOwnersOfParentUSGAAPSummaryOfBusinessResults": "Profit",
        "ComprehensiveIncomeUSGAAPSummaryOfBusinessResults": "Comprehensive profit",
        "ComprehensiveIncomeAttributableToOwnersOfParentUSGAAPSummaryOfBusinessResults": "Comprehensive profit",
        "CashFlowsFromUsedInOperatingActivitiesUSGAAPSummaryOfBusinessResults": "Operating cashflow",
        "CashFlowsFromUsedInInvestingActivitiesUSGAAPSummaryOfBusinessResults": "Investing cashflow",
        "CashFlowsFromUsedInFinancingActivitiesUSGAAPSummaryOfBusinessResults": "Financing cashflow",
        "CashAndCashEquivalentsUSGAAPSummaryOfBusinessResults": "Cash equilavents",
        "EquityIncludingPortionAttributableToNonControllingInterestUSGAAPSummaryOfBusinessResults": "Equity",
        "NetAssetsSummaryOfBusinessResults": "Equity",
        "TotalAssetsUSGAAPSummaryOfBusinessResults": "Total assests",
        "EquityToAssetRatioUSGAAPSummaryOfBusinessResults": "Equity to assets",
        "EquityAttributableToOwnersOfParentPerShareUSGAAPSummaryOfBusinessResults": "Book value per share",
        "BasicEarningsLossPerShareUSGAAPSummaryOfBusinessResults": "Earning per share",
        "PriceEarningsRatioUSGAAPSummaryOfBusinessResults": "Price earnings ratios",
        "NumberOfEmployees": "Employees",
    },
}


def tag_dimension(spark: SparkSession, dictionary: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Rows ``(standard, tag, attribute)`` of a tag dictionary, which is held in the driver and so is small."""
    rows = [(s, t, a) for s, tags in (dictionary or TAG_DICTIONARY).items() for t, a in tags.items()]
    names = ("standard", "tag", "attribute")
    return spark.createDataFrame(pa.table([pa.array(c, pa.string()) for c in zip(*rows)], names=names))


def document_metadata(facts: DataFrame) -> DataFrame:
    """One row per document with the last value of each metadata tag; null where a document has none."""
    tags = facts.filter(F.col("local_name").isin(list(DOCUMENT_TAGS)))
    return tags.groupBy("source_path").agg(
        *[
            F.max_by(F.col("value"), F.when(F.col("local_name") == tag, F.col("fact_index"))).alias(name)
            for tag, name in DOCUMENT_TAGS.items()
        ]
    )


def attribute_values(facts: DataFrame, tags: DataFrame) -> DataFrame:
    """Distinct current-year facts as ``(source_path, standard, attribute, value)``, one row per standard whose
    dictionary knows the tag.

    Facts without a label are told apart by their tag, which is what a label stands for.
    """
    current = ends_with_any(facts, "context_id", CURRENT_YEAR_CONTEXTS)
    known = current.join(F.broadcast(tags), F.col("local_name") == F.col("tag"))
    return (
        known.select(
            "source_path",
            "standard",
            "attribute",
            F.coalesce("label", "local_name").alias("label"),
            "context_id",
            "unit_id",
            "value",
        )
        .distinct()
        .select("source_path", "standard", "attribute", to_double(F.col("value"), T.StringType()).alias("value"))
    )


def normalise_filing_facts(
    facts: DataFrame,
    dictionary: dict[str, dict[str, str]] | None = None,
    attributes: Sequence[str] | None = None,
) -> DataFrame:
    """Fact rows of any number of filings to one wide row per filing, with ``source_path`` last.

    A filing without a known accounting standard, with a metadata value missing or without a single numeric value gives
    no row. Attributes a filing lacks are null; several values of one attribute are averaged.
    """
    require_columns(facts, ["source_path", "fact_index", "local_name", "value", "context_id", "unit_id", "label"], "facts")
    if attributes is None:
        attributes = ATTRIBUTES if dictionary is None else sorted({a for t in dictionary.values() for a in t.values()})
    tags = tag_dimension(facts.sparkSession, dictionary)
    wide = pivot_mean(attribute_values(facts, tags), ["source_path", "standard"], "attribute", "value", attributes)
    meta = document_metadata(facts).dropna(subset=list(DOCUMENT_TAGS.values()))
    same = (F.col("w.source_path") == F.col("m.source_path")) & (F.col("w.standard") == F.col("m.`Account standard`"))
    return wide.alias("w").join(meta.alias("m"), same).select(
        *[F.col(f"m.`{name}`") for name in DOCUMENT_TAGS.values()],
        *[F.col(f"w.`{a}`") for a in attributes],
        F.col("w.source_path"),
    )


def filing_ledger(
    facts: DataFrame,
    documents: DataFrame | None = None,
    dictionary: dict[str, dict[str, str]] | None = None,
    attributes: Sequence[str] | None = None,
) -> DataFrame:
    """Rows ``(source_path, reason)`` of the documents that :func:`normalise_filing_facts` gives no row for, so that
    documents in are rows out plus ledger rows.

    ``documents`` names all documents in its ``source_path`` (by default those with facts). One reason each, the first that
    holds: no facts (not readable, or empty), no or an unknown accounting standard, metadata missing (which is named), no
    value under the standard's tags.
    """
    if attributes is None:
        attributes = ATTRIBUTES if dictionary is None else sorted({a for t in dictionary.values() for a in t.values()})
    tags = tag_dimension(facts.sparkSession, dictionary)
    own = facts.select("source_path").distinct()
    meta = document_metadata(facts)
    valued = attribute_values(facts, tags).filter(F.col("value").isNotNull() & F.col("attribute").isin(list(attributes)))
    valued = valued.select("source_path", F.col("standard").alias("Account standard")).distinct()
    standard = F.col("Account standard")
    lacking = F.filter(F.array(*[F.when(col(n).isNull(), F.lit(n)) for n in DOCUMENT_TAGS.values()]), lambda x: x.isNotNull())
    status = own.withColumn("_facts", F.lit(True)).join(meta, "source_path", "left")
    status = status.join(valued.withColumn("_valued", F.lit(True)), ["source_path", "Account standard"], "left")
    if documents is not None:
        status = documents.select("source_path").distinct().join(status, "source_path", "left")
    reason = (
        F.when(F.col("_facts").isNull(), "no facts")
        .when(standard.isNull(), "no accounting standard")
        .when(~standard.isin(list(dictionary or TAG_DICTIONARY)), F.concat(F.lit("unknown accounting standard "), standard))
        .when(F.size(lacking) > 0, F.concat(F.lit("no "), F.array_join(lacking, ", ")))
        .when(F.col("_valued").isNull(), "no value")
    )
    return status.select("source_path", reason.alias("reason")).filter("reason is not null")


def filings_without_standard(facts: DataFrame, dictionary: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Documents that give no row because their accounting standard is absent or unknown."""
    known = list(dictionary or TAG_DICTIONARY)
    documents = facts.select("source_path").distinct()
    good = document_metadata(facts).filter(F.col("`Account standard`").isin(known)).select("source_path")
    return documents.join(good, "source_path", "left_anti")
