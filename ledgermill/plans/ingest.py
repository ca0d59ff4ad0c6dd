"""Ingests: landed data to a validated frame or stored table.

Every ingest ends in :func:`finish`: add metadata, validate while staging, and either return the frame or write it with
the keys of its spec. An ingest that finds no rows returns None and writes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.functions.scalar import exchange_ticker, stored_ticker
from ledgermill.names import col
from ledgermill.operators.combine import distinct_rows
from ledgermill.operators.filings import filing_ledger, normalise_filing_facts
from ledgermill.operators.filters import date_cut, equals_all, matches
from ledgermill.operators.joins import in_codes
from ledgermill.operators.project import impute_missing_columns, retain, with_ingestion_metadata
from ledgermill.operators.reshape import prices_to_rows, series_to_rows, statements_to_rows
from ledgermill.operators.validate import validate
from ledgermill.plans.chain import run_chain
from ledgermill.plans.windows import LoadWindow
from ledgermill.scratch import scratch_scope, write_scratch
from ledgermill.sinks.tables import write_tables
from ledgermill.sinks.targets import read_target, write_target
from ledgermill.sources.archives import document_of, expand_archives
from ledgermill.sources.files import load_flat_files
from ledgermill.sources.filings import PUBLIC_MEMBER, filing_documents, filing_facts
from ledgermill.spec import IngestSpec, TableSpec, TargetSpec


def finish(
    df: DataFrame, spec: TableSpec | None, source: str | None, target: TargetSpec | None = None, stage: bool = False
) -> DataFrame:
    """Metadata, validation, then the frame itself or, with a target, a keyed write and the stored table.

    With a target the validated rows are staged once, written from there, and the staging is removed.
    """
    df = with_ingestion_metadata(df, source)
    if target is None:
        return df if spec is None else validate(df, spec, stage)
    keys = spec.primary_keys if spec else []
    partition_by = list(target.partition_by) or (spec.partition_columns if spec else [])
    with scratch_scope(df.sparkSession):
        ready = df if spec is None else validate(df, spec, stage=True)
        write_target(ready, target, keys, partition_by, stage=spec is None)
    return read_target(df.sparkSession, target)


def ingest(spark: SparkSession, spec: IngestSpec) -> DataFrame | None:
    """Generic ingest: scan, stages, retained columns, metadata, validation, frame or table."""
    if isinstance(spec.source, DataFrame):
        df = spec.source
    else:
        # the spec describes the finished table, so the scan itself is untyped apart from inferred numbers
        df = load_flat_files(spark, spec.source, spec.load_all, sep=spec.sep)
    if spec.stages:
        _, df = run_chain(df, spec.stages)
    if spec.retain:
        df = retain(df, spec.retain)
    return finish(df, spec.table, spec.ingestion_source, spec.target)


def select_codes(
    master: DataFrame,
    filter_column: str | None = None,
    pattern: str | None = None,
    anchored: bool = False,
    code_column: str = "Code",
) -> DataFrame:
    """Codes of the security master, filtered by a pattern on one of its columns when given.

    ``anchored`` wants the pattern to match from the start of the text; otherwise anywhere. Null never matches.
    """
    if (filter_column is None) != (pattern is None):
        raise ValueError("Give both a filter column and a pattern, or neither")
    if pattern is not None:
        master = matches(master, filter_column, pattern, anchored)
    return distinct_rows(master, [code_column])


def _landed(
    landed: DataFrame,
    spec: TableSpec,
    source: str,
    codes: DataFrame | Sequence[str] | None,
    code_column: str,
    window: LoadWindow | None,
    date_column: str,
    target: TargetSpec | None,
) -> DataFrame | None:
    if codes is not None:
        landed = in_codes(landed, codes, code_column)
    if window is not None:
        landed = window.apply(landed, date_column)
    if landed.isEmpty():
        return None
    return finish(landed, spec, source, target)


def ingest_summary(
    landed: DataFrame,
    source: str,
    codes: DataFrame | Sequence[str] | None = None,
    window: LoadWindow | None = None,
    spec: TableSpec = schemas.SUMMARY,
    target: TargetSpec | None = None,
    code_column: str = "Code",
    date_column: str = "DiscDate",
) -> DataFrame | None:
    """Statement summaries of the wanted codes and days."""
    return _landed(landed, spec, source, codes, code_column, window, date_column, target)


def ingest_bars(
    landed: DataFrame,
    source: str,
    codes: DataFrame | Sequence[str] | None = None,
    window: LoadWindow | None = None,
    spec: TableSpec = schemas.DAILY_BARS,
    target: TargetSpec | None = None,
    code_column: str = "Code",
    date_column: str = "Date",
) -> DataFrame | None:
    """Daily bars of the wanted codes and days."""
    return _landed(landed, spec, source, codes, code_column, window, date_column, target)


def ingest_flows(
    landed: DataFrame,
    source: str,
    section: str | None = None,
    window: LoadWindow | None = None,
    spec: TableSpec = schemas.INVESTOR_FLOWS,
    target: TargetSpec | None = None,
    date_column: str = "PubDate",
    section_column: str = "Section",
) -> DataFrame | None:
    """Investor flows of one section or all."""
    if section is not None:
        landed = equals_all(landed, {section_column: section})
    return _landed(landed, spec, source, None, "", window, date_column, target)


STATEMENT_SPECS = {
    "income_statement": schemas.INCOME_STATEMENT,
    "balance_sheet": schemas.BALANCE_SHEET,
    "cash_flow": schemas.CASH_FLOW,
    "dividends": schemas.DIVIDENDS,
}


def statement_rows(
    rows: DataFrame, spec: TableSpec, cut_date: str | None = None, impute: bool = True
) -> DataFrame:
    """One statement table: date cut, stored tickers, imputed columns."""
    if cut_date is not None:
        rows = date_cut(rows, cut_date, "date")
    rows = rows.withColumn("ticker", stored_ticker(col("ticker")))
    return impute_missing_columns(rows, spec) if impute else rows


def ingest_statements(
    matrices: Mapping[str, DataFrame],
    dividends: DataFrame,
    source: str,
    cut_date: str | None = None,
    codes: DataFrame | None = None,
    specs: Mapping[str, TableSpec] = STATEMENT_SPECS,
    targets: Mapping[str, str | None] | None = None,
    mode: str = "upsert",
    impute: bool = True,
    **write_options,
) -> dict[str, DataFrame] | dict[str, str] | None:
    """Income statement, balance sheet, cash flow and dividends of all tickers.

    ``matrices`` hold statements as ``(ticker, item, <date columns>)``; ``dividends`` is ``(ticker, series map)``.
    One empty table aborts all four. With ``targets`` the tables are written and the outcome per table is returned.
    """
    rows = {}
    for name, matrix in matrices.items():
        spec = specs[name]
        items = [c.name for c in spec.columns if c.name not in ("date", "ticker", "ingestion_source")]
        rows[name] = statements_to_rows(matrix, items)
    rows["dividends"] = series_to_rows(dividends, "ticker", "series") if "series" in dividends.columns else dividends
    if codes is not None:
        wanted = codes.select(exchange_ticker(col(codes.columns[0])).alias("code"))
        rows = {name: in_codes(df, wanted, "ticker") for name, df in rows.items()}
    rows = {name: statement_rows(df, specs[name], cut_date, impute) for name, df in rows.items()}
    if targets is None:
        return _staged_statements(rows, specs, source)
    with scratch_scope(dividends.sparkSession):
        done = _staged_statements(rows, specs, source)
        if done is None:
            return None
        plan = {name: (df, specs[name].primary_keys, targets.get(name)) for name, df in done.items()}
        return write_tables(plan, mode, stage=False, **write_options)


def _staged_statements(
    rows: dict[str, DataFrame], specs: Mapping[str, TableSpec], source: str
) -> dict[str, DataFrame] | None:
    """Each table computed once into scratch, since it is then tested, checked and read; None when one is empty."""
    staged = {name: write_scratch(df, name) for name, df in rows.items()}
    if any(df.isEmpty() for df in staged.values()):
        return None
    return {name: finish(df, specs[name], source) for name, df in staged.items()}


def ingest_prices(
    wide: DataFrame,
    source: str,
    codes: Sequence[str],
    listed: bool = True,
    window: LoadWindow | None = None,
    spec: TableSpec = schemas.EXCHANGE_PRICES,
    target: TargetSpec | None = None,
    date: str = "Date",
    sep: str = "|",
) -> DataFrame | None:
    """Prices from two-level wide rows.

    ``listed`` codes are asked for by exchange ticker and stored with the check digit; market indexes (``listed=False``)
    keep their symbols.
    """
    tickers = [f"{c[:4]}.T" for c in codes] if listed else list(codes)
    if window is not None:
        wide = window.apply(wide, date)
    rows = prices_to_rows(wide, tickers, schemas.PRICE_FIELDS, date, sep)
    if listed:
        rows = rows.withColumn("ticker", stored_ticker(col("ticker")))
    if rows.isEmpty():
        return None
    return finish(rows, spec, source, target)


# What marks an annual securities report in the filing index.
ANNUAL_REPORT = {"ordinanceCode": "010", "formCode": "030000"}

def wanted_filings(index: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """Annual reports of the wanted codes in a filing index."""
    reports = equals_all(index, ANNUAL_REPORT)
    return reports if codes is None else in_codes(reports, codes, "secCode")


def ingest_filings(
    index: DataFrame,
    archives: DataFrame,
    source: str,
    codes: DataFrame | None = None,
    spec: TableSpec | None = schemas.FILINGS,
    target: TargetSpec | None = None,
    skip_bad: bool = False,
) -> DataFrame | None:
    """Filing index and archive table ``(path, content)`` to filing rows.

    Archives are picked by document id before they are opened. The document ids are written to the scratch folder first,
    so the planner knows their size and broadcasts them by it rather than shuffle archive bytes; for archives in a folder,
    see :func:`ledgermill.sources.archives.scan_named_archives`, which does not even read the others. Facts and rows are
    kept in the scratch folder too, as parsing is the expensive part and both are read more than once.
    """
    wanted = write_scratch(wanted_filings(index, codes).select(F.col("docID").alias("_doc")).distinct(), "filing-ids")
    named = archives.withColumn("_doc", document_of("path"))
    picked = named.join(wanted, "_doc", "left_semi").select("path", "content")
    members = expand_archives(picked, PUBLIC_MEMBER)
    parsed = filing_facts(filing_documents(members), skip_bad)
    if target is None:
        rows = _staged_filings(parsed)
        return None if rows.isEmpty() else finish(rows, spec, source)
    with scratch_scope(parsed.sparkSession):
        rows = _staged_filings(parsed)
        return None if rows.isEmpty() else finish(rows, spec, source, target)


def filing_outcomes(
    index: DataFrame, archives: DataFrame, codes: DataFrame | None = None, skip_bad: bool = False
) -> DataFrame:
    """Rows ``(docID, source_path, reason)``: what became of each wanted filing of :func:`ingest_filings`.

    One row for each public document of a filing, with a null reason where it gives a row; one with a null path for a
    filing without an archive or without a public document. So wanted documents are rows out plus rows with a reason.
    """
    wanted = write_scratch(wanted_filings(index, codes).select("docID").distinct(), "filing-ids")
    named = archives.withColumn("docID", document_of("path")).join(wanted, "docID", "left_semi")
    members = expand_archives(named.select("path", "content"), PUBLIC_MEMBER)
    documents = members.select(document_of("archive").alias("docID"), F.concat_ws("/", "archive", "member").alias("source_path"), "content")
    documents = write_scratch(documents, "filing-documents")
    facts = write_scratch(filing_facts(documents.select("source_path", "content"), skip_bad), "facts")
    lost = filing_ledger(facts, documents)
    read = documents.select("docID", "source_path").join(lost, "source_path", "left").withColumn("_read", F.lit(True))
    there = named.select("docID").distinct().withColumn("_there", F.lit(True))
    out = wanted.join(there, "docID", "left").join(read, "docID", "left")
    reason = F.when(F.col("_there").isNull(), "no archive").when(F.col("_read").isNull(), "no public document")
    return out.select("docID", "source_path", reason.otherwise(F.col("reason")).alias("reason"))


def _staged_filings(parsed: DataFrame) -> DataFrame:
    return write_scratch(normalise_filing_facts(write_scratch(parsed, "facts")), "filings")


def upsert_target(path: str, **options) -> TargetSpec:
    """Target of a recurring ingest."""
    return replace(TargetSpec(path), mode="upsert", **options)
