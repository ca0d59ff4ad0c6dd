"""Landed JSON envelopes: an array of flat records under one field."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.spec import TableSpec


def scan_envelopes(
    spark: SparkSession,
    paths: str | Sequence[str],
    record: T.StructType | TableSpec,
    field: str = "data",
    multiline: bool = True,
    with_source: bool = False,
) -> DataFrame:
    """Records of every envelope, one row each. An envelope without the field, or with null there, gives no rows.

    The record schema is declared, so no job infers it; a spec reads every field as text for later coercion.
    ``multiline=False`` reads one envelope per line, which lets large files be split.
    """
    if isinstance(record, TableSpec):
        record = record.text_schema
    envelope = T.StructType([T.StructField(field, T.ArrayType(record), True)])
    raw = spark.read.schema(envelope).option("multiLine", multiline).json(paths)
    rows = F.inline(F.col(field))
    if with_source:
        return raw.select(F.col("_metadata.file_path").alias("source_path"), rows)
    return raw.select(rows)


# The record fields of a filing index that later steps use.
FILING_INDEX_FIELDS = [
    "docID", "edinetCode", "secCode", "filerName", "ordinanceCode", "formCode", "docType", "submitDateTime",
]


def scan_filing_index(spark: SparkSession, paths: str | Sequence[str], multiline: bool = True) -> DataFrame:
    """Filing index rows from envelopes with a ``results`` array."""
    record = T.StructType([T.StructField(f, T.StringType(), True) for f in FILING_INDEX_FIELDS])
    return scan_envelopes(spark, paths, record, "results", multiline)
