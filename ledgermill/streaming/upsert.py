"""Landed files as a stream: validate each micro-batch and merge it into a keyed table.

A batch that is delivered again leaves the table as it was, because both write modes are idempotent by key. Within a
batch the newest row of a key wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgermill.names import col, require_columns
from ledgermill.operators.combine import newest_per_key
from ledgermill.operators.project import with_ingestion_metadata
from ledgermill.operators.validate import typed, validate
from ledgermill.scratch import scratch_scope
from ledgermill.sinks.targets import write_target
from ledgermill.spec import TableSpec, TargetSpec

STREAM_MODES = ("upsert", "incremental")


def read_landing(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Streaming read of a landing folder; ``landed_file`` and ``landed_at`` tell where and when a row landed."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(
        "*",
        F.col("_metadata.file_modification_time").alias("landed_at"),
        F.col("_metadata.file_path").alias("landed_file"),
    )


def merge_batch(
    batch: DataFrame, spec: TableSpec, target: TargetSpec, order: Sequence[str], source: str | None = None
) -> None:
    """Type, reduce to the newest row per key, validate and merge one batch."""
    if batch.isEmpty():
        return
    if source is not None:
        batch = with_ingestion_metadata(batch, source)
    require_columns(batch, order, "the landed batch")
    keys = [c.name for c in spec.columns if c.primary_key]
    marked = batch.withColumn("_order", F.struct(*[col(o) for o in order]))
    newest = newest_per_key(typed(marked, spec, ["_order"]), keys, ["_order"]).drop("_order")
    with scratch_scope(batch.sparkSession):
        by = list(target.partition_by) or spec.partition_columns
        write_target(validate(newest, spec, stage=True), target, spec.primary_keys, by, stage=False)


def upsert_stream(
    landing: DataFrame,
    spec: TableSpec,
    target: TargetSpec,
    checkpoint: str,
    order: Sequence[str] = ("landed_at", "landed_file"),
    source: str | None = None,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the stream. By default it takes everything that has landed and stops; run it again for what lands later, or
    give ``processing_time`` to keep it running."""
    if target.mode not in STREAM_MODES:
        raise ValueError(f"A stream can only write with {STREAM_MODES}: other modes repeat rows on redelivery")
    if not spec.primary_keys:
        raise ValueError("A stream needs a table spec with key columns")

    def handle(batch: DataFrame, _: int) -> None:
        merge_batch(batch, spec, target, list(order), source)

    writer = landing.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    return writer.trigger(**trigger).start()
