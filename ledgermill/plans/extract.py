"""Analysis frames: base table, joins with a row guard, null fills, filter, final schema, snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgermill.functions.predicates import apply_where
from ledgermill.names import col
from ledgermill.operators.fill import fill_values, resolve_fills
from ledgermill.operators.joins import join_chain
from ledgermill.operators.validate import validate
from ledgermill.scratch import write_scratch
from ledgermill.sinks.tables import snapshot
from ledgermill.sources.files import scan_table
from ledgermill.spec import ExtractSpec


def extract(spark: SparkSession, spec: ExtractSpec, warehouse: str | None = None) -> DataFrame:
    """Build the frame a spec describes.

    Fill statistics are taken after the joins and before the filter. When every join is a guarded left join the base
    columns hold the same values before and after, so their statistics come from the base table alone. Jobs that run now:
    the join guard, the statistics, the final schema's checks and the snapshot. After joins the checked rows are staged
    in the scratch folder, so that the joins run once.
    """
    base = scan_table(spark, spec.base, warehouse)
    steps = [(scan_table(spark, j.source, warehouse), j.keys, j.how) for j in spec.joins]
    df = join_chain(base, steps, spec.row_guard) if steps else base

    if spec.fills:
        df = fill_values(df, resolve_fills(df, spec.fills, _statistics_source(base, df, steps, spec)))

    df = apply_where(df, spec.where)
    if spec.final is not None:
        df = validate(df, spec.final, stage=bool(steps) if spec.stage is None else spec.stage)
    if spec.snapshot_dir:
        snapshot(df, spec.snapshot_dir)
    return df


def _statistics_source(base: DataFrame, joined: DataFrame, steps: list, spec: ExtractSpec) -> DataFrame:
    """Where fill statistics are read: the base table when the joins cannot have changed its columns, else the joined
    columns concerned, kept in scratch when exact medians or modes will read them several times."""
    filled = [f for f in spec.fills if f.column in joined.columns]
    only_left = spec.row_guard and all(how == "left" for _, keys, how in steps if keys)
    if only_left and all(f.column in base.columns for f in filled):
        return base
    if any(f.value in ("median", "mode") for f in filled):
        return write_scratch(joined.select(*{f.column: col(f.column) for f in filled}.values()), "statistics")
    return joined
