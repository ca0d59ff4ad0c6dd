"""Keyed write modes as pure frame operations: what the stored table holds after a write.

The on-disk writers in :mod:`ledgermill.sinks.tables` use the same pieces; nothing here touches storage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.coerce import to_spark_type
from ledgermill.names import col
from ledgermill.operators.joins import anti_by_keys, key_profiles, semi_by_keys

WRITE_MODES = ("overwrite", "append", "incremental", "upsert")


class DuplicateKeyError(ValueError):
    """New data holds the same key more than once."""


def check_mode(mode: str, keys: Sequence[str]) -> str:
    mode = mode.lower()
    if mode not in WRITE_MODES:
        raise ValueError(f"Unsupported mode {mode!r}; choose from {WRITE_MODES}")
    if mode in ("incremental", "upsert") and not keys:
        raise ValueError(f"Mode {mode!r} needs key columns")
    return mode


def check_keys_present(existing: Sequence[str], new: Sequence[str], keys: Sequence[str], evolve: bool) -> None:
    """Keys must exist in the stored columns, and in the new ones unless the schema may evolve."""
    missing = [k for k in keys if k not in existing]
    if missing:
        raise ValueError(f"Key columns {missing} not found in existing data")
    missing = [k for k in keys if k not in new]
    if missing and not evolve:
        raise ValueError(f"Key columns {missing} not found in new data")


def profile_new_keys(new: DataFrame, keys: Sequence[str], mode: str) -> tuple[bool, bool]:
    """Whether new data repeats a key (nulls count as equal), and whether some key has a null. Runs one job.

    Raises :class:`DuplicateKeyError` when an upsert repeats a key. The joins below are cheaper for what this rules out.
    """
    [(repeated, has_null)] = key_profiles([(new, keys)])
    if repeated and mode == "upsert":
        raise DuplicateKeyError(f"New data repeats a key of {list(keys)}; upsert aborted")
    return repeated, has_null


def merged_columns(existing: Sequence[str], new: Sequence[str]) -> list[str]:
    """Stored columns first, then the new ones in their own order."""
    return list(existing) + [c for c in new if c not in existing]


def align(existing: DataFrame, new: DataFrame, evolve: bool = False) -> tuple[DataFrame, DataFrame]:
    """Both frames with the same columns, order and types.

    Stored columns take the new data's types, bad values turning to null. With ``evolve`` a column either side lacks is
    null there; without it a stored column the new data lacks is an error.
    """
    lacking = [c for c in existing.columns if c not in new.columns]
    if lacking and not evolve:
        raise ValueError(f"New data lacks the stored columns {lacking}; allow schema evolution to fill them with null")
    columns = merged_columns(existing.columns, new.columns)

    def target(name):
        return (new if name in new.columns else existing).schema[name].dataType

    def absent(name):
        return F.lit(None).cast(target(name))

    def stored(name):
        return to_spark_type(col(name), existing.schema[name].dataType, target(name))

    old = [(stored(c) if c in existing.columns else absent(c)).alias(c) for c in columns]
    added = [(col(c) if c in new.columns else absent(c)).alias(c) for c in columns]
    return existing.select(*old), new.select(*added)


def misaligned_counts(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Rows ``(column_name, n_lost)``: stored values that alignment to the new types turns into null."""
    changed = [
        c for c in existing.columns if c in new.columns and existing.schema[c].dataType != new.schema[c].dataType
    ]
    counts = existing.agg(
        *[
            F.count_if(
                col(c).isNotNull() & to_spark_type(col(c), existing.schema[c].dataType, new.schema[c].dataType).isNull()
            ).alias(c)
            for c in changed
        ],
        F.count(F.lit(1)).alias("_n"),
    )
    entries = [F.struct(F.lit(c).alias("column_name"), col(c).alias("n_lost")) for c in changed]
    if not entries:
        return existing.sparkSession.createDataFrame([], "column_name string, n_lost bigint")
    return counts.select(F.inline(F.array(*entries)))


def new_rows(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], repeated: bool = True, has_null: bool = True
) -> DataFrame:
    """New rows whose key is not stored yet; a key new data repeats is kept every time.

    The stored keys are first cut down to those new data asks about, with the stored table on the side that a join can
    split or stream: with a small delta it is scanned once and never shuffled. That cut stays null-safe, whose join keys
    differ from the plain ones the result is reduced by; a join that shared its partitioning with the reduction could
    not be split at a hot stored key.
    """
    found = semi_by_keys(existing.select(*[col(k) for k in keys]), new, keys, repeated)
    return anti_by_keys(new, found, keys, nulls_match=has_null)


def kept_rows(existing: DataFrame, new: DataFrame, keys: Sequence[str], has_null: bool = True) -> DataFrame:
    """Stored rows whose key new data, which holds each key once, does not replace."""
    return anti_by_keys(existing, new, keys, distinct=False, nulls_match=has_null)


def merge(
    existing: DataFrame, new: DataFrame, keys: Sequence[str] = (), mode: str = "overwrite", evolve: bool = False
) -> DataFrame:
    """The table after writing ``new`` onto ``existing``. The keyed modes run one job now, over the new keys."""
    mode = check_mode(mode, keys)
    if mode == "overwrite":
        return new
    check_keys_present(existing.columns, new.columns, keys, evolve)
    existing, new = align(existing, new, evolve)
    if mode == "append":
        return existing.unionByName(new)
    repeated, has_null = profile_new_keys(new, keys, mode)
    if mode == "incremental":
        return existing.unionByName(new_rows(existing, new, keys, repeated, has_null))
    return kept_rows(existing, new, keys, has_null).unionByName(new)
