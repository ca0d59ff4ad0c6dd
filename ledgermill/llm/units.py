"""Documents dealt to units of a bounded number of bytes, for operators that look at a document several times.

A unit is a hash class of rows. Work that must compare documents sends small packed arrays from units to buckets of hash
values and back, so the texts themselves are shuffled once: every look at the units reads the same exchange.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.text import Texts, bytes_of

UNIT_BYTES, BUCKET_BYTES = 2 << 20, 4 << 20
#: With ``grow``, text from which buckets grow, and how many times of it at most they grow with.
GROW_FROM, GROW_MOST = 1 << 30, 16


def unit_frame(docs: DataFrame, key: str, text: str, with_row: bool = False, grow: bool = False) -> tuple[DataFrame, int, int]:
    """(doc_id, text, unit) with the rows of a unit in one partition, the number of units, and the bits that number the
    buckets. With ``with_row``, also the whole row as the struct ``row``.

    A unit has about ``UNIT_BYTES`` of text (or one longer text), a bucket the hash values of about ``BUCKET_BYTES``. Units send
    a message to each bucket, so with ``grow`` a bucket has up to ``GROW_MOST`` times as much of a large input.
    """
    rows = [F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")]
    rows = docs.select(*rows, *([F.struct("*").alias("row")] if with_row else []))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    units, more = total // UNIT_BYTES + 1, min(max(1.0, total / GROW_FROM), GROW_MOST) if grow else 1.0
    buckets = total // int(BUCKET_BYTES * more)
    return rows.withColumn("unit", unit_of("doc_id", units, "text")).repartition("unit"), units, max(0, buckets.bit_length())


def unit_of(key: str, units: int, text: str | None = None):
    """The unit of a document; rows without a key are spread by their text."""
    spread = F.when(F.col(key).isNull(), F.xxhash64(text)).otherwise(F.xxhash64(key)) if text else F.xxhash64(key)
    return F.pmod(spread, F.lit(units).cast("long"))


class Unit:
    """The rows of a unit in a fixed order, so that every look at it numbers them alike."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        table = table.take(pc.sort_indices(table, [("doc_id", "ascending"), ("text", "ascending")]))
        self.table = table
        self.ids = table["doc_id"].combine_chunks()
        self.known = self.ids.is_valid().to_numpy(zero_copy_only=False)
        self.doc = self.ids.fill_null(0).to_numpy()
        rows = np.arange(len(table))
        new = np.r_[True, (np.diff(self.doc) != 0) | (np.diff(self.known.astype(np.int8)) != 0)][: len(table)]
        self.first_text = np.maximum.accumulate(np.where(new, rows, 0))  # the first row with the same doc_id
        column = table["text"].combine_chunks()
        self.number = table["unit"][0].as_py() if len(table) else 0
        self.texts = Texts(*bytes_of(column if isinstance(column, pa.Array) else pa.array([], pa.string())))


def bucket_ranges(hashes: np.ndarray, bits: int):
    """(bucket, first, last + 1) of each bucket that sorted hashes fall into."""
    if not len(hashes):
        return
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield int(bucket[a]), a, b


def arrays(column, dtype) -> list[np.ndarray]:
    """Packed arrays of a binary column."""
    return [np.frombuffer(x.as_buffer(), dtype) for x in column]


def joined(parts: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, dtype)


def schema_of(ddl: str) -> pa.Schema:
    """The Arrow schema of a plain column list."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "string": pa.string(),
             "array<int>": pa.list_(pa.int32())}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in ddl.split(", "))])
