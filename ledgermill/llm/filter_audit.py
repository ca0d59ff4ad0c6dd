"""How filters of a corpus overlap: for every order they can be applied in, what each step removes.

Each document has a mask: one bit for each filter that it fails, and one each for labels that say good or toxic. A mask
decides all outcomes of the document at all steps of all orders. So every mask is mapped to one wide integer, a packed
counter with a field of ``FIELD`` bits for each outcome of each of the 600 steps (0 or 1 for one document). The integers of
a part's documents are summed, masks that occur n times by one product, and the sum is unpacked field by field. A field
counts at most all documents, whose number a long holds, so no field overflows into the next.

Documents are counted by part and mask before anything is exchanged, so a hot part costs a task no more than 128 rows. A
text is read once; copies are found by its SHA-256 digest, and only digests that repeat are joined back.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.scratch import write_scratch

FILTERS = "ABCDE"
WORD = r"[^\x20\x09-\x0D]+"
FIELD = 64
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
GOOD, TOXIC = 1 << len(FILTERS), 2 << len(FILTERS)
ORDERS = tuple("".join(p) for p in permutations(FILTERS))
SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def text_failures(text: Column) -> Column:
    """Bits of the filters that look at one text alone: A few words, B repeated words, C capitals, D odd characters."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    fails = (
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)).cast("long") < 50 * F.size(words).cast("long"),
        100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 3 * F.length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    )
    bits = F.lit(0)
    for i, fail in enumerate(fails):
        bits = bits.bitwiseOR(F.when(fail, F.lit(1 << i)).otherwise(F.lit(0)))
    return bits


@lru_cache(maxsize=1)
def packed_masks() -> tuple[int, ...]:
    """The wide integer of each mask."""
    out = []
    for mask in range(4 << len(FILTERS)):
        fails = {f for i, f in enumerate(FILTERS) if mask >> i & 1}
        fields = np.zeros((len(ORDERS), len(FILTERS), len(OUTCOMES)), f"<u{FIELD // 8}")
        for o, order in enumerate(ORDERS):
            there = True
            for step, f in enumerate(order):
                removed = there and f in fails
                fields[o, step] = (there and not removed, removed, f in fails and not there, fails == {f},
                                   removed and bool(mask & GOOD), removed and bool(mask & TOXIC))
                there = there and not removed
        out.append(int.from_bytes(fields.tobytes(), "little"))
    return tuple(out)


def _unpacked(table: pa.Table) -> pa.Table:
    """All steps of all orders of one part, from its number of documents by mask."""
    masks = packed_masks()
    total = sum(n * masks[mask] for mask, n in zip(table["mask"].to_pylist(), table["n"].to_pylist()))
    steps = len(ORDERS) * len(FILTERS)
    size = steps * len(OUTCOMES) * FIELD // 8
    counts = np.frombuffer(total.to_bytes(size, "little"), f"<u{FIELD // 8}").reshape(steps, len(OUTCOMES)).astype(np.int64)
    letters = np.array([f for order in ORDERS for f in order])
    removed = {f: int(counts[letters == f, OUTCOMES.index("removed")].sum()) for f in FILTERS}
    return pa.table({
        "part": pa.array([table["part"][0].as_py()] * steps, pa.string()),
        "filter_order": [order for order in ORDERS for _ in order],
        "step": pa.array([s + 1 for _ in ORDERS for s in range(len(FILTERS))], pa.int32()),
        **{name: counts[:, i] for i, name in enumerate(OUTCOMES)},
        "shapley": pa.array([removed[f] for f in letters.tolist()], pa.int64()),
    })


def masks_of(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang",
             quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """(part, mask, n): documents counted by part and mask."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       text_failures(body).alias("fails"), F.unhex(F.sha2(body, 256)).alias("digest"))
    rows = write_scratch(rows, "audit-documents")
    copies = rows.groupBy("digest").agg(F.min("id").alias("low"), F.count("*").alias("n")).where("n > 1")
    said = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(
        F.max((F.col(quality) == 1).cast("int")).alias("good"), F.max((F.col(toxic) == 1).cast("int")).alias("toxic"))
    rows = rows.join(copies.select("digest", "low"), "digest", "left").join(said, "id", "left")
    bits = ((F.col("id") > F.col("low"), 1 << FILTERS.index("E")), (F.col("good") == 1, GOOD), (F.col("toxic") == 1, TOXIC))
    mask = F.col("fails")
    for holds, bit in bits:
        mask = mask.bitwiseOR(F.when(holds, F.lit(bit)).otherwise(F.lit(0)))
    return rows.groupBy("part", mask.alias("mask")).agg(F.count("*").alias("n"))


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """One row per part, order and step: documents kept after the step, removed by it, redundant (failing its filter,
    removed before), failing its filter only, good and toxic ones removed by it, and ``shapley`` (removed by its filter,
    summed over all orders).

    A null text is empty and a null part is the empty string. A row without an id is no copy's first and fails no copy
    filter; rows that repeat an id and a text are no copies of each other, but all count. A document is good or toxic if
    any of its labels says so; labels without an id say nothing. No documents give no rows. Other columns are not read.
    """
    return masks_of(docs, labels, **columns).groupBy("part").applyInArrow(_unpacked, SCHEMA)
