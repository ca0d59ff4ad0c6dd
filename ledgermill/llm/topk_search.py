"""Exact top-k search by inner product: distributed histogram selection.

Vectors become integers (floor of ``scale`` times each component). Queries and candidates are dealt to blocks, and every
pair of a query block and a candidate block is scored as one matrix product. For each query the value of its k-th best
score is located by rounds of histograms: a round counts the scores of each block in the bins of the query's current range,
the counts are summed over all blocks, and the bin that holds the k-th score becomes the next range, until a bin is a
single score. The last round emits the scores above that value, and of those equal to it the smallest ids that fill up
to k. Counts and emissions of a block are bounded by k a query, whatever the number of equal scores.

Work is queries x candidates by definition. A task holds ``QUERY_BLOCK`` x ``CANDIDATE_BLOCK`` scores. Blocks are dealt by
hash of the id, so equal vectors and hot ids spread.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermill.scratch import write_scratch

QUERY_BLOCK, CANDIDATE_BLOCK = 512, 8192
BINS = 256


def integer_vectors(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, v, dim) of the usable rows: no null id, vector or component, all components finite, and a squared length below
    2**62 once scaled, so that no score can exceed a long."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & fine)
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + (F.abs(x * scale) + 1) * (F.abs(x * scale) + 1))
    rows = rows.where(length < 2.0**62)
    return rows.withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("long"))).withColumn("dim", F.size("v"))


def _matrix(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _scores(queries: pa.Table, candidates: pa.Table) -> np.ndarray:
    """Integer inner products; the rows of a query's own id get the least number."""
    q, c = _matrix(queries["v"]), _matrix(candidates["v"])
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    scores = (q.astype(float) @ c.T.astype(float)).astype(np.int64) if top < 2.0**52 else q @ c.T
    own = queries["id"].to_numpy()[:, None] == candidates["id"].to_numpy()[None, :]
    scores[own] = np.iinfo(np.int64).min
    return scores


def _histograms(k: int):
    def run(_, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        ids, bins, counts = [], [], []
        if len(queries) and len(candidates):
            low, width = queries["low"].to_numpy(), queries["width"].to_numpy()
            for i, row in enumerate(_scores(queries, candidates)):
                at = (row[row >= low[i]] - low[i]) // width[i]
                seen = np.bincount(np.minimum(at, BINS), minlength=BINS + 1)
                enough = np.cumsum(seen[::-1]) >= k  # bins below a block's own k-th score cannot hold the k-th of all
                keep = BINS - int(np.argmax(enough)) if enough.any() else 0
                there = keep + np.flatnonzero(seen[keep:])
                ids.append(np.full(len(there), i))
                bins.append(there)
                counts.append(seen[there])
        if not ids:
            return pa.table({"id": pa.array([], pa.int64()), "bin": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        of = queries["id"].to_numpy()[np.concatenate(ids)]
        return pa.table({"id": of, "bin": np.concatenate(bins).astype(np.int64), "n": np.concatenate(counts).astype(np.int64)})

    return run


def _winners(k: int):
    def run(_, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(candidates):
            low, ids, own = queries["low"].to_numpy(), candidates["id"].to_numpy(), queries["id"].to_numpy()
            for i, row in enumerate(_scores(queries, candidates)):
                row_ok = ids != own[i]
                above = np.flatnonzero(row_ok & (row > low[i]))
                equal = np.flatnonzero(row_ok & (row == low[i]))
                equal = equal[np.argsort(ids[equal], kind="stable")[:k]]
                pick = np.concatenate((above, equal))
                out["query_id"].append(np.full(len(pick), own[i]))
                out["vec_id"].append(ids[pick])
                out["score"].append(row[pick])
        empty = [np.empty(0, np.int64)]
        return pa.table({name: np.concatenate(empty + values) for name, values in out.items()})

    return run


def _blocks(rows: DataFrame, mine: str, size: int, other: str, others: int) -> DataFrame:
    """Rows with their own block, repeated for each block of the other side."""
    rows = rows.withColumn(mine, F.pmod(F.xxhash64("id"), F.lit(size)))
    return rows.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))))


def top_k(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20, scale: int = 64,
          is_query=None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest scores of each query against every other row, ties to smaller ids.

    ``is_query`` is a condition on ``id`` (default: ids divisible by 20). Rows with a null id take no part, nor do vectors so
    long that scores need not fit a long. Rows that repeat an id are candidates of their own; as a query, the smallest
    vector of an id stands for it, and no row of that id is its candidate. Vectors of different length do not meet. Fewer
    candidates give fewer rows; no rows give none.
    """
    rows = write_scratch(integer_vectors(vectors, key, vector, scale), "topk-vectors")
    condition = F.col("id") % 20 == 0 if is_query is None else is_query
    sums = rows.agg(F.count("*").alias("n"), F.count(F.when(condition, 1)).alias("q"),
                    F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("norm")).first()
    candidate_blocks = sums["n"] // CANDIDATE_BLOCK + 1
    query_blocks = sums["q"] // QUERY_BLOCK + 1
    candidates = _blocks(rows, "c", candidate_blocks, "q", query_blocks)
    reach = int(sums["norm"] or 0) + 1  # no inner product exceeds the largest squared length
    width = -(-(2 * reach + 1) // BINS)
    state = rows.where(condition).groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    state = state.withColumn("low", F.lit(-reach).cast("long"))

    def met(state: DataFrame, width: int):
        queries = _blocks(state.withColumn("width", F.lit(width).cast("long")), "q", query_blocks, "c", candidate_blocks)
        return queries.groupBy("dim", "c", "q").cogroup(candidates.groupBy("dim", "c", "q"))

    while True:
        counts = met(state, width).applyInArrow(_histograms(k), "id long, bin long, n long")
        counts = counts.groupBy("id", "bin").agg(F.sum("n").alias("n"))
        above = Window.partitionBy("id").orderBy(F.col("bin").desc())
        counts = counts.withColumn("sum", F.sum("n").over(above)).where(F.col("sum") >= k)
        found = counts.groupBy("id").agg(F.max("bin").alias("bin"))
        # a query with fewer than k scores keeps its low end, which is below every score
        low = F.col("low") + F.coalesce("bin", F.lit(0)) * width
        state = write_scratch(state.join(found, "id", "left").withColumn("low", low).drop("bin"), "topk-ranges")
        if width == 1:
            break
        width = -(-width // BINS)
    won = met(state, 1).applyInArrow(_winners(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    won = won.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return won.select("query_id", "rank", "vec_id", "score")
