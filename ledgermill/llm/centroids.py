"""Lloyd's centroids over integer vectors, with centroids ruled out by PCA-rotated coordinates.

Vectors become integers. One pass sums their first and second moments, whose eigenvectors give a rotation; each vector is
stored with its ``LEAD`` leading rotated coordinates and the norm of the rest. For a vector and a centroid, the squared
distance of the leading coordinates plus the squared difference of the residual norms is never above their squared
distance. A round takes the centroid with the lowest bound, computes that distance in integers, and verifies in integers
every other centroid whose bound (less what rounding could add) does not exceed it. So the result does not depend on the
rotation: floats only decide what need not be verified.

A round is one pass over the stored vectors. Tasks sum their vectors by centroid and component, Spark sums the sums, and
the driver sees one number per centroid and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.scratch import write_scratch

LEAD = 8
#: Components from this size on are left out: their squared distances need not fit a long.
LARGEST = 1 << 27
_ROWS = 4096
#: More than rounding can add to a bound, as a share of the squared norms.
_ROUNDING = 1e-9


def _integers(batch: pa.RecordBatch, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a batch that take part, and their integer vectors."""
    column = batch.column("vector")
    fits = np.asarray(pc.fill_null(pc.equal(pc.list_value_length(column), dim), False))
    rows = np.flatnonzero(fits)
    flat = column.take(pa.array(rows)).flatten()
    known = np.asarray(flat.is_valid()).reshape(-1, dim)
    values = np.asarray(flat.cast(pa.float64()).fill_null(0.0)).reshape(-1, dim)
    with np.errstate(invalid="ignore", over="ignore"):
        values = np.floor(values * scale)
        good = known.all(1) & (np.abs(values) < LARGEST).all(1)
    return rows[good], values[good].astype(np.int64)


def _packed(matrix: np.ndarray) -> pa.Array:
    """A binary column with one row of the matrix in each cell."""
    width = matrix.shape[1] * matrix.itemsize
    cells = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(matrix), [None, pa.py_buffer(np.ascontiguousarray(matrix))])
    return cells.cast(pa.binary())


def _matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), width)


def _moments(dim: int, scale: int):
    """Count, sums and products of components: (place, value), one set per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((dim + 1, dim + 1))
        for batch in batches:
            _, vectors = _integers(batch, dim, scale)
            rows = np.hstack([np.ones((len(vectors), 1)), vectors])
            sums += rows.T @ rows
        if sums[0, 0]:
            yield pa.record_batch({"place": np.arange(sums.size), "value": sums.ravel()})

    return run


def rotation(vectors: DataFrame, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and orthogonal axes (columns, widest spread first) of all vectors."""
    sums = vectors.mapInArrow(_moments(dim, scale), "place long, value double")
    moments = np.zeros((dim + 1) ** 2)
    for place, value in sums.groupBy("place").agg(F.sum("value")).collect():  # (dim + 1) squared numbers
        moments[place] = value
    moments = moments.reshape(dim + 1, dim + 1)
    n = moments[0, 0] or 1.0
    mean = moments[0, 1:] / n
    spread, axes = np.linalg.eigh(moments[1:, 1:] / n - np.outer(mean, mean))
    return mean, axes[:, np.argsort(-spread, kind="stable")]


def rotated(vectors: np.ndarray, mean: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading rotated coordinates of vectors, and the norm of the others."""
    turned = (vectors - mean) @ axes
    return turned[:, :LEAD], np.sqrt((turned[:, LEAD:] ** 2).sum(1))


def _stored(dim: int, scale: int, mean: np.ndarray, axes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, vectors = _integers(batch, dim, scale)
            lead, rest = rotated(vectors, mean, axes)
            yield pa.record_batch({"vec_id": batch.column("vec_id").take(pa.array(rows)), "v": _packed(vectors.astype("<i4")),
                                   "lead": _packed(lead), "rest": rest})

    return run


def nearest(vectors: np.ndarray, lead: np.ndarray, rest: np.ndarray, centers: np.ndarray, center_lead: np.ndarray,
            center_rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each vector (ties: the smaller number), its squared distance, and how many distances were
    computed in integers."""
    bound = (rest[:, None] - center_rest[None]) ** 2
    for i in range(lead.shape[1]):
        bound += (lead[:, i, None] - center_lead[None, :, i]) ** 2
    norms = (lead**2).sum(1) + rest**2
    bound -= _ROUNDING * (norms[:, None] + ((center_lead**2).sum(1) + center_rest**2)[None] + 1.0)
    who = bound.argmin(1)
    first = who.copy()
    best = ((vectors - centers[who]) ** 2).sum(1)
    verified = len(vectors)
    for c in range(len(centers)):
        rows = np.flatnonzero((bound[:, c] <= best) & (first != c))
        verified += len(rows)
        distance = ((vectors[rows] - centers[c]) ** 2).sum(1)
        closer = (distance < best[rows]) | ((distance == best[rows]) & (c < who[rows]))
        best[rows[closer]], who[rows[closer]] = distance[closer], c
    return who, best, verified


def _assigned(batches: Iterator[pa.RecordBatch], dim: int, centers: np.ndarray, mean: np.ndarray, axes: np.ndarray):
    """(batch, vectors, cluster, distance) of slices of a bounded number of rows."""
    center_lead, center_rest = rotated(centers, mean, axes)
    for whole in batches:
        for at in range(0, len(whole), _ROWS):
            batch = whole.slice(at, _ROWS)
            vectors = _matrix(batch.column("v"), "<i4", dim).astype(np.int64)
            lead, rest = _matrix(batch.column("lead"), "<f8", center_lead.shape[1]), batch.column("rest").to_numpy()
            who, distance, _ = nearest(vectors, lead, rest, centers, center_lead, center_rest)
            yield batch, vectors, who, distance


def _sums(dim: int, centers: np.ndarray, mean: np.ndarray, axes: np.ndarray):
    """(cluster, place, value) per task: place 0 counts vectors, place i sums component i - 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(centers), dim + 1), np.int64)
        for _, vectors, who, _ in _assigned(batches, dim, centers, mean, axes):
            for c in np.unique(who):
                mine = vectors[who == c]
                sums[c] += np.concatenate(([len(mine)], mine.sum(0)))
        cluster, place = np.nonzero(sums)
        yield pa.record_batch({"cluster": cluster.astype(np.int64), "place": place.astype(np.int64), "value": sums[cluster, place]})

    return run


def _verdicts(dim: int, centers: np.ndarray, mean: np.ndarray, axes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, who, distance in _assigned(batches, dim, centers, mean, axes):
            yield pa.record_batch({"vec_id": batch.column("vec_id"), "cluster": who.astype(np.int32), "distance": distance})

    return run


def seeds(stored: DataFrame, dim: int, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest digests of seed and id; equal digests go by the vector, null ids come last."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = stored.orderBy(digest.asc_nulls_last(), "v").select("v").limit(k).collect()
    return np.array([np.frombuffer(r["v"], "<i4") for r in first], np.int64).reshape(-1, dim)


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 16, rounds: int = 3, dim: int = 64,
            scale: int = 64, seed: str = "1") -> DataFrame:
    """One row per vector that takes part: vec_id, cluster, distance (squared), cluster_inertia, inertia and
    centroid_sha256 (of the final centroid's components, as decimal integers joined by commas).

    A vector takes part if it has ``dim`` components, none null or not finite, all below ``LARGEST`` once scaled (so that
    distances fit a long). Rows with a null id take part, and start a centroid only where too few others are; rows that
    repeat an id are vectors of their own. Fewer than ``k`` vectors make as many centroids; none give no rows. A sum of
    distances that no long can hold is null. Other columns are not read.
    """
    spark = vectors.sparkSession
    raw = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    mean, axes = rotation(raw, dim, scale)
    stored = raw.mapInArrow(_stored(dim, scale, mean, axes), "vec_id long, v binary, lead binary, rest double")
    stored = write_scratch(stored, "centroid-vectors")
    centers = seeds(stored, dim, k, seed)
    for _ in range(rounds if len(centers) else 0):
        sums = stored.mapInArrow(_sums(dim, centers, mean, axes), "cluster long, place long, value long")
        sums = sums.groupBy("cluster", "place").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("value"))
        totals = {(r["cluster"], r["place"]): int(r["value"]) for r in sums.collect()}  # k times (dim + 1) numbers
        for c in range(len(centers)):
            if n := totals.get((c, 0), 0):
                centers[c] = [totals.get((c, i + 1), 0) // n for i in range(dim)]
    found = stored.mapInArrow(_verdicts(dim, centers, mean, axes) if len(centers) else _nothing, "vec_id long, cluster int, distance long")
    found = write_scratch(found, "centroid-verdicts")
    by_cluster = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("sum"))
    sums = {r["cluster"]: int(r["sum"]) for r in by_cluster.collect()}  # k numbers
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers.tolist()]

    def held(n: int) -> int | None:
        return n if n < 1 << 63 else None

    about = [(c, held(sums.get(c, 0)), held(sum(sums.values())), d) for c, d in enumerate(digests)]
    about = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _nothing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from ()
