"""Quality of documents by co-training two views: the text's content, and the metadata beside it.

Each view has its own ridge logistic classifier, first fitted on labelled documents. In every round each classifier scores
all unlabelled documents, and those it is sure of join the other's training set with its verdict as label, so each learns
from what the other can see. A round is one Newton step of both classifiers: the slopes and curves of all documents handed
over are summed where they lie. Together they weigh at most as much as the labelled ones of their label. At the end each
view's value is calibrated on the labelled documents (a logistic curve), and a last logistic curve joins the two calibrated
values into one score.

Only the labelled documents are sampled (``LABELLED`` of each kind, by hash). The features of the unlabelled ones are
written once, as rows of fixed width, and read once a round. Scoring is one pass over all documents and whole texts, without
a shuffle.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.linear import fit_logistic, sigmoid
from ledgermill.llm.text import Texts, slices
from ledgermill.llm.toxicity import is_held_out
from ledgermill.scratch import write_scratch

#: Sampled documents of each label, rounds, how sure a verdict must be, and the groups in which tasks' sums are added up.
LABELLED, ROUNDS, SURE, SUMS = 2000, 5, 0.9, 16
_PAIRS, _SOURCES, _LANGS = 64, 32, 16


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[first[1:]] - total[first[:-1]]


def content_features(texts: Texts) -> np.ndarray:
    """Facts of each whole text: lengths, shares of kinds of bytes, repetition of words and lines, pairs of bytes."""
    data, offsets = texts.data, texts.offsets
    n = len(texts)
    words = texts.words()
    hashes = words.hashes()
    count = np.diff(words.first)
    size = np.diff(offsets)
    some, text = np.maximum(count, 1), np.maximum(size, 1)
    owner = words.owner()
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    order = np.lexsort((hashes, owner))
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    distinct = np.bincount(owner[order][new], minlength=n)
    length = words.end - words.start
    mean = _sums(length, words.first) / some
    spread = np.sqrt(np.maximum(_sums(length**2, words.first) / some - mean**2, 0))

    def share(mask):
        return _sums(mask.astype(np.int64), offsets) / text

    line = data == 10
    columns = [
        np.log1p(count), np.log1p(size), mean / 5, spread / 5, distinct / some, _sums(same.astype(np.int64), words.first) / some,
        _sums((length <= 3).astype(np.int64), words.first) / some, _sums((length > 20).astype(np.int64), words.first) / some,
        share((data >= 48) & (data <= 57)) * 5, share((data >= 65) & (data <= 90)) * 5, share((data == 46) | (data == 44)) * 10,
        share(data == 124) * 20, share((data == 123) | (data == 125) | (data == 60) | (data == 62)) * 20, share(line) * 20,
        share((data == 33) | (data == 63)) * 20, share((data < 32) & ~line) * 20, share(data >= 128), (count == 0).astype(float),
    ]
    pairs = np.zeros((n, _PAIRS))
    if len(data) > 1:
        kind = ((data[:-1].astype(np.int64) * 31 + data[1:]) * 2654435761 >> 16) % _PAIRS
        of = np.repeat(np.arange(n), size)
        inside = of[:-1] == of[1:]
        pairs = np.bincount(of[:-1][inside] * _PAIRS + kind[inside], minlength=n * _PAIRS).reshape(n, _PAIRS)
        pairs = np.sqrt(pairs / text[:, None]) * 2
    return np.hstack([np.array(columns).T.reshape(n, -1), pairs])


def metadata_features(sources: list, langs: list, chars: list) -> np.ndarray:
    """Source and language as hashed indicators (null is a value of its own), and the stated length."""
    out = np.zeros((len(sources), _SOURCES + _LANGS + 4))
    for i, (source, lang, n) in enumerate(zip(sources, langs, chars)):
        out[i, crc32(repr(source).encode()) % _SOURCES] = 1
        out[i, _SOURCES + crc32(repr(lang).encode()) % _LANGS] = 1
        size = np.log1p(max(0, n or 0))
        out[i, -4:] = size / 5, (size / 5) ** 2, n is None, (n or 0) < 50
    return out


def _features_of(batch: pa.RecordBatch):
    """(first row, content features, metadata features) of the slices of a batch of (.., text, source, lang, n_chars)."""
    at = batch.schema.get_field_index("text")
    for a, b, texts in slices(batch.column(at)):
        meta = [batch.column(at + i).slice(a, b - a).to_pylist() for i in (1, 2, 3)]
        yield a, content_features(texts), metadata_features(*meta)


class Model:
    """Weights of both views, their calibration, and the joint curve."""

    def __init__(self, views, curves, joint):
        self.views, self.curves, self.joint = views, curves, joint

    def scores(self, *features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(content score, metadata score, joint score)."""
        values = [c[0] * (x @ w[:-1] + w[-1]) + c[1] for x, w, c in zip(features, self.views, self.curves)]
        joint = self.joint[0] * values[0] + self.joint[1] * values[1] + self.joint[2]
        return sigmoid(values[0]), sigmoid(values[1]), sigmoid(joint)


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1))])


def _slopes(x: np.ndarray, p: np.ndarray, verdict: int) -> np.ndarray:
    """Number of rows, slope and curve of their logistic loss, packed."""
    curve = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x
    return np.concatenate(([len(x)], x.T @ (p - verdict), curve.ravel()))


def handed_over(views: list[np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
    """Packed sums for each view and verdict over the rows that the other view is sure of."""
    p = [sigmoid(x @ w[:-1] + w[-1]) for x, w in zip(views, weights)]
    out = []
    for view in (0, 1):
        x, other = _with_one(views[view]), p[1 - view]
        for verdict, sure in ((0, other < 1 - SURE), (1, other > SURE)):
            out.append(_slopes(x[sure], p[view][sure], verdict))
    return np.concatenate(out)


def _matrix(column: pa.Array) -> np.ndarray:
    """Packed single-precision rows of one width."""
    return np.array([np.frombuffer(x.as_buffer(), "<f4") for x in column], float)


def _sum_up(weights: list[np.ndarray]):
    def run(batches):
        total = 0.0
        for batch in batches:
            if len(batch):
                total = total + handed_over([_matrix(batch.column(c)) for c in ("content", "meta")], weights)
        if np.ndim(total):
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int64()),
                                              "sums": pa.array([total.tobytes()], pa.binary())})

    return run


def _add_up(table: pa.Table) -> pa.Table:
    table = table.sort_by("part")
    total = sum(np.frombuffer(x.as_buffer(), float) for x in table["sums"])
    return pa.table({"part": pa.array([table["part"][0].as_py()], pa.int64()), "sums": pa.array([total.tobytes()], pa.binary())})


def sums_over(pool: DataFrame):
    """A function of both views' weights: :func:`handed_over` of all rows of (content, meta)."""

    def run(weights: list[np.ndarray]):
        sums = pool.select("content", "meta").mapInArrow(_sum_up(weights), "part long, sums binary")
        sums = sums.groupBy(F.pmod("part", F.lit(SUMS))).applyInArrow(_add_up, "part long, sums binary").collect()
        return sum(np.frombuffer(bytes(r["sums"]), float) for r in sorted(sums, key=lambda r: r["part"])) if sums else None

    return run


def co_train(labelled: list[np.ndarray], y: np.ndarray, sums) -> Model:
    """A model from two views of labelled documents and ``sums`` over the unlabelled ones."""
    y = y.astype(float)
    share = np.clip(y.mean(), 0.05, 0.95)
    of_label = [0.5 / (1 - share), 0.5 / share]
    weights = [fit_logistic(x, y, np.where(y == 1, of_label[1], of_label[0]), ridge=1.0) for x in labelled]
    for _ in range(ROUNDS):
        weights = [np.round(w, 6) for w in weights]  # the order of sums over many tasks doesn't show
        total = sums(weights)
        if total is None:
            break
        after, at = [], 0
        for x, w in zip(labelled, weights):
            n = len(w)
            ridge = np.r_[np.ones(n - 1), 1e-6]
            p, x = sigmoid(x @ w[:-1] + w[-1]), _with_one(x)
            slope, curve = ridge * w, np.diag(ridge)
            for verdict in (0, 1):
                own = _slopes(x[y == verdict], p[y == verdict], verdict)
                handed = total[at : at + len(own)]
                at += len(own)
                both = own + handed * min(1.0, own[0] / max(1.0, handed[0]))
                slope = slope + of_label[verdict] * both[1 : n + 1]
                curve = curve + of_label[verdict] * both[n + 1 :].reshape(n, n)
            step = np.linalg.solve(curve, slope)
            after.append(w - step * min(1.0, 5.0 / max(1e-12, float(np.abs(step).max()))))
        weights = after
    weights = [np.round(w, 6) for w in weights]
    values = [x @ w[:-1] + w[-1] for x, w in zip(labelled, weights)]
    curves = [fit_logistic(v[:, None], y, ridge=0.01) for v in values]
    calibrated = np.array([c[0] * v + c[1] for c, v in zip(curves, values)]).T
    return Model(weights, curves, fit_logistic(calibrated, y, ridge=0.01))


def _packed(batches):
    for batch in batches:
        for a, content, meta in _features_of(batch):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, len(content)),
                 *[pa.array([x.tobytes() for x in m.astype("<f4")], pa.binary()) for m in (content, meta)]],
                names=["id", "content", "meta"])


def _sampled(docs: DataFrame, labels: DataFrame, key: str, label: str) -> tuple[list[np.ndarray], np.ndarray, DataFrame]:
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(key).cast("long").alias("id"))
    known = known.agg(F.min(label).cast("int").alias("label"))
    picked = [known.where((F.col("label") == y) & ~is_held_out(F.col("id"))).orderBy(F.xxhash64("id"), "id").limit(LABELLED)
              for y in (0, 1)]
    picked = [tuple(r) for part in picked for r in part.collect()]
    features = docs.where("id is not null").select("id", "text", "source", "lang", "n_chars").mapInArrow(
        _packed, "id long, content binary, meta binary")
    pool = features.join(known, "id", "left_anti")
    if not picked:
        return [], np.empty(0), pool
    wanted = F.broadcast(docs.sparkSession.createDataFrame(picked, "id long, label int"))  # at most 2 * LABELLED rows

    def run(batches):
        for batch in batches:
            for a, content, meta in _features_of(batch):
                n = len(content)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), batch.column(1).slice(a, n),
                     pa.array([x.tobytes() for x in content], pa.binary()), pa.array([x.tobytes() for x in meta], pa.binary())],
                    names=["id", "label", "content", "meta"])

    rows = docs.join(wanted, "id").select("id", "label", "text", "source", "lang", "n_chars")
    rows = rows.mapInArrow(run, "id long, label int, content binary, meta binary").collect()
    rows.sort(key=lambda r: (r["id"], bytes(r["content"])))
    y = np.array([r["label"] for r in rows])
    views = [np.array([np.frombuffer(bytes(r[c]), float) for r in rows]) for c in ("content", "meta")]
    return views, y, pool


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
          lang: str = "lang", chars: str = "n_chars", label: str = "quality") -> DataFrame:
    """(doc_id, held_out, content_score, metadata_score, score, kept) per row; kept where the score is at least 0.5.

    Labels are learned only from rows that aren't held out. Null texts are empty; a null source, language or length is a
    value of its own. Rows with a null doc_id are scored; repeated rows score alike; of several labels of a doc_id the
    smaller one counts. Without labels of both kinds every score is 1. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"), F.col(source).cast("string").alias("source"),
                       F.col(lang).cast("string").alias("lang"), F.col(chars).cast("long").alias("n_chars"))
    labelled, y, pool = _sampled(rows, labels, key, label)
    both = len(set(y.tolist())) == 2
    pool = sums_over(write_scratch(pool, "quality-features")) if both else None
    model = spark.sparkContext.broadcast(co_train(labelled, y, pool) if both else None)

    def run(batches):
        for batch in batches:
            for a, content, meta in _features_of(batch):
                n = len(content)
                found = model.value.scores(content, meta) if model.value else [np.ones(n)] * 3
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), batch.column(1).slice(a, n), *[pa.array(x) for x in found],
                     pa.array(found[2] >= 0.5)],
                    names=["doc_id", "held_out", "content_score", "metadata_score", "score", "kept"])

    rows = rows.select("id", is_held_out(F.col("id")).alias("held_out"), "text", "source", "lang", "n_chars")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, content_score double, metadata_score double, score double, kept boolean")
