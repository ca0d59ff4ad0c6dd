"""The hash tree, the filter audit and the centroids against plain Python, on tables with nulls, repeats, ties, empty and
long texts and columns whose names clash with the operators' own."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermill.llm import centroids, filter_audit, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- sharding ---


def _u(name, key):
    digits = int(hashlib.md5(f"{name}|{'' if key is None else key}".encode()).hexdigest()[:13], 16)
    return -math.log((digits + 0.5) / 2**52)


def _down(key, tree):
    """Shard of a key by plain descent."""
    def won(names):
        return min(names)[1]

    def weigh(shards, name):
        weights = Counter()
        for s in shards:
            weights[name(s)] += s.weight
        return weights

    draw, region = min((_u(f"region|{g}", key) / w, g) for g, w in weigh(tree.built, lambda s: s.region).items() if w)
    best = (draw, None)
    for s in tree.grafts:
        best = min(best, (_u(f"graft|{s.number}", key) / s.weight, s.number), key=lambda x: x[0])
    if best[1] is not None:
        return best[1]
    inside = [s for s in tree.built if s.region == region]
    rack = won((_u(f"rack|{region}|{r}", key) / w, r) for r, w in weigh(inside, lambda s: s.rack).items() if w)
    inside = [s for s in inside if s.rack == rack]
    return won((_u(f"shard|{region}|{rack}|{s.number}", key) / s.weight, s.number) for s in inside if s.weight)


@pytest.fixture(scope="module")
def filed(spark):
    rng = random.Random(3)
    texts = ["", None, "a", "é" * 3, "long " * 40_000, "line\nbreak"]
    rows = [(i, rng.choice(texts), 1, 2, "x", 4.0) for i in range(600)]
    rows += [(7, "same", 0, 0, "y", 0.0)] * 5000 + [(7, "other", 0, 0, "y", 0.0), (None, "no key", 0, 0, None, None), (None, None, 0, 0, None, None)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, n long, run long, order string, shard double").repartition(5)


def test_shards_slots_and_growth(filed):
    rows, frame = filed
    tree = sharding.Tree.even()
    got = sharding.place(frame, tree).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    where = {r["doc_id"]: (r["shard"], r["grown_shard"]) for r in got}
    assert all(where[r["doc_id"]] == (r["shard"], r["grown_shard"]) for r in got)
    assert where == {i: (_down(i, tree), _down(i, tree.grown())) for i, *_ in rows}
    assert {g for s, g in where.values() if g != s} == {40}
    assert all(s.region == r["region"] and s.rack == r["rack"] for r in got for s in tree.built if s.number == r["shard"])
    for shard in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_every_growth_step_moves_keys_only_into_the_new_shard(spark):
    keys = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    tree = sharding.Tree.even(3, 2, 2)
    for _ in range(4):
        rows = sharding.place(keys, tree).select("doc_id", "shard", "grown_shard").collect()
        tree = tree.grown()
        after = {r["doc_id"]: r["shard"] for r in sharding.place(keys, tree).select("doc_id", "shard").collect()}
        new = tree.grafts[-1].number
        assert all(after[r["doc_id"]] == r["grown_shard"] and r["grown_shard"] in (r["shard"], new) for r in rows)
        held = Counter(after.values())
        assert set(held) == set(range(new + 1)) and max(held.values()) < 1.6 * 4000 / (new + 1)


def test_weights_move_keys_only_in_and_out_of_changed_subtrees(spark):
    keys = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    tree = sharding.Tree.even(3, 2, 2)
    heavy = sharding.Tree(tuple(sharding.Shard(s.number, s.region, s.rack, 5.0 if s.number == 0 else 0.0 if s.number == 11 else 1.0)
                                for s in tree.built))
    a, b = ({r["doc_id"]: r for r in sharding.place(keys, t).collect()} for t in (tree, heavy))
    for i, r in a.items():
        if r["region"] != b[i]["region"]:  # only regions 0 (heavier) and 2 (lighter) changed their weight
            assert b[i]["region"] == 0 or r["region"] == 2
    assert not any(r["shard"] == 11 for r in b.values())
    share = sum(r["shard"] == 0 for r in b.values()) / 6000
    assert abs(share - 5 / 15) < 0.03


def test_no_documents_have_no_shards(filed):
    assert sharding.place(filed[1].where("false")).count() == 0


def test_slices_number_like_one_order(filed, monkeypatch):
    monkeypatch.setattr(sharding, "SLICE_ROWS", 2)
    monkeypatch.setattr(sharding, "ALIKE_ROWS", 7)
    got = sharding.place(filed[1]).select("shard", "slot").collect()
    held = Counter(r["shard"] for r in got)
    assert Counter(map(tuple, got)) == Counter((s, i) for s, n in held.items() for i in range(n))


# --- filter audit ---


def _plain_audit(docs, labels):
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    seen = []
    for i, t, part in docs:
        t = t or ""
        words = WORD.findall(t)
        fails = set()
        fails |= {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t) else set()
        fails |= {"D"} if re.search("[#$%&*|]", t) else set()
        fails |= {"E"} if i is not None and t in first and first[t] < i else set()
        seen.append((part or "", fails, i in good and i is not None, i in toxic and i is not None))
    out = {}
    for part in {p for p, *_ in seen}:
        removed_by = Counter()
        for order in permutations("ABCDE"):
            there = [x[1:] for x in seen if x[0] == part]
            gone = []
            for step, f in enumerate(order):
                removed = [x for x in there if f in x[0]]
                redundant = sum(f in x[0] for x in gone)
                there = [x for x in there if f not in x[0]]
                gone += removed
                removed_by[f] += len(removed)
                out[part, "".join(order), step + 1] = [
                    len(there), len(removed), redundant, sum(x[1] == {f} for x in seen if x[0] == part),
                    sum(x[1] for x in removed), sum(x[2] for x in removed)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_by[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_audit_of_all_orders(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [None, "", "A B C", "price $5", " ".join(rng.choices(vocabulary, k=230)), " ".join(rng.choices(vocabulary[:40], k=260)),
             " ".join(rng.sample(vocabulary, 200)), "WORD " * 210, "é ü # " * 90, "x" * 70_000, "a " * 30_000]
    docs = [(i if i % 17 else None, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(300)]
    docs += [(5, texts[6], "en"), (5, texts[6], "de"), (2, texts[6], "en"), (1 << 40, texts[6], "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in rng.choices(range(300), k=200)] + [(None, 1, 1)]
    frame = spark.createDataFrame([(*d, 1, "x", 5) for d in docs], "doc_id long, text string, lang string, n int, part string, low int")
    said = spark.createDataFrame([(*x, "z") for x in labels], "doc_id long, quality int, toxic int, lang string")
    got = {(r[0], r[1], r[2]): tuple(r[3:]) for r in filter_audit.audit(frame.repartition(4), said).collect()}
    want = _plain_audit(docs, labels)
    assert len(got) == 3 * 600 and got == want
    assert filter_audit.audit(frame.where("false"), said).count() == 0
    bare = filter_audit.audit(frame, said.where("false"))
    assert bare.agg(F.sum("good_lost"), F.sum("toxic_lost")).first() == (0, 0)


def test_fields_do_not_overflow():
    import pyarrow as pa

    most = (1 << 62) - 1
    table = filter_audit._unpacked(pa.table({"part": ["x", "x"], "mask": [0, 31], "n": [most, most]}))
    assert set(table["kept"].to_pylist()) == {most} and set(table["removed"].to_pylist()) == {0, most}


# --- centroids ---


def _plain_clusters(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) and abs(x) < 2**20 for x in v)]
    by_hash = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest()))
    centers = [v for _, v in by_hash[:k]]

    def assign():
        out = []
        for _, v in kept:
            out.append(min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers)))
        return out

    for _ in range(rounds):
        who = assign()
        for c in range(len(centers)):
            mine = [v for (_, v), (_, n) in zip(kept, who) if n == c]
            if mine:
                centers[c] = [sum(x) // len(mine) for x in zip(*mine)]
    who = assign()
    inertia = Counter()
    for d, n in who:
        inertia[n] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return Counter((i, n, d, inertia[n], sum(inertia.values()), digest[n]) for (i, _), (d, n) in zip(kept, who))


def _vectors(n=260):
    rng = np.random.default_rng(4)
    spots = rng.normal(0, 2, (9, 64))
    rows = [(i, [float(x) for x in spots[i % 9] + rng.normal(0, 0.3, 64)]) for i in range(n)]
    same = rows[3][1]
    rows += [(1000 + i, same) for i in range(120)] + [(3, same), (3, rows[4][1]), (None, rows[5][1])]
    rows += [(2000, None), (2001, same[:63]), (2002, same[:63] + [None]), (2003, same[:63] + [float("nan")]),
             (2004, same[:63] + [float("inf")]), (2005, same[:63] + [1e30]), (2006, []), (2007, [0.0] * 64), (2008, [-0.001] * 64)]
    return rows


SCHEMA = "vec_id long, embedding array<double>, cluster string, v int, rest string"


def test_clusters_like_plain_lloyd(spark):
    rows = _vectors()
    frame = spark.createDataFrame([(*r, "c", 1, "r") for r in rows], SCHEMA).repartition(4)
    got = centroids.cluster(frame)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(map(tuple, got.collect())) == _plain_clusters(rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors_make_few_centroids(spark, n):
    rows = _vectors()[:n]
    frame = spark.createDataFrame([(*r, "c", 1, "r") for r in rows], SCHEMA)
    assert Counter(map(tuple, centroids.cluster(frame).collect())) == _plain_clusters(rows)


def test_only_null_ids(spark):
    rows = [(None, v) for _, v in _vectors()[:3]]
    frame = spark.createDataFrame([(*r, "c", 1, "r") for r in rows], SCHEMA)
    assert sum(r["cluster"] is not None for r in centroids.cluster(frame).collect()) == 3


def test_bounds_rule_out_most_centroids_and_never_the_nearest():
    rng = np.random.default_rng(6)
    vectors = np.concatenate([rng.integers(-70, 70, (400, 64)), np.repeat(rng.integers(-5, 5, (20, 64)), 10, 0)]).astype(np.int64)
    vectors[:300, 8:] //= 40
    centers = np.concatenate([vectors[::60], vectors[:1], vectors[:1] * (1 << 18)])
    mean = vectors.mean(0)
    _, axes = np.linalg.eigh(np.cov(vectors.T))
    axes = axes[:, ::-1]
    lead, rest = centroids.rotated(vectors, mean, axes)
    who, best, verified = centroids.nearest(vectors, lead, rest, centers, *centroids.rotated(centers, mean, axes))
    distances = ((vectors[:, None] - centers[None]) ** 2).sum(2)
    assert (who == distances.argmin(1)).all() and (best == distances.min(1)).all()
    assert verified < 0.6 * distances.size
