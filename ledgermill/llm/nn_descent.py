"""Near-duplicate vectors by NN-descent.

Vectors are normalised; equal vectors of a label are collapsed to one node with a multiplicity. Then:

1. Start: in each of ``SEED_TABLES`` tables a node gets a few sign bits of random projections and one more projection; nodes
   next to each other in that order, within a label, start as neighbours.
2. Descent: around every node its neighbours and those that have it as neighbour (in chunks of ``HUB``, so a hub is many
   tasks' work) are compared among each other; a node keeps its ``KEEP`` best. Rounds go on until few lists change.
3. Saturated lists (all of a node's neighbours are near-duplicates, so there may be more than fit) are enlarged to the
   whole group that the links found so far connect: groups are compared in pairs of blocks of ``BLOCK`` members. That gives
   all links inside a group, counted without being listed.
4. Audit: for ``AUDITED`` nodes by hash (``MORE`` times as many if under ``ENOUGH`` of them have links) the linked nodes are
   counted by brute force. Nodes with up to ``FEW_LINKS`` and with more are judged apart, each node alike whatever its
   number of links or copies. While the mean recall of either is under ``RECALL``, or too few nodes have links to tell, the
   descent starts again with other projections and the links found so far are kept.
5. If no attempt passes, all pairs within a label are compared in blocks, as within groups. That is exact, and grows with
   the square of a label.

Sign bits, tables and rounds grow with the logarithm of the largest label, so that a place in a table's order stays as
likely to hold both of a pair.

Every pair that counts has been compared in double precision on its own. Work is rows x list length, apart from the links
inside groups of near-duplicates, which are the output's own count, and from step 5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermill.llm.graph import components
from ledgermill.scratch import write_scratch

SEED_TABLES, SEED_BITS, SEED_STEPS, SEED_LABEL = 6, 6, 2, 64
KEEP, ROUNDS, FEW_CHANGES = 6, 4, 0.01
HUB, UNIT_NODES, BLOCK = 256, 1024, 1024
AUDITED, MORE, ENOUGH, FEW_LINKS, RECALL, ATTEMPTS = 1000, 4, 34, 8, 0.97, 3


def _rows(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(values):
        return np.empty((0, 0))
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def unit_vectors(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(vec_id, label, v): usable rows, their vectors of length 1 in double precision."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"),
                          F.col(vector).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & fine)
    top = F.array_max(F.transform("v", F.abs))
    rows = rows.where(top > 0).withColumn("v", F.transform("v", lambda x: x / top))  # squares neither over- nor underflow
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    return rows.withColumn("v", F.transform("v", lambda x: x / norm))


def _projections(seed: int, bits: int):
    tables = SEED_TABLES + 2 * (bits - SEED_BITS)

    def run(batches):
        for batch in batches:
            by_dim: dict[int, list[int]] = {}
            for i, n in enumerate(batch.column("v").value_lengths().to_pylist()):
                by_dim.setdefault(n, []).append(i)
            for dim, rows in by_dim.items():
                part = batch.take(pa.array(rows))
                v = _rows(part.column("v"))
                for table in range(tables):
                    plane = np.random.default_rng([seed, table, dim]).normal(size=(dim, bits + 1))
                    p = v @ plane
                    code = (p[:, :bits] > 0) @ (1 << np.arange(bits))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("node"), part.column("label"), pa.array(np.full(len(v), dim, np.int64)),
                         pa.array(np.full(len(v), table, np.int64)), pa.array(code.astype(np.int64)), pa.array(p[:, -1])],
                        names=["node", "label", "dim", "table", "code", "along"])

    return run


def _start(nodes: DataFrame, seed: int, bits: int) -> DataFrame:
    """(a, b): neighbours in some table's order."""
    kind = nodes.schema["label"].dataType.simpleString()
    spread = nodes.select("node", "label", "v").mapInArrow(
        _projections(seed, bits), f"node long, label {kind}, dim long, table long, code long, along double")
    order = Window.partitionBy("label", "dim", "table", "code").orderBy("along", "node")
    near = [spread.select("node", F.lag("node", i).over(order).alias("b")) for i in range(1, SEED_STEPS + 1)]
    pairs = near[0].union(near[1]) if SEED_STEPS == 2 else near[0]
    pairs = pairs.where("b is not null").select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b"))
    return pairs.distinct()


def _similar(batches):
    for batch in batches:
        a, b = _rows(batch.column("va")), _rows(batch.column("vb"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(np.einsum("ij,ij->i", a, b))], names=["a", "b", "s"])


def _both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.union(pairs.select("b", "a", "s")).toDF("node", "near", "s")


def _best(lists: DataFrame) -> DataFrame:
    order = Window.partitionBy("node").orderBy(F.col("s").desc(), "near")
    ranked = lists.distinct().withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= KEEP).drop("rank")


def _compare_around(table: pa.Table) -> pa.Table:
    """Around each centre: neighbours against all members of the chunk; pairs that would enter either list."""
    out_a, out_b, out_s = [], [], []
    if len(table):
        table = table.combine_chunks()
        dims = np.array(table["v"].combine_chunks().value_lengths())
        for dim in np.unique(dims):
            part = table.filter(pa.array(dims == dim))
            centre, chunk = part["centre"].to_numpy(), part["chunk"].to_numpy()
            member, least, ahead = part["member"].to_numpy(), part["least"].to_numpy(), part["ahead"].to_numpy()
            v = _rows(part["v"])
            order = np.lexsort((~ahead, chunk, centre))
            cuts = np.flatnonzero(np.r_[True, np.diff(centre[order]) != 0]
                                  | np.r_[True, np.diff(chunk[order]) != 0])
            for a, b in zip(cuts, np.append(cuts[1:], len(order))):
                rows = order[a:b]
                front = rows[ahead[rows]]
                s = v[front] @ v[rows].T
                better = (s > least[front][:, None]) | (s > least[rows][None, :])
                better &= member[front][:, None] != member[rows][None, :]
                i, j = np.nonzero(better)
                out_a.append(member[front[i]])
                out_b.append(member[rows[j]])
                out_s.append(s[i, j])
    a, b = (np.concatenate([np.empty(0, np.int64)] + x) for x in (out_a, out_b))
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b), "s": np.concatenate([np.empty(0)] + out_s)})


def _descend(nodes: DataFrame, lists: DataFrame, units: int) -> DataFrame:
    """One round: compare around each node, and keep the best."""
    full = lists.groupBy("node").agg(F.count("*").alias("n"), F.min("s").alias("low"))
    least = full.select("node", F.when(F.col("n") >= KEEP, F.col("low")).otherwise(-2.0).alias("least"))
    members = nodes.join(least, "node", "left").select(
        F.col("node").alias("member"), "v", F.coalesce("least", F.lit(-2.0)).alias("least"))
    hubs = lists.groupBy("near").agg(F.ceil(F.count("*") / HUB).cast("long").alias("chunks"))
    sized = hubs.withColumnRenamed("near", "centre")
    behind = lists.select(F.col("near").alias("centre"), F.col("node").alias("member")).join(sized, "centre")
    behind = behind.select("centre", F.pmod(F.xxhash64("member"), "chunks").alias("chunk"), "member",
                           F.lit(False).alias("ahead"))
    ahead = lists.select(F.col("node").alias("centre"), F.col("near").alias("member")).join(sized, "centre", "left")
    chunks = F.sequence(F.lit(0).cast("long"), F.coalesce("chunks", F.lit(1)) - 1)
    ahead = ahead.select("centre", F.explode(chunks).alias("chunk"), "member", F.lit(True).alias("ahead"))
    around = behind.union(ahead).join(members, "member")
    around = around.withColumn("unit", F.pmod(F.xxhash64("centre", "chunk"), F.lit(units)))
    found = around.groupBy("unit").applyInArrow(_compare_around, "a long, b long, s double").distinct()
    return write_scratch(_best(lists.union(_both_ways(found))), "descent-lists")


def _graph(nodes: DataFrame, seed: int, size: int, bits: int) -> DataFrame:
    """Neighbour lists (node, near, s) when a descent has settled."""
    pairs = _start(nodes, seed, bits)
    a = nodes.select(F.col("node").alias("a"), F.col("v").alias("va"))
    b = nodes.select(F.col("node").alias("b"), F.col("v").alias("vb"))
    scored = pairs.join(a, "a").join(b, "b").select("a", "b", "va", "vb").mapInArrow(_similar, "a long, b long, s double")
    lists = write_scratch(_best(_both_ways(scored)), "descent-lists")
    for _ in range(ROUNDS + bits - SEED_BITS):
        after = _descend(nodes, lists, size // UNIT_NODES + 1)
        changed = after.join(lists, ["node", "near"], "left_anti").count()
        lists = after
        if changed <= FEW_CHANGES * KEEP * size:
            break
    return lists


def _connected(near: np.ndarray):
    """(rows, columns) of each connected part of a link matrix; every row is looked at once."""
    free_rows, free_columns = near.any(1), near.any(0)
    while free_rows.any():
        rows, columns = np.array([free_rows.argmax()]), []
        part = []
        while len(rows):
            free_rows[rows] = False
            part.append(rows)
            new = np.flatnonzero(near[rows].any(0) & free_columns)
            free_columns[new] = False
            columns.append(new)
            rows = np.flatnonzero(near[:, new].any(1) & free_rows)
        yield np.concatenate(part), np.concatenate(columns)


def _count_links(threshold: float):
    """Of two blocks of a group: how many links each member has in them, by multiplicity of the other end, to how many
    nodes, and a spanning forest of these links."""

    def run(table: pa.Table) -> pa.Table:
        node, block, times = (table[c].to_numpy() for c in ("node", "block", "times"))
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        v = _rows(table["v"])
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        near = v[left] @ v[right].T >= threshold
        near &= node[left][:, None] != node[right][None, :]
        ids, counts, others = [node[left]], [near @ times[right]], [near.sum(1)]
        if i != j:
            ids.append(node[right])
            counts.append(near.T @ times[left])
            others.append(near.sum(0))
        # a spanning forest: each linked member with the smallest one that the links of both blocks reach
        e = []
        for rows, columns in _connected(near):
            members = np.unique(np.concatenate((node[left[rows]], node[right[columns]])))
            e += [(int(x), int(members[0])) for x in members[1:]]
        n = len(np.concatenate(ids))
        return pa.table({"node": np.concatenate([*ids, np.array([x for x, _ in e], np.int64)]),
                         "links": np.concatenate([*counts, np.zeros(len(e), np.int64)]).astype(np.int64),
                         "others": np.concatenate([*others, np.zeros(len(e), np.int64)]).astype(np.int64),
                         "to": pa.array([None] * n + [y for _, y in e], pa.int64())})

    return run


def _counted(nodes: DataFrame, group: DataFrame, threshold: float) -> DataFrame:
    """(node, links, others, to): all links inside the groups of (node, component), in pairs of blocks."""
    blocks = group.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"))
    members = nodes.join(group, "node").join(blocks, "component")
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    members = members.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    members = members.select("component", "i", "j", "block", "node", "times", "v")
    counted = members.groupBy("component", "i", "j").applyInArrow(
        _count_links(threshold), "node long, links long, others long, to long")
    return write_scratch(counted, "descent-counts")


def _audit(sample: list, threshold: float):
    """For some nodes: how many nodes of a batch they link with."""
    by_kind: dict[int, list] = {}
    for r in sample:
        by_kind.setdefault(r["kind"], []).append(r)
    asked = {k: (np.array([r["node"] for r in x]), np.array([r["v"] for r in x])) for k, x in by_kind.items()}

    def run(batches):
        for batch in batches:
            rows: dict[int, list[int]] = {}
            for i, kind in enumerate(batch.column("kind").to_pylist()):
                if kind in asked:
                    rows.setdefault(kind, []).append(i)
            for kind, at in rows.items():
                ids, v = asked[kind]
                for first in range(0, len(at), BLOCK):
                    part = batch.take(pa.array(at[first : first + BLOCK]))
                    near = _rows(part.column("v")) @ v.T >= threshold
                    near &= part.column("node").to_numpy()[:, None] != ids[None, :]
                    yield pa.RecordBatch.from_pydict({"node": pa.array(ids, pa.int64()),
                                                      "others": pa.array(near.sum(0).astype(np.int64))})

    return run


def _truth(nodes: DataFrame, size: int, threshold: float) -> dict[int, int]:
    """Linked nodes of each audited node that has any."""
    truth: dict[int, int] = {}
    kinds = nodes.select("node", F.xxhash64("label", F.size("v")).alias("kind"), "v")
    for many in (AUDITED, MORE * AUDITED):
        sample = kinds.orderBy(F.xxhash64("node"), "node").limit(many).collect()
        counts = kinds.mapInArrow(_audit(sample, threshold), "node long, others long").groupBy("node")
        counts = counts.agg(F.sum("others").alias("others")).where("others > 0")
        truth = {r["node"]: r["others"] for r in counts.collect()}
        if len(truth) >= ENOUGH or many >= size:
            break
    return truth


def _passes(truth: dict[int, int], got: dict[int, int], size: int) -> bool:
    """Are enough linked nodes audited, and is the recall of a node high among those with few links and those with many?"""
    if len(truth) < ENOUGH and size > MORE * AUDITED:
        return False
    recall: dict[bool, list[float]] = {}
    for node, n in truth.items():
        recall.setdefault(n > FEW_LINKS, []).append(min(n, got.get(node, 0)) / n)
    return all(sum(x) >= RECALL * len(x) for x in recall.values())


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = 0.98) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors linked directly), component_id, kept (vec_id = component_id).

    Two vectors link when their labels are equal and not null and their cosine is at least ``threshold``. Null or zero
    vectors, and those with null or non-finite components, link with nothing, nor do rows with a null vec_id (their
    component is null). Vectors of different length don't link. Rows that repeat a vec_id count once.
    """
    spark = vectors.sparkSession
    everyone = vectors.select(F.col(key).cast("long").alias("vec_id")).distinct()
    usable = unit_vectors(vectors, key, vector, label).dropDuplicates(["vec_id"])
    usable = write_scratch(usable, "descent-vectors")
    groups = usable.groupBy("label", "v").agg(F.min("vec_id").alias("node"), F.count("*").alias("times"))
    nodes = write_scratch(groups, "descent-nodes")
    size = nodes.count()
    largest = nodes.groupBy("label", F.size("v")).count().agg(F.max("count")).first()[0] or 0
    bits = max(SEED_BITS, (largest // SEED_LABEL).bit_length())
    truth = _truth(nodes, size, threshold)
    links = None
    for seed in range(ATTEMPTS):
        lists = _graph(nodes, seed, size, bits)
        found = lists.where(F.col("s") >= threshold).select(F.col("node").alias("a"), F.col("near").alias("b"))
        links = write_scratch(found if links is None else links.union(found).distinct(), "descent-links")
        counted = _counted(nodes, components(links, "a", "b", "descent-groups"), threshold)
        totals = counted.groupBy("node").agg(F.sum("links").alias("links"), F.sum("others").alias("others"))
        got = {r["node"]: r["others"] for r in totals.where(F.col("node").isin(list(truth))).collect()} if truth else {}
        if _passes(truth, got, size):
            break
    else:
        counted = _counted(nodes, nodes.select("node", F.struct("label", F.size("v")).alias("component")), threshold)
        totals = counted.groupBy("node").agg(F.sum("links").alias("links"))
    final = components(counted.where("`to` is not null"), "node", "to", "descent-components")
    ids = groups_of(nodes, totals, final)
    joined = usable.join(ids, (usable["label"] == ids["of_label"]) & (usable["v"] == ids["of_v"])).select(
        "vec_id", "n_links", "component_id")
    out = everyone.join(joined, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def groups_of(nodes: DataFrame, totals: DataFrame, final: DataFrame) -> DataFrame:
    """Links and component of each distinct vector; the copies of a vector link with each other."""
    out = nodes.join(totals, "node", "left").join(final, "node", "left")
    return out.select(F.col("label").alias("of_label"), F.col("v").alias("of_v"),
                      (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
                      F.coalesce("component", "node").alias("component_id"))
