"""N-gram Jaccard self-join of documents: a size-aware heavy-light join.

A document is its set of distinct word shingles; two documents link when their sets' Jaccard similarity reaches
``percent`` / 100. With sizes a and b that means an overlap of at least c(a, b) = ceil(percent * (a + b) / (100 + percent)).

* Equal sets are collapsed into classes first (one grouped minimum), so thousands of copies weigh as one. Classes are
  what is joined; the classes of one doc_id are linked.
* **Light** sets (at most ``boundary`` shingles) list all their subsets of c(a, b) shingles for every possible partner
  size b. Sharing a subset of c shingles proves an overlap of c, so sets under one subset need no further test: those
  whose sizes allow it link to the smallest one there, which connects exactly what the pairwise links would.
* **Heavy** sets are found through inverted lists. Shingles are globally ordered, rare ones first, and a set is entered
  under its first a - ceil(percent * a / 100) + 1 shingles, with their places. Two linked sets share one that stands among
  the first a - c + 1 of the one and b - c + 1 of the other, and every meeting on a list must be such a one. A pair goes on
  if the first shingles of both agree as far as a link needs (all but a - c of one side's); its whole sets are read last.
  Rounds verify each set against one leader of each list it is on, and join what links into components, until none
  links any more (``ROUNDS`` at most); lists whose sets are in one component are closed. Then every pair of sets in
  *different* components that meets on an open list is verified, so no link that could change a component is missed, and a
  group of near copies never lists all its pairs. Sets of such a group that are too far apart to link would still meet;
  ``SKETCH`` parity bits of each set, which differ in no more places than the sets do, part them on the list itself. A pair
  that met on one of the last ``EARLIER`` lists before of both sides does not meet again, so it is a row once, not once a list.
* The boundary is the size with the least estimated number of rows of both sides together.

The rarity order comes from a table of 2**18 counts over all documents' shingles: any order gives the same result, so hash
collisions in it only cost time. It is the one thing collected (1 MB, whatever the input).

Memory: a task holds slices of texts (``text.SLICE_BYTES``) and single sets. All groups are plain joins and pre-aggregated
minima, which split when skewed. Whole sets are made anew from the texts in each round, for those that its pairs need: a
bitmap of 2**``_BITMAP_BITS`` bits over hashed ids (8 MB, whatever the input) tells a pass over the texts which to take, so
texts are never exchanged; what it lets through besides only costs time.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.graph import components
from ledgermill.llm.text import give_back, mix, shingle_sets, slices
from ledgermill.scratch import write_scratch

#: Shingles that two linked heavy sets share at least among the first ones kept of each.
SHARED = 4
#: Rounds that join sets through leaders.
ROUNDS = 4
#: The boundary between light and heavy is sought in this range of set sizes.
LEAST_BOUNDARY, MOST_BOUNDARY = 6, 24
_COUNT_BITS, _BLOCK = 18, 4096
_BITMAP_BITS = 26
#: Longs of a set's parity bits.
SKETCH = 8
#: Entries before one of its own that an entry names, so that two sets that met on one of them do not meet again.
EARLIER = 16


def _class_of():
    """The class of a set, from its size and two sums of its hashes."""
    return F.xxhash64("n", "s1", "s2")


def overlap_needed(a: int, b: int, percent: int) -> int:
    return -(-percent * (a + b) // (100 + percent))


def subset_sizes(a: int, boundary: int, percent: int) -> list[int]:
    """The overlaps that a light set of size a may need with light partners."""
    low, high = -(-percent * a // 100), min(boundary, 100 * a // percent)
    return sorted({overlap_needed(a, b, percent) for b in range(low, high + 1)})


def entries(a: int, percent: int) -> int:
    """How many of its rarest shingles are kept of a heavy set; it is listed under all but the last ``SHARED`` - 1."""
    return min(a, a + percent * -a // 100 + SHARED)


def choose_boundary(sizes: dict[int, int], percent: int) -> int:
    """The boundary with the fewest rows: subsets of light sets plus list entries (read twice) of heavy ones."""

    def rows(boundary: int) -> int:
        light = sum(n * sum(comb(a, c) for c in subset_sizes(a, boundary, percent))
                    for a, n in sizes.items() if 0 < a <= boundary)
        least = -(-percent * (boundary + 1) // 100)
        return light + sum(2 * n * entries(a, percent) for a, n in sizes.items() if a >= least)

    return min(range(LEAST_BOUNDARY, MOST_BOUNDARY + 1), key=lambda b: (rows(b), b))


def _count_shingles(text: str, k: int):
    def run(batches):
        counts = np.zeros(1 << _COUNT_BITS, np.int64)
        for batch in batches:
            for _, _, texts in slices(batch.column(text)):
                for one in shingle_sets(texts.words(), k):
                    np.add.at(counts, (one >> np.uint64(64 - _COUNT_BITS)).astype(np.int64), 1)
        if counts.any():
            blocks = counts.reshape(-1, _BLOCK)
            yield pa.RecordBatch.from_pydict(
                {"block": pa.array(range(len(blocks)), pa.int32()), "counts": pa.array([b.tobytes() for b in blocks])}
            )
        give_back()

    return run


def _add_counts(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_buffer(), np.int64) for x in table["counts"])
    return pa.table({"block": table["block"][:1], "counts": pa.array([total.tobytes()], pa.binary())})


def shingle_counts(docs: DataFrame, text: str, k: int) -> np.ndarray:
    """How many documents hold a shingle of each hash bucket, over all documents. Tasks' counts are added up in lanes of
    256 tasks first."""
    parts = docs.select(text).mapInArrow(_count_shingles(text, k), "block int, counts binary")
    parts = parts.withColumn("lane", F.floor(F.spark_partition_id() / 256)).groupBy("block", "lane")
    rows = parts.applyInArrow(_add_counts, "block int, counts binary").groupBy("block")
    rows = rows.applyInArrow(_add_counts, "block int, counts binary").collect()
    counts = np.zeros((1 << _COUNT_BITS) // _BLOCK * _BLOCK, np.int64).reshape(-1, _BLOCK)
    for r in rows:
        counts[r["block"]] = np.frombuffer(r["counts"], np.int64)
    return counts.reshape(-1)


def sketch_of(one: np.ndarray) -> np.ndarray:
    """Parity bits of a set: each element turns one over, so two sets differ in at least as many elements as bits."""
    odd = np.bincount((one & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _signatures(k: int, percent: int, counts):
    """Per document: set size, two hashes of the set, its parity bits (null if it is surely light), and its rarest shingles
    (all of them up to MOST_BOUNDARY)."""

    def run(batches):
        count = counts.value
        for batch in batches:
            for a, b, texts in slices(batch.column(1)):
                n, s1, s2, first, sketch = [], [], [], [], []
                for one in shingle_sets(texts.words(), k):
                    n.append(len(one))
                    sketch.append(sketch_of(one) if len(one) >= LEAST_BOUNDARY else None)
                    for sums, value in zip((s1, s2), _sums(one)):
                        sums.append(value)
                    order = np.lexsort((one, count[(one >> np.uint64(64 - _COUNT_BITS)).astype(np.int64)]))
                    keep = len(one) if len(one) <= MOST_BOUNDARY else entries(len(one), percent)
                    first.append(one[order[:keep]].view(np.int64))
                lengths = np.cumsum([0] + [len(x) for x in first]).astype(np.int32)
                flat = np.concatenate(first) if first else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(s1, pa.int64()),
                     pa.array(s2, pa.int64()), pa.ListArray.from_arrays(lengths, flat), pa.array(sketch, pa.list_(pa.int64()))],
                    names=["doc_id", "n", "s1", "s2", "first", "sketch"],
                )
        give_back()

    return run


def _subset_keys(boundary: int, percent: int):
    def run(batches):
        for batch in batches:
            sizes = batch.column("n").to_numpy()
            ids = batch.column("rep").to_numpy()
            lists = batch.column("first")
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                tokens = np.array([lists[int(i)].as_py() for i in rows], np.int64).view(np.uint64)
                tokens.sort(axis=1)
                for c in subset_sizes(int(size), boundary, percent):
                    pick = np.array(list(combinations(range(size), c)))
                    key = np.full((len(rows), len(pick)), c, np.uint64)
                    with np.errstate(over="ignore"):
                        for j in range(c):
                            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + tokens[:, pick[:, j]])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.reshape(-1).view(np.int64)), pa.array(np.repeat(ids[rows], len(pick))),
                         pa.array(np.full(key.size, size, np.int64)), pa.array(np.full(key.size, c, np.int64))],
                        names=["key", "rep", "n", "c"],
                    )

    return run


def _light_links(reps: DataFrame, boundary: int, percent: int) -> DataFrame:
    light = reps.where((F.col("n") > 0) & (F.col("n") <= boundary)).select("rep", "n", "first")
    keys = light.mapInArrow(_subset_keys(boundary, percent), "key long, rep long, n long, c long")
    least = keys.groupBy("key").agg(F.min(F.struct("n", "rep")).alias("least"), F.count("*").alias("many"))
    least = least.where("many > 1").select("key", "least")
    fits = (100 + percent) * F.col("c") >= percent * (F.col("n") + F.col("least.n"))
    pairs = keys.join(least, "key").where(fits & (F.col("rep") != F.col("least.rep")))
    return pairs.select(F.col("rep").alias("x"), F.col("least.rep").alias("y")).distinct()


def _sums(one: np.ndarray) -> tuple[int, int]:
    """Two sums of hashes that tell sets apart."""
    with np.errstate(over="ignore"):
        return int(one.sum(dtype=np.uint64).view(np.int64)), int(mix(one ^ np.uint64(0x5BD1E995)).sum(dtype=np.uint64).view(np.int64))


def _bit_of(column: str):
    """The place of an id in a bitmap."""
    return F.pmod(F.xxhash64(column), F.lit(1 << _BITMAP_BITS))


def _bitmap(ids: DataFrame, column: str) -> np.ndarray:
    """The words of a bitmap with the bits of these ids set."""
    bits = ids.select(_bit_of(column).alias("at"))
    bits = bits.selectExpr("shiftright(at, 6) as word", "shiftleft(1L, cast(at & 63 as int)) as bits")
    table = bits.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # as many words as the bitmap has, at most
    words = np.zeros(1 << (_BITMAP_BITS - 6), np.int64)
    words[table["word"].to_numpy()] = table["bits"].to_numpy()
    return words.view(np.uint64)


def _full_sets(k: int, bitmap):
    """(n, s1, s2, set) of texts whose id the bitmap holds; a task gives a set once."""
    def run(batches):
        words, seen = bitmap.value, set()
        for batch in batches:
            at = batch.column(0).to_numpy()
            there = (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            for _, _, texts in slices(batch.column(1).filter(pa.array(there))):
                rows = []
                for one in shingle_sets(texts.words(), k):
                    key = (len(one), *_sums(one))
                    if key not in seen:
                        seen.add(key)
                        rows.append((*key, one.tobytes()))
                columns = list(zip(*rows)) or [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(),) * 3 + (pa.binary(),))], names=["n", "s1", "s2", "set"])
        give_back()

    return run


def _class_sets(texts: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(rep, set) of the classes whose documents (column ``doc``) are wanted, and of some others."""
    bitmap = texts.sparkSession.sparkContext.broadcast(_bitmap(wanted, "doc"))
    rows = texts.select(_bit_of("doc_id").alias("at"), "text").mapInArrow(_full_sets(k, bitmap), "n long, s1 long, s2 long, set binary")
    return rows.select(_class_of().alias("rep"), "set").groupBy("rep").agg(F.any_value("set").alias("set"))


def _verify(percent):
    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("a0"), batch.column("b0")):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["x", "y", "cx", "cy"]).filter(pa.array(keep, pa.bool_()))
        give_back()

    return run


_PAIRS = "x long, y long, cx long, cy long"


def _sides(pairs: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
    """Pairs with these columns of both their rows, as ``a0``, ``b0``, ``a1``, ... in order."""
    for side, node in (("a", "x"), ("b", "y")):
        mine = rows.select("rep", *[F.col(c).alias(f"{side}{i}") for i, c in enumerate(columns)])
        pairs = pairs.join(mine, F.col(node) == F.col("rep")).drop("rep")
    return pairs


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose whole sets are similar enough, with their components (cx, cy)."""
    return _sides(pairs, sets, "set").select("x", "y", "cx", "cy", "a0", "b0").mapInArrow(_verify(percent), _PAIRS)


def _overlap(nx, ny, percent: int):
    return F.floor((percent * (nx + ny) + (99 + percent)) / F.lit(100 + percent))


def _kept(n, percent: int):
    """:func:`entries` as a column."""
    return n + F.floor(F.lit(-percent) * n / 100) + SHARED


def _promising(pairs: DataFrame, kept: DataFrame, percent: int) -> DataFrame:
    """The pairs whose first shingles agree as far as a link needs. ``kept`` has those of a set's first shingles that
    another set has among its first ones, too.

    Take the side whose first shingles end first in the global order: those that the other set has are among the other's
    first ones, and at most n - c of its shingles may be missing there. Which side that is need not be known: the smaller
    demand holds.
    """
    both = _sides(pairs, kept, "n", "kept")
    need = _overlap(F.col("a0"), F.col("b0"), percent)
    demand = F.least(*[_kept(F.col(n), percent) - (F.col(n) - need) for n in ("a0", "b0")])
    return both.where(F.size(F.array_intersect("a1", "b1")) >= demand).select("x", "y", "cx", "cy")


def _heavy_links(reps: DataFrame, texts: DataFrame, boundary: int, k: int, percent: int) -> DataFrame:
    least = -(-percent * (boundary + 1) // 100)
    heavy = reps.where(F.col("n") >= least)
    first = F.slice("first", 1, _kept(F.col("n"), percent).cast("int"))
    lists = heavy.select("rep", "n", F.posexplode(first).alias("pos", "token"))
    shared = lists.groupBy("token").agg(F.count("*").alias("many")).where("many > 1").select("token")
    lists = write_scratch(lists.join(shared, "token"), "jaccard-shared")
    kept = lists.groupBy("rep").agg(F.first("n").alias("n"), F.collect_list("token").alias("kept"))
    kept = kept.where(F.size("kept") >= SHARED).join(heavy.select("rep", "doc", "sketch"), "rep")
    kept = write_scratch(kept, "jaccard-kept")
    listed = F.col("pos") <= F.col("n") + F.floor(F.lit(-percent) * F.col("n") / 100)

    def meet(a: str, b: str):
        """Whether two entries of a list can be where a linked pair meets first."""
        na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
        need = _overlap(na, nb, percent)
        return (F.col(f"{a}.component") != F.col(f"{b}.component")) & (F.col(f"{a}.pos") <= na - need) & (F.col(f"{b}.pos") <= nb - need)

    def ordered(a: str, b: str):
        """The pair of two entries, smaller rep first."""
        x, y = F.col(f"{a}.rep"), F.col(f"{b}.rep")
        cx, cy = F.col(f"{a}.component"), F.col(f"{b}.component")
        return [F.least(x, y).alias("x"), F.greatest(x, y).alias("y"), F.when(x < y, cx).otherwise(cy).alias("cx"),
                F.when(x < y, cy).otherwise(cx).alias("cy")]

    def linked(pairs: DataFrame) -> DataFrame:
        pairs = write_scratch(_promising(pairs.distinct(), kept, percent), "jaccard-promising")
        needed = pairs.select(F.col("x").alias("rep")).union(pairs.select(F.col("y").alias("rep"))).distinct()
        sets = _class_sets(texts, needed.join(kept.select("rep", "doc"), "rep"), k)
        return write_scratch(_verified(pairs, sets, percent), "jaccard-links")

    links = None
    state = lists.where(listed).join(kept.select("rep"), "rep", "left_semi").withColumn("component", F.col("rep"))
    state = write_scratch(state, "jaccard-lists")
    for turn in range(ROUNDS):
        chosen = F.struct(F.xxhash64("rep", F.lit(turn)).alias("h"), "rep", "n", "pos", "component")
        leads = state.groupBy("token").agg(F.min(chosen).alias("lead"))
        met = state.alias("e").join(leads, "token").where(meet("e", "lead"))
        found = linked(met.select(*ordered("e", "lead")))
        links = found if links is None else links.union(found)
        if found.isEmpty():
            break
        joined = components(found, "cx", "cy", "jaccard-part").withColumnRenamed("component", "into")
        labelled = state.join(joined, F.col("component") == F.col("node"), "left")
        labelled = labelled.select("token", "rep", "n", "pos", F.coalesce("into", "component").alias("component"))
        labelled = write_scratch(labelled, "jaccard-labels")
        mixed = labelled.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b")
        state = write_scratch(labelled.join(mixed.select("token"), "token"), "jaccard-state")
    bits = [f"bits{i}" for i in range(SKETCH)]
    mine = state.groupBy("rep", "n", "component").agg(F.sort_array(F.collect_list(F.struct("pos", "token"))).alias("at"))
    mine = mine.join(kept.select("rep", *[F.col("sketch")[i].alias(b) for i, b in enumerate(bits)]), "rep")
    entry = mine.select("rep", "n", "component", *bits, F.col("at.token").alias("tokens"), F.posexplode("at").alias("i", "e"))
    before = F.slice("tokens", F.greatest(F.col("i") - EARLIER, F.lit(0)) + 1, F.least("i", F.lit(EARLIER)))
    state = entry.select("rep", "n", "component", *bits, "e.pos", "e.token", before.alias("before"))
    x, y = state.alias("ex"), state.alias("ey")
    nx, ny = F.col("ex.n"), F.col("ey.n")
    apart = sum((F.bit_count(F.col(f"ex.{b}").bitwiseXOR(F.col(f"ey.{b}"))) for b in bits), F.lit(0))
    near = apart <= nx + ny - 2 * _overlap(nx, ny, percent)
    new = ~F.arrays_overlap("ex.before", "ey.before")
    pairs = x.join(y, F.col("ex.token") == F.col("ey.token"))
    pairs = pairs.where((F.col("ex.rep") < F.col("ey.rep")) & meet("ex", "ey") & near & new)
    return links.union(linked(pairs.select(*ordered("ex", "ey")))).select("x", "y")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 4,
                       percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included).

    A null or blank text has no shingles and links with nothing. A document with fewer than ``k`` words has its whole
    sequence as its one shingle. Rows with a null doc_id take no part and get a null component. Repeated rows give
    repeated results; different texts under one doc_id count as one linked document. Other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counts = spark.sparkContext.broadcast(shingle_counts(texts, "text", k).astype(np.int32))
    signed = texts.mapInArrow(
        _signatures(k, percent, counts), "doc_id long, n long, s1 long, s2 long, first array<bigint>, sketch array<bigint>"
    )
    signed = write_scratch(signed.withColumn("rep", _class_of()), "jaccard-signatures")
    known = signed.where("doc_id is not null and n > 0")
    reps = known.groupBy("rep").agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("first").alias("first"),
                                    F.first("sketch").alias("sketch"))
    reps = write_scratch(reps, "jaccard-classes")
    small = reps.where(F.col("n") <= 2 * MOST_BOUNDARY).groupBy("n").count().collect()
    boundary = choose_boundary({r["n"]: r["count"] for r in small}, percent)
    links = _light_links(reps, boundary, percent)
    links = links.union(_heavy_links(reps, texts.where("doc_id is not null"), boundary, k, percent))
    several = known.groupBy("doc_id").agg(F.min("rep").alias("y"), F.max("rep").alias("top")).where("y <> top")
    several = write_scratch(several.select("doc_id", "y"), "jaccard-several")
    links = links.union(known.join(several, "doc_id").select(F.col("rep").alias("x"), "y").where("x <> y").distinct())
    found = write_scratch(components(links, "x", "y", "jaccard-components"), "jaccard-found")
    docs_of = reps.select(F.col("rep").alias("node"), "doc")
    least = found.join(docs_of, "node").groupBy("component").agg(F.min("doc").alias("least"))
    ids = docs_of.join(found.join(least, "component"), "node", "left").select(F.col("node").alias("rep"), F.coalesce("least", "doc").alias("component"))
    out = signed.select("doc_id", "n", "rep").join(ids, "rep", "left")
    # an empty text takes its own id
    alone = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), alone.alias("component_id"))


def keep_one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents whose doc_id is the smallest of their component; rows without a doc_id stay.

    Rows that repeat a doc_id and its text are one document, of which the smallest row stays. Different texts under one
    doc_id are documents of their own, which give way to any other of their component. No rows give no rows. Defaults are
    those of a near-duplicate stage: five words, similarity 0.8.
    """
    columns, known = docs.columns, docs.where("doc_id is not null")
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    seen = known.groupBy("doc_id").agg(F.min(digest).alias("low"), F.max(digest).alias("high"), F.count("*").alias("rows"))
    # few if any: ids with several texts, and ids with several rows
    seen = write_scratch(seen.where("rows > 1").select(F.col("doc_id").alias("id"), (F.col("low") != F.col("high")).alias("mixed")), "jaccard-ids")
    apart = F.xxhash64("id", digest).bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    keyed = known.join(seen, F.col("doc_id") == F.col("id"), "left")
    keyed = keyed.select(F.struct(*columns).alias("row"), F.col("text").alias("text"), F.col("id").isNotNull().alias("again"),
                         F.when(F.col("mixed"), apart).otherwise(F.col("doc_id").cast("long")).alias("key"))
    gone = jaccard_components(keyed, "key", "text", k, percent).where("component_id < doc_id")
    kept = keyed.join(gone.select(F.col("doc_id").alias("key")).distinct(), "key", "left_anti")
    once = kept.where("not again").select("row")
    again = kept.where("again").groupBy("key").agg(F.min("row").alias("row")).select("row")
    return docs.where("doc_id is null").unionByName(once.union(again).select("row.*"))
