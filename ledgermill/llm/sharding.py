"""Documents to shards by a hierarchical weighted hash tree.

A tree has regions, racks in regions, and shards in racks. A node weighs what the shards under it weigh. A document starts
at the root and at each level makes one draw for each child, an exponential variable whose rate is the child's weight,
from a hash of its key and the child's name; the smallest draw wins. A node's share of the documents is its share of the
weight, and changing weights moves documents only into or out of the subtrees whose weights change.

Shards added later are grafts: a graft's own draw competes in its region, whose draw becomes the smaller of the two (the
minimum of two exponentials is the exponential of their summed rates). A document that the graft's draw wins over goes
straight down to the new shard, and no other document's draws change, so one more shard takes documents only into itself.
A document costs regions + racks of one region + shards of one rack + grafts draws, not one for each shard.

Slots number the rows of a shard from 0 without gaps, in seeded order: rows are counted by shard and slice of that order,
and each slice, of a bounded number of rows, is numbered from the sum of the counts before it.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermill.scratch import write_scratch

#: Rows of a shard that are numbered by one task at a time.
SLICE_ROWS = 1 << 16
#: Rows that are alike in all that is returned travel as one row with a count of at most this.
ALIKE_ROWS = 4096
_DIGITS = 13  # hexadecimal digits of a digest that make a draw


@dataclass(frozen=True)
class Shard:
    """A shard's place in the tree. ``rack`` names a rack of ``region``."""

    number: int
    region: int
    rack: int
    weight: float = 1.0


@dataclass(frozen=True)
class Tree:
    """Shards that the tree was built with, and those added since, oldest first."""

    built: tuple[Shard, ...]
    grafts: tuple[Shard, ...] = ()

    @classmethod
    def even(cls, regions: int = 5, racks: int = 2, shards: int = 4) -> Tree:
        """A tree of regions with as many racks each, and racks with as many shards each, all of weight 1."""
        return cls(tuple(Shard(n, n // (racks * shards), n // shards % racks) for n in range(regions * racks * shards)))

    def grown(self, weight: float = 1.0) -> Tree:
        """The tree with one more shard, in the rack that weighs least so far."""
        held: dict[tuple[int, int], float] = {}
        for s in (*self.built, *self.grafts):
            held[s.region, s.rack] = held.get((s.region, s.rack), 0.0) + s.weight
        region, rack = min(held, key=lambda place: (held[place], place))
        return replace(self, grafts=(*self.grafts, Shard(len(self.built) + len(self.grafts), region, rack, weight)))


def _named(*parts) -> Column:
    return F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(p) for p in parts])


def draw(key: Column, name: Column, weight: Column) -> Column:
    """An exponential variable of rate ``weight`` from a hash of the node's name and the document's key."""
    digits = F.conv(F.substring(F.md5(_named(name, key)), 1, _DIGITS), 16, 10).cast("long")
    return -F.ln((digits + 0.5) / float(16**_DIGITS)) / weight


def _weighed(shards, name) -> list[tuple]:
    """(name, weight) of the nodes that ``name`` groups shards into; nodes without weight are never drawn."""
    weights: dict = {}
    for s in shards:
        weights[name(s)] = weights.get(name(s), 0.0) + s.weight
    return sorted((node, w) for node, w in weights.items() if w > 0)


def _choices(nodes: list[tuple]) -> Column:
    one = [F.struct(F.lit(node).cast("int").alias("node"), F.lit(float(w)).alias("weight")) for node, w in nodes]
    return F.array(*one)


def _least(key: Column, prefix: Column, choices: Column) -> Column:
    """The (draw, node) with the smallest draw; equal draws go to the smaller node."""
    def drawn(c: Column) -> Column:
        return F.struct(draw(key, _named(prefix, c["node"].cast("string")), c["weight"]).alias("draw"), c["node"].alias("node"))

    return F.array_min(F.transform(choices, drawn))


def _by(nodes: dict, of: Column) -> Column:
    return F.element_at(F.create_map(*[x for k, v in nodes.items() for x in (F.lit(k), v)]), of)


def shard_of(rows: DataFrame, key: Column, tree: Tree) -> DataFrame:
    """``rows`` with ``shard`` (struct of region, rack and number) and ``grown`` (number of the shard in the tree with one
    more shard)."""
    regions = _choices(_weighed(tree.built, lambda s: s.region))
    racks = {g: _choices(_weighed([s for s in tree.built if s.region == g], lambda s: s.rack))
             for g in sorted({s.region for s in tree.built})}
    shards = {f"{g}|{r}": _choices(_weighed([s for s in tree.built if (s.region, s.rack) == (g, r)], lambda s: s.number))
              for g, r in sorted({(s.region, s.rack) for s in tree.built})}

    def graft(s: Shard) -> Column:
        at = F.struct(F.lit(s.region).alias("region"), F.lit(s.rack).alias("rack"), F.lit(s.number).alias("number"))
        return F.struct(draw(key, F.lit(f"graft|{s.number}"), F.lit(float(s.weight))).alias("draw"), at.alias("at"))

    rows = rows.withColumn("_region", _least(key, F.lit("region"), regions))
    region = F.col("_region.node")
    rows = rows.withColumn("_rack", _least(key, _named("rack", region.cast("string")), _by(racks, region))["node"])
    place = _named(region.cast("string"), F.col("_rack").cast("string"))
    down = _least(key, _named("shard", place), _by(shards, place))["node"]
    at = F.struct(region.alias("region"), F.col("_rack").alias("rack"), down.alias("number"))
    rows = rows.withColumn("_won", F.array_min(F.array(F.struct(F.col("_region.draw").alias("draw"), at.alias("at")),
                                                       *[graft(s) for s in tree.grafts])))
    extra = graft(tree.grown().grafts[-1])
    rows = rows.withColumn("grown", F.array_min(F.array(F.col("_won"), extra))["at"]["number"])
    return rows.withColumn("shard", F.col("_won.at")).drop("_region", "_rack", "_won")


def _slots(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` (with ``shard``, ``order`` and ``n`` rows alike) with ``first``, the slot of the first of each."""
    slices = (rows.count() // (SLICE_ROWS * shards) + 1) if shards else 1
    at = F.conv(F.substring("order", 1, 7), 16, 10).cast("long")
    rows = rows.withColumn("slice", F.floor(at * slices / float(16**7)))
    counts = rows.groupBy("shard", "slice").agg(F.sum("n").alias("held"))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "slice", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "slice").orderBy("order", *[c for c in rows.columns if c not in ("shard", "slice", "order", "n")])
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("sum", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return rows.join(counts, ["shard", "slice"]).withColumn("first", F.col("base") + F.col("sum")).drop("base", "sum", "slice", "order")


def place(docs: DataFrame, tree: Tree | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size (UTF-8 bytes of the text plus 16), text_crc32, law (``key``), region, rack,
    shard, slot and grown_shard.

    The key and the tree alone decide the shard. A null text has no bytes; rows with a null key are one key and share a
    shard; rows that repeat take one slot each. No rows give no rows. Other columns are not read.

    Rows that agree in key, size and checksum are alike in all that is returned; they are counted first and handed their
    slots in runs of at most ``ALIKE_ROWS``, so a key that holds a third of all rows is spread over many slices.
    """
    tree = tree or Tree.even()
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(key).alias("doc_id"), (F.octet_length(data) + 16).cast("long").alias("size"),
                       F.crc32(data).alias("text_crc32"))
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("all"))
    run = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("all") - 1) / ALIKE_ROWS)))
    rows = rows.withColumn("run", run)
    rows = rows.withColumn("n", F.least(F.lit(ALIKE_ROWS).cast("long"), F.col("all") - F.col("run") * ALIKE_ROWS)).drop("all")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    order = F.md5(_named("slot", name, *[F.col(c).cast("string") for c in ("size", "text_crc32", "run")]))
    rows = write_scratch(shard_of(rows, name, tree).withColumn("order", order), "shards")
    rows = _slots(rows, len(tree.built) + len(tree.grafts))
    rows = rows.withColumn("slot", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard.region").alias("region"),
                       F.col("shard.rack").alias("rack"), F.col("shard.number").alias("shard"), "slot",
                       F.col("grown").alias("grown_shard"))
