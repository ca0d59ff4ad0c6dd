"""Connected components of a link table, as a few joins and aggregates a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.scratch import write_scratch


def components(links: DataFrame, a: str, b: str, label: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of a link between two different nodes.

    Alternating large and small stars: each round every node hands its neighbours to the smallest one around it. Both
    steps are one pre-aggregated minimum and one join on the node; a node with many neighbours is only ever joined with
    its single minimum, so a hot node splits like any skewed join side. The number of rounds grows with the logarithm of
    the longest path. Each round is written to the shared scratch folder, which cuts the lineage.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = write_scratch(edges, label)
    state = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = write_scratch(small.select("e.u", "e.v").where("u <> v").distinct(), label)
        seen = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
                         F.countDistinct("u").alias("d")).first()
        if tuple(seen) == state or seen["n"] == 0:
            break
        state = tuple(seen)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
