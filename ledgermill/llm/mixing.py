"""Mix sources to target weights: Sainte-Laguë apportionment of equal-token blocks.

* A document's size is its number of words. Sources in code-point order (null last) weigh 1, 2, 3, repeating, and share all
  words by weight; no target exceeds ``most`` times its source's size, and what that leaves over is shared again by weight.
* Each source is cut into shards of about ``SHARD_WORDS`` words by a seeded hash of the document, so that a hot source
  becomes many shards. A shard's documents in seeded order, end to end, are cut into blocks of ``BLOCK_WORDS`` words.
* Blocks are the seats: a shard wants its share of the target, counted in blocks, and all seats are dealt by highest
  quotients want / (2 * seats + 1). Nearly all seats follow from one divisor that cannot overshoot; the rest, about one a
  shard, are ranked by quotient.
* A shard takes its quota as whole passes over its blocks plus an evenly spaced choice of the rest with a seeded start. The
  words of a document that fall into chosen blocks follow by arithmetic from its place in the shard.

DataFrame functions only. The documents are aggregated by shard before any exchange and sorted within shards of bounded
size; single-partition windows see one row per source or a few rows per shard, never documents. Driver: six sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermill.scratch import write_scratch

BLOCK_WORDS = 32
SHARD_WORDS = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"


def seeded(seed: str, *columns) -> Column:
    """A seeded hash as text (its order is the seeded order); nulls count as empty."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def number_of(digest: Column) -> Column:
    """The first seven hexadecimal digits of a digest as a number."""
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("long")


def source_targets(sized: DataFrame, most: int = 3) -> DataFrame:
    """(source, rank, weight, source_size, target), one row per source."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sources.withColumn("rank", F.row_number().over(order).cast("long"))
    sources = sources.withColumn("weight", (F.col("rank") - 1) % 3 + 1)
    # sources by the level at which they are full; those before the first level that the rest does not reach are full
    full = Window.orderBy(F.col("source_size") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    sums = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    total, weights = sums[0] or 0, sums[1] or 0
    level = (total - most * F.coalesce(F.sum("source_size").over(full), F.lit(0))) / (
        weights - F.coalesce(F.sum("weight").over(full), F.lit(0))
    )
    levels = sources.withColumn("level", level)
    stays = levels.where(most * F.col("source_size") / F.col("weight") >= F.col("level"))
    level = stays.agg(F.min(F.struct(F.col("source_size") / F.col("weight"), "rank", "level"))["level"]).first()[0]
    share = F.least((most * F.col("source_size")).cast("double"), F.col("weight") * F.lit(float(level or 0.0)))
    return sources.withColumn("target", share)


def quotas(shards: DataFrame) -> DataFrame:
    """Seats of each shard by highest quotients, given how many blocks each wants; ties go to the lower shard."""
    sums = shards.agg(F.sum("want").alias("all"), F.count("*").alias("n")).first()
    want, n = sums["all"] or 0.0, sums["n"]
    seats = int(want + 0.5)
    # rounding at the divisor want / (seats - n) gives at most `seats`, and at want / (seats + n) at least as many; with no
    # more seats than shards none is sure
    surely = max(seats - n, 0)
    sure = F.floor(F.col("want") * (surely / want if want else 0.0) + 0.5)
    shards = shards.withColumn("sure", sure.cast("long"))
    left = seats - (shards.agg(F.sum("sure")).first()[0] or 0)
    more = F.ceil(F.col("want") * ((seats + n - surely) / want if want else 0.0)) + 2
    open_seats = shards.select("rank", "shard", "want", "sure", F.explode(F.sequence(F.lit(0), more.cast("int"))).alias("s"))
    quotient = F.col("want") / (2 * (F.col("sure") + F.col("s")) + 1)
    place = F.row_number().over(Window.orderBy(F.col("quotient").desc(), "rank", "shard", "s"))
    ranked = open_seats.where("want > 0").withColumn("quotient", quotient).withColumn("place", place)
    won = ranked.where(F.col("place") <= left).groupBy("rank", "shard").agg(F.count("*").alias("won"))
    joined = shards.join(won, ["rank", "shard"], "left")
    return joined.withColumn("quota", F.col("sure") + F.coalesce("won", F.lit(0))).drop("sure", "won")


def _placed(docs: DataFrame, key: str, text: str, source: str, seed: str, most: int, keep: bool) -> DataFrame:
    """Each document with its place in its shard and what is chosen of it; with ``keep``, its row as a struct ``row``."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    base = [F.col(key).alias("doc_id"), F.col(source).alias("source"), size.alias("size")]
    sized = write_scratch(docs.select(*base), "mix-sizes")
    targets = source_targets(sized, most)
    targets = targets.withColumn("n_shards", F.floor(F.col("source_size") / SHARD_WORDS) + 1)
    by_source = write_scratch(targets.withColumnRenamed("source", "of"), "mix-targets")

    def in_shards(rows: DataFrame) -> DataFrame:
        rows = rows.join(by_source, F.col("source").eqNullSafe(F.col("of"))).drop("of")
        rows = rows.withColumn("order", seeded(seed, "doc_id"))
        return rows.withColumn("shard", number_of(F.col("order")) % F.col("n_shards"))

    shards = in_shards(sized).groupBy("rank", "shard", "source_size", "target").agg(F.sum("size").alias("shard_size"))
    shards = shards.where("shard_size > 0").withColumn("blocks", F.ceil(F.col("shard_size") / BLOCK_WORDS).cast("long"))
    # wanted words of the shard, in blocks of its own mean length
    shards = shards.withColumn("want", F.col("target") / F.col("source_size") * F.col("blocks"))
    dealt = quotas(write_scratch(shards.select("rank", "shard", "blocks", "want"), "mix-shards"))
    dealt = dealt.withColumn("quota", F.least("quota", most * F.col("blocks")))
    dealt = dealt.withColumn("passes", F.floor(F.col("quota") / F.col("blocks")))
    dealt = dealt.withColumn("rest", F.col("quota") % F.col("blocks"))
    dealt = dealt.withColumn("start", number_of(seeded(seed, "rank", "shard")) % F.col("blocks"))
    dealt = write_scratch(dealt.select("rank", "shard", "blocks", "passes", "rest", "start"), "mix-quotas")
    rows = docs.select(*base, F.struct("*").alias("row")) if keep else sized
    rows = in_shards(rows).join(dealt, ["rank", "shard"], "left")
    before = Window.partitionBy("rank", "shard").orderBy("order", "doc_id", "size")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("first", F.coalesce(F.sum("size").over(before), F.lit(0)))


def _words_chosen_before(at: Column) -> Column:
    """How many of a shard's first ``at`` words lie in the blocks chosen beyond its whole passes."""

    def chosen_before(block: Column) -> Column:
        return F.floor((block * F.col("rest") + F.col("start")) / F.col("blocks"))

    block = F.floor(at / BLOCK_WORDS)
    chosen = chosen_before(block + 1) - chosen_before(block)
    return chosen_before(block) * BLOCK_WORDS + chosen * (at - block * BLOCK_WORDS)


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix",
        most: int = 3) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target (its source's) and taken (words the mix takes).

    A null text has size 0; a null source is a source of its own, the last; a null doc_id is an ordinary value. Repeated
    rows are separate documents. ``taken`` never exceeds ``most`` times the size. Other columns are not read.
    """
    placed = _placed(docs, key, text, source, seed, most, keep=False)
    part = _words_chosen_before(F.col("first") + F.col("size")) - _words_chosen_before(F.col("first"))
    taken = F.coalesce(F.col("passes") * F.col("size") + part, F.lit(0)).cast("long")
    return placed.select("doc_id", "size", "source", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                    chars: str = "n_chars", seed: str = "mix", most: int = 3) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a document comes back once for each whole pass over its shard, and once
    more with the words that fall into further chosen blocks (joined by single spaces, where that isn't the whole text).

    Documents without words are in no block and stay as they are. ``chars`` is the length of the text that stays.
    """
    placed = _placed(docs, key, text, source, seed, most, keep=True)
    part = _words_chosen_before(F.col("first") + F.col("size")) - _words_chosen_before(F.col("first"))
    placed = placed.withColumn("part", F.coalesce(part, F.lit(0)))

    def is_chosen(_, i):
        at = F.col("first") + i
        return _words_chosen_before(at + 1) > _words_chosen_before(at)

    words = F.filter(F.regexp_extract_all(F.col(f"row.{text}"), F.lit(WORD), F.lit(0)), is_chosen)
    whole = (F.col("size") == 0) | (F.col("part") == F.col("size"))
    last = F.when(whole, F.col(f"row.{text}")).when(F.col("part") > 0, F.array_join(words, " "))
    passes = F.when(F.col("size") == 0, F.lit(0)).otherwise(F.coalesce("passes", F.lit(0)))
    copies = F.array_repeat(F.struct(F.col(f"row.{text}").alias("text")), passes.cast("int"))
    copies = F.concat(copies, F.when(whole | (F.col("part") > 0), F.array(F.struct(last.alias("text")))).otherwise(
        F.array().cast("array<struct<text:string>>")))
    out = placed.select("row", F.explode(copies).alias("copy"))
    columns = [F.col("copy.text").alias(c) if c == text else F.length("copy.text").cast("long").alias(c) if c == chars
               else F.col("row").getField(c).alias(c) for c in docs.columns]
    return out.select(*columns)
