"""The registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import (byte_bpe, centroids, chaining, filter_audit, jaccard_join, main_text, mixing, nn_descent, quality,
                            sharding, suffix_dedup, topk_search, toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with its oracle SQL where it has one."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def _read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


@query()
def op1_toxicity(spark, d):
    return toxicity.score(_read(spark, d, "documents"), _read(spark, d, "labels"))


@query("""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 64)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""")
def op2_topk_search(spark, d):
    return topk_search.top_k(_read(spark, d, "embeddings"))


def public_ranks() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query()
def op3_byte_bpe(spark, d):
    return byte_bpe.digests(_read(spark, d, "documents"), *public_ranks())


@query(r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
by_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM by_source),
weighed AS (SELECT *, (rank - 1) % 3 + 1 AS weight FROM ranked),
levels AS (
    SELECT *, ((sum(source_size) OVER ())::BIGINT - 3 * coalesce(sum(source_size) OVER full_ones, 0)::BIGINT)::DOUBLE
        / ((sum(weight) OVER ())::BIGINT - coalesce(sum(weight) OVER full_ones, 0)::BIGINT)::DOUBLE AS level
    FROM weighed
    WINDOW full_ones AS (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stop AS (SELECT level FROM levels WHERE 3 * source_size / weight >= level ORDER BY source_size / weight, rank LIMIT 1),
sources AS (
    SELECT source, rank, source_size, least((3 * source_size)::DOUBLE, weight * coalesce((SELECT level FROM stop), 0)) AS target,
        source_size // 1048576 + 1 AS n_shards FROM weighed),
placed AS (
    SELECT z.doc_id, z.source, z.size, s.rank, s.source_size, s.target,
        md5('mix|' || coalesce(z.doc_id::VARCHAR, '')) AS ordering,
        ('0x' || substr(ordering, 1, 7))::BIGINT % s.n_shards AS shard
    FROM sized z JOIN sources s ON z.source IS NOT DISTINCT FROM s.source),
shards AS (
    SELECT rank, shard, sum(size)::BIGINT AS shard_size, ((sum(size)::BIGINT + 31) // 32) AS blocks,
        any_value(target) / any_value(source_size) * ((sum(size)::BIGINT + 31) // 32) AS want
    FROM placed GROUP BY rank, shard HAVING sum(size) > 0),
seats AS (SELECT floor(sum(want) + 0.5)::BIGINT AS seats FROM shards),
quotients AS (
    SELECT rank, shard, want / (2 * s.i + 1) AS quotient, s.i
    FROM shards, LATERAL (SELECT unnest(range(0, floor(want)::BIGINT + 3)) AS i) s),
dealt AS (
    SELECT *, row_number() OVER (ORDER BY quotient DESC, rank, shard, i) AS place FROM quotients),
won AS (
    SELECT rank, shard, count(*) AS quota FROM dealt WHERE place <= (SELECT seats FROM seats) GROUP BY rank, shard),
quota AS (
    SELECT s.rank, s.shard, s.blocks, least(coalesce(w.quota, 0), 3 * s.blocks) AS q,
        ('0x' || substr(md5('mix|' || s.rank || '|' || s.shard), 1, 7))::BIGINT % s.blocks AS start
    FROM shards s LEFT JOIN won w USING (rank, shard)),
spread AS (
    SELECT p.*, k.blocks, k.q // k.blocks AS passes, k.q % k.blocks AS rest, k.start,
        coalesce(sum(p.size) OVER (PARTITION BY p.rank, p.shard ORDER BY p.ordering, p.doc_id, p.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a, (a + p.size)::BIGINT AS b
    FROM placed p LEFT JOIN quota k USING (rank, shard)),
counted AS (
    SELECT *,
        ((a // 32) * rest + start) // blocks AS ca, ((a // 32 + 1) * rest + start) // blocks AS ca2,
        ((b // 32) * rest + start) // blocks AS cb, ((b // 32 + 1) * rest + start) // blocks AS cb2
    FROM spread)
SELECT doc_id, size, source, source_size, target, coalesce(passes * size
    + (cb * 32 + (cb2 - cb) * (b % 32)) - (ca * 32 + (ca2 - ca) * (a % 32)), 0)::BIGINT AS taken
FROM counted
""")
def op6_source_mix(spark, d):
    return mixing.mix(_read(spark, d, "documents"))


@query()
def op4_quality(spark, d):
    return quality.score(_read(spark, d, "documents"), _read(spark, d, "labels"))


@query()
def op5_passage_chaining(spark, d):
    return chaining.repeated_passages(_read(spark, d, "documents"))


@query()
def op7_nn_descent(spark, d):
    return nn_descent.near_duplicates(_read(spark, d, "embeddings"))


@query()
def op8_main_text(spark, d):
    return main_text.extract(_read(spark, d, "pages"))


@query()
def op9_jaccard_join(spark, d):
    return jaccard_join.jaccard_components(_read(spark, d, "documents"))


@query()
def op10_suffix_dedup(spark, d):
    return suffix_dedup.remove_repeats(_read(spark, d, "documents"))


#: A draw in SQL: an exponential variable of the given rate from a hash of node and key, as in ``sharding.draw``.
_DRAW = """-ln((('0x' || substr(md5({name} || '|' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5) / 4503599627370496) / {weight}"""


@query(f"""
WITH steps AS (
    SELECT list(list_reduce(range(8), lambda a, _: xor(a >> 1, (a & 1) * 3988292384), i) ORDER BY i) AS t FROM range(256) r(i)),
sized AS (
    SELECT doc_id, (strlen(coalesce(text, '')) + 16)::BIGINT AS size,
        xor(list_reduce(
            list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT),
            lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1]), 4294967295), 4294967295)::BIGINT AS text_crc32
    FROM documents, steps),
runs AS (
    SELECT *, (row_number() OVER (PARTITION BY doc_id, size, text_crc32) - 1) // 4096 AS run FROM sized),
keys AS (SELECT DISTINCT doc_id FROM documents),
region_draws AS (
    SELECT doc_id, g AS region, {_DRAW.format(name="'region|' || g", weight="8.0")} AS draw FROM keys, range(5) r(g)),
regions AS (SELECT doc_id, arg_min(region, draw) AS region, min(draw) AS won FROM region_draws GROUP BY doc_id),
rack_draws AS (
    SELECT *, k AS rack, {_DRAW.format(name="'rack|' || region || '|' || k", weight="4.0")} AS draw FROM regions, range(2) r(k)),
racks AS (SELECT doc_id, region, won, arg_min(rack, draw) AS rack FROM rack_draws GROUP BY ALL),
shard_draws AS (
    SELECT *, region * 8 + rack * 4 + i AS shard,
        {_DRAW.format(name="'shard|' || region || '|' || rack || '|' || (region * 8 + rack * 4 + i)", weight="1.0")} AS draw
    FROM racks, range(4) r(i)),
placed AS (
    SELECT doc_id, won, arg_min(shard, draw)::INTEGER AS shard, {_DRAW.format(name="'graft|40'", weight="1.0")} AS graft
    FROM shard_draws GROUP BY doc_id, won)
SELECT r.doc_id, r.size, r.text_crc32, 'key' AS law, p.shard,
    row_number() OVER (PARTITION BY p.shard ORDER BY md5('slot|' || coalesce(r.doc_id::VARCHAR, '') || '|' || size || '|'
        || text_crc32 || '|' || run), r.doc_id, size, text_crc32, run) - 1 AS slot,
    CASE WHEN graft < won THEN 40 ELSE p.shard END AS grown_shard
FROM runs r JOIN placed p ON r.doc_id IS NOT DISTINCT FROM p.doc_id
""")
def op11_hash_tree(spark, d):
    return sharding.place(_read(spark, d, "documents")).drop("region", "rack")


@query(r"""
WITH seen AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
fails AS (
    SELECT doc_id, part,
        CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
        || CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS failed
    FROM seen),
said AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
masks AS (
    SELECT part, failed, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
    FROM fails LEFT JOIN said USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
    SELECT filter_order, s::INTEGER AS step, substr(filter_order, s, 1) AS f, substr(filter_order, 1, s - 1) AS before
    FROM orders, range(1, 6) r(s)),
outcomes AS (
    SELECT part, filter_order, step, f, n, good, toxic, failed = f AS only_this, contains(failed, f) AS hit,
        len(list_filter(string_split(failed, ''), lambda x: x <> '' AND contains(before, x))) > 0 AS gone FROM masks, steps),
counts AS (
    SELECT part, filter_order, step, f,
        coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (only_this), 0)::BIGINT AS unique_fails,
        coalesce(sum(n) FILTER (hit AND NOT gone AND good), 0)::BIGINT AS good_lost,
        coalesce(sum(n) FILTER (hit AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
    FROM outcomes GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counts
""")
def op12_filter_audit(spark, d):
    return filter_audit.audit(_read(spark, d, "documents"), _read(spark, d, "labels"))


def _lloyd(rounds: int) -> str:
    """Rounds of assignment and update, written out one after the other; cluster and distance come from the least of
    16 * distance + cluster."""
    nearest = """a{n} AS MATERIALIZED (
    SELECT i, vec_id, any_value(v.v) AS v, min(list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 16 + c) AS least
    FROM v, c{n} c GROUP BY i, vec_id),
"""
    update = """s{n} AS (
    SELECT least % 16 AS c, unnest(range(64)) AS pos, unnest(v) AS x FROM a{n}),
f{n} AS (
    SELECT c, pos, sum(x)::BIGINT AS s, count(*) AS n, ((s - ((s % n) + n) % n) // n)::BIGINT AS x FROM s{n} GROUP BY c, pos),
c{m} AS MATERIALIZED (
    SELECT c, coalesce(g.v, o.v) AS v
    FROM c{n} o LEFT JOIN (SELECT c, list(x ORDER BY pos) AS v FROM f{n} GROUP BY c) g USING (c)),
"""
    return "".join((nearest + update).format(n=n, m=n + 1) for n in range(rounds)) + nearest.format(n=rounds)


@query(f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 64)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST) - 1 AS c, v FROM v
    ORDER BY sha256('1:' || vec_id) NULLS LAST LIMIT 16),
{_lloyd(3)}
digests AS (SELECT c, sha256(array_to_string(v, ',')) AS centroid_sha256 FROM c3)
SELECT vec_id, (least % 16)::INTEGER AS cluster, least // 16 AS distance,
    (sum(least // 16) OVER (PARTITION BY least % 16))::BIGINT AS cluster_inertia, (sum(least // 16) OVER ())::BIGINT AS inertia,
    centroid_sha256
FROM a3 JOIN digests ON c = least % 16
""")
def op13_centroids(spark, d):
    return centroids.cluster(_read(spark, d, "embeddings"))
