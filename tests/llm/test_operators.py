"""The corpus operators against brute force, on small tables with nulls, empty and long texts, ties, repeats and columns
whose names clash with the operators' own."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermill.llm import (byte_bpe, chaining, jaccard_join, main_text, mixing, nn_descent, quality, suffix_dedup, topk_search,
                            toxicity)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, unit long, row string, component string, "
          "n long, size long, rank long, hash string")


def _texts():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéü") for _ in range(rng.randint(2, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    base = prose(160)
    words = base.split()
    near = words[:]
    near[40] = near[90] = "changed"
    passage = prose(70)
    return [base, " ".join(near), base, prose(30) + " " + passage + "\n" + prose(20), passage + " " + prose(40), "", None,
            "one two", "One TWO", "\x00 odd\x1f   text", prose(3000), "a b c d", "x" * 3000, " \n\t ", prose(55)]


@pytest.fixture(scope="module")
def texts():
    return list(enumerate(_texts())) + [(None, "no key " * 30), (7, "one two")]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en" if k % 3 else None, [None, "a", "b", "ü"][k % 4], None if t is None else len(t), 1, "r", "c", 2, 3, 4, "h")
            for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def _sets(texts, k):
    out = []
    for i, t in texts:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append((i, frozenset(tuple(w[a : a + k]) for a in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])))
    return out


def test_jaccard_components(docs, none, texts):
    sets = [(i, s) for i, s in _sets(texts, 4)]
    ids = sorted({i for i, _ in sets if i is not None})
    up = {i: i for i in ids}

    def root(x):
        return x if up[x] == x else root(up[x])

    for i, a in sets:
        for j, b in sets:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    want = sorted(((i, len(s), root(i) if i is not None else None) for i, s in sets), key=repr)
    got = sorted((tuple(r) for r in jaccard_join.jaccard_components(docs).collect()), key=repr)
    assert got == want
    assert jaccard_join.jaccard_components(none).count() == 0


def test_light_sets_link_like_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for i in range(120):
        words = [f"w{rng.randint(0, 5)}" for _ in range(1)] + [f"s{j}" for j in range(rng.randint(4, 18))]
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = _sets(rows, 4)
    up = list(range(len(rows)))

    def root(x):
        return x if up[x] == x else root(up[x])

    for i, a in sets:
        for j, b in sets:
            if 100 * len(a & b) >= 85 * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == {i: root(i) for i, _ in sets}


def test_keep_one_of_each(docs):
    kept = [r["doc_id"] for r in jaccard_join.keep_one_of_each(docs).select("doc_id").collect()]
    assert 0 in kept and 1 not in kept and 2 not in kept and None in kept
    assert kept.count(7) == 1 and 8 not in kept


def test_suffix_dedup(docs, none, texts):
    rows = [(i, (t or "").encode()) for i, t in texts]
    low = {}
    for i, x in rows:
        if i is not None:
            for p in range(len(x) - 49):
                low[x[p : p + 50]] = min(i, low.get(x[p : p + 50], i))
    want = []
    for i, x in rows:
        gone = bytearray(len(x))
        if i is not None:
            for p in range(len(x) - 49):
                if low[x[p : p + 50]] < i:
                    gone[p : p + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(x, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        want.append((i, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in suffix_dedup.remove_repeats(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert any(r[2] for r in got)
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_passages(docs, none, texts):
    found = {(r["doc_id"], r["source_id"]): r for r in chaining.repeated_passages(docs).collect()}
    assert set(found) == {(1, 0), (2, 0), (4, 3)}
    assert found[1, 0]["n_words"] == 160 and found[1, 0]["equal_words"] == 158
    assert found[4, 3]["first_word"] == 0 and found[4, 3]["n_words"] == 70 and found[4, 3]["source_first_word"] == 30
    cut = {r["doc_id"]: r for r in chaining.cut_passages(docs).where("doc_id <> 7").collect()}
    before = dict(texts)
    assert cut[1]["text"] == "" and cut[1]["n_chars"] == 0 and cut[4]["text"] == " ".join(before[4].split()[70:])
    assert all(cut[i]["text"] == before[i] for i in (0, 3, 5, 6, 9, 10, 12, 14))
    assert chaining.cut_passages(docs).columns == docs.columns and chaining.cut_passages(docs).count() == len(texts)
    assert chaining.cut_passages(none).count() == 0


def test_copies_of_passages_whose_phrases_all_occur_earlier(spark):
    rng = random.Random(7)
    word = iter(f"w{i}" for i in range(100_000))
    passage = [f"p{i}" for i in range(60)]
    # each phrase of up to nine words of the passage is in an earlier text of its own
    rows = [(i, " ".join([next(word) for _ in range(30)] + passage[i : i + 9] + [next(word) for _ in range(30)])) for i in range(52)]
    for i in (900, 901, 950):
        rows.append((i, " ".join([next(word) for _ in range(rng.randint(20, 40))] + passage + [next(word) for _ in range(25)])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: (r["source_id"], r["n_words"], r["equal_words"]) for r in chaining.repeated_passages(df).collect()}
    assert found == {901: (900, 60, 60), 950: (900, 60, 60)}
    cut = {r["doc_id"]: r["text"] for r in chaining.cut_passages(df).collect()}
    for i, text in rows:
        assert cut[i].split() == [w for w in text.split() if i in (901, 950) and w[0] != "p" or i not in (901, 950)]


@pytest.mark.parametrize("every", [11, 14])
def test_altered_copies_of_passages_whose_phrases_all_occur_earlier(spark, every):
    rng = random.Random(8)
    word = iter(f"w{i}" for i in range(100_000))
    passage = [f"p{i}" for i in range(120)]
    rows = [(i, " ".join([next(word) for _ in range(30)] + passage[i : i + 9] + [next(word) for _ in range(30)])) for i in range(112)]
    for i in (900, 901, 950):
        mine = [next(word) if i > 900 and j % every == every // 2 else w for j, w in enumerate(passage)]
        rows.append((i, " ".join([next(word) for _ in range(rng.randint(20, 40))] + mine + [next(word) for _ in range(25)])))
    # two texts under one doc_id, the later of which has the passage
    rows += [(800, "a b c"), (800, " ".join([next(word) for _ in range(30)] + [f"q{i}" for i in range(80)])),
             (801, " ".join(f"q{i}" for i in range(80)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = [tuple(r) for r in chaining.repeated_passages(df).collect()]
    assert len(found) == len(set(found)) and {r[0] for r in found} == {801, 901, 950}
    assert {(r[0], r[1]) for r in found} >= {(801, 800), (901, 900), (950, 900)}
    for doc in (901, 950):
        reach = [r for r in found if r[:2] == (doc, 900)]
        # a stretch of fewer words than k + WINDOW - 1 at an end need not have a seed
        assert min(r[4] for r in reach) <= dict(rows)[900].split().index("p0") + 7
        assert sum(r[6] for r in reach) >= 120 - 120 // every - 14
    cut = {r["doc_id"]: r["text"].split() for r in chaining.cut_passages(df).where("doc_id > 800").collect()}
    assert cut[801] == [] and sum(w[0] == "p" for w in cut[900]) == 120
    assert all(sum(w[0] == "p" for w in cut[i]) < 15 for i in (901, 950))


def test_open_ends_of_copies_meet_no_text_that_first_occurrences_explain(spark, monkeypatch):
    rng = random.Random(11)
    word = iter(f"w{i}" for i in range(100_000))
    base = [f"p{i}" for i in range(160)]
    rows = [(0, " ".join(base))]
    for i in range(1, 41):  # from word 100 on, three of ten words differ in each copy
        rows.append((i, " ".join(next(word) if j >= 100 and j % 10 < 3 else w for j, w in enumerate(base))))
    rows += [(50 + i, " ".join(f"r{i} a b c d e f g h".split() * rng.randint(20, 30))) for i in range(3)]
    met, write = {}, chaining.write_step

    def count(df, label):
        out = write(df, label)
        met[label] = out.count()
        return out

    monkeypatch.setattr(chaining, "write_step", count)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = chaining.repeated_passages(df).where("doc_id < 50").collect()
    assert {r["doc_id"] for r in found if r["source_id"] == 0 and r["first_word"] == 0 and r["n_words"] >= 100} == set(range(1, 41))
    assert met["passages-more"] < 600  # 780 pairs of copies


def test_ends_of_blocks_are_pieces_that_a_chain_can_do_without():
    place, source, words = chaining._pieces(np.array([0, 30]), np.array([5, 37]), np.array([20, 7]), 5)
    assert place.tolist() == [0, 5, 15, 30] and source.tolist() == [5, 10, 20, 37] and words.tolist() == [5, 10, 5, 7]


def test_passages_are_found_in_steps_that_leave_no_shuffle_files(docs, spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = manager.getAllFiles()
        return {found.apply(i).getName() for i in range(found.size())}

    before = {n for n in files() if n.startswith("shuffle_")}
    found = chaining.repeated_passages(docs)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert 1 <= plan.count("FlatMapCoGroupsInArrow") <= 4 and plan.count("Exchange") <= 20
    assert not {n for n in files() if n.startswith("shuffle_") and n.endswith(".data")} - before
    assert found.count() == 3


def test_ends_of_chains_reach_as_far_as_words_agree():
    rng = np.random.default_rng(4)
    for n in (0, 1, 31, 32, 33, 500):
        a, b = rng.integers(0, 9, n + 3), rng.integers(0, 9, n + 5)
        b[:n] = a[:n]
        b[n] = a[n] + 1
        assert chaining._agree(a, b) == n and chaining._agree(a[:n], b) == n
    mine, theirs = np.array([7, 1, 2, 3, 4, 5, 8]), np.array([9, 1, 2, 3, 4, 5, 6])
    assert chaining.align(mine, theirs, 10, np.array([[3], [13], [1]])) == (1, 5, 11, 5, 5)


def _unit(texts, ids=None):
    import pyarrow as pa

    return pa.table({"doc_id": pa.array(ids or range(len(texts)), pa.int64()), "text": pa.array(texts), "unit": pa.array([3] * len(texts), pa.int64())})


def test_replies_hash_only_the_words_that_are_asked_for(monkeypatch):
    import pyarrow as pa

    from ledgermill.llm.text import Words

    texts = [" ".join(f"w{i}x{j}" for j in range(300)) for i in range(20)]
    whole = chaining.Unit(_unit(texts)).texts.words()
    hashes, want = whole.hashes().astype("<u4"), []
    ask = [(40, 4, 10, 30), (41, 4, 20, 60), (40, 9, 290, 400), (42, 19, 0, 7), (43, 99, 0, 7)]
    for asker, source, low, high in ask[:4]:
        a, b = whole.first[source], whole.first[source + 1]
        want.append((asker, source, low, hashes[a + low : min(a + high, b)].tobytes()))
    hashed, run = [], Words.hashes
    monkeypatch.setattr(Words, "hashes", lambda self, *a: hashed.append(run(self, *a)) or hashed[-1])
    asked = pa.table(dict(zip(chaining.schema_of(chaining._ASKED).names, map(list, zip(*ask)))))
    got = chaining._reply(None, _unit(texts), asked)
    assert list(zip(*got.to_pydict().values())) == want
    assert sum(map(len, hashed)) == 50 + 10 + 7  # of 6,000


def test_seeds_are_the_smallest_of_their_windows():
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(n)) for n in (0, 3, 5, 6, 7, 8, 9, 400, 1, 6, 120)] + ["a " * 90]
    for k in (1, 2, 5):
        unit = chaining.Unit(_unit(texts))
        seeds = chaining.Seeds(unit, k)
        want = []
        for row, (a, b) in enumerate(zip(seeds.words.first[:-1], seeds.words.first[1:])):
            grams = chaining.sequence_hashes(seeds.word_hashes[a:b], k).tolist()
            picked = {min(range(w, min(w + chaining.WINDOW, len(grams))), key=lambda i: (grams[i] >> 24, i))
                      for w in range(max(len(grams) - chaining.WINDOW, 0) + 1) if grams}
            want += [(row, i, grams[i]) for i in sorted(picked)]
        assert list(zip(seeds.row.tolist(), seeds.place.tolist(), seeds.hash.tolist())) == want
        assert seeds.order.tolist() == np.argsort(seeds.hash, kind="stable").tolist()
    same = np.array([5 << 40, 4, 5 << 40, 3, 2, 4], np.uint64)  # differ in low bits only
    assert chaining._ordered(same)[0].tolist() == np.argsort(same, kind="stable").tolist()


def test_orders_of_wide_and_narrow_columns_agree():
    rng = np.random.default_rng(6)
    for wide in (0, 1 << 61):
        columns = [rng.integers(-4, 4, 300), rng.integers(0, 3, 300) * wide - 7, rng.integers(0, 5, 300)]
        assert chaining._order_of(*columns).tolist() == np.lexsort(columns[::-1]).tolist()
        assert [tuple(r) for r in np.stack(chaining._distinct_rows(*columns), axis=1).tolist()] == sorted(set(zip(*(c.tolist() for c in columns))))
    assert [len(c) for c in chaining._distinct_rows(*np.empty((2, 0), np.int64))] == [0, 0]


def test_packed_rows_may_take_several_arrays(monkeypatch):
    values, size = np.arange(20, dtype="<u4"), np.array([3, 0, 9, 1, 7])
    want = [values[b - n : b].tobytes() for b, n in zip(np.cumsum(size), size)]
    assert chaining._in_rows(values, size).to_pylist() == want and chaining._in_rows(values[:0], size[:0]).to_pylist() == []
    monkeypatch.setattr(chaining, "_MOST_BYTES", 40)
    assert chaining._in_rows(values, size).to_pylist() == want and chaining._in_rows(values, size).num_chunks > 1


def test_gaps_are_aligned_together():
    rng = np.random.default_rng(8)
    mine, theirs = rng.integers(0, 4, 90), rng.integers(0, 4, 90)
    a, b, n, m = rng.integers(0, 70, 60), rng.integers(0, 70, 60), rng.integers(-3, 17, 60), rng.integers(-3, 17, 60)

    def longest(x, y):
        best = [0] * (len(y) + 1)
        for u in x:
            row = [0]
            for j, v in enumerate(y):
                row.append(max(row[-1], best[j + 1], best[j] + (u == v)))
            best = row
        return best[-1]

    got = chaining._equal_words(mine, theirs, a, n, b, m)
    assert got.tolist() == [longest(mine[i : i + max(p, 0)].tolist(), theirs[j : j + max(q, 0)].tolist()) for i, p, j, q in zip(a, n, b, m)]


def test_chains_that_count_are_sent_in_few_rows(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(9)
    found = rng.integers(0, 1 << 31, (1000, 7))
    found[:, 3] = rng.integers(-(1 << 62), 1 << 62, 1000)
    for most, rows in ((1 << 16, 1), (300, 4)):
        monkeypatch.setattr(chaining, "_PACK", most)
        out = {"unit": [], "counted": []}
        chaining._add_counted(out, 5, found)
        assert out["unit"] == [5] * rows
        table = pa.table({"counted": pa.chunked_array([pa.array([None, *out["counted"], None], pa.binary())])})
        assert chaining._read_counted(table["counted"]).tolist() == found.tolist()


@pytest.mark.parametrize("least", [50, 90])
def test_passages_are_runs_of_chains_that_touch(least):
    import pyarrow as pa

    rng, chains = random.Random(2), []
    for _ in range(300):
        a = rng.randrange(900)
        chains.append((rng.randrange(6), a, a + rng.randint(20, 60), rng.randint(-9, 1 << 50), 7, 47, 25))
    want = []
    for row in range(6):
        runs = []
        for c in sorted(c for c in chains if c[0] == row):
            if runs and c[1] <= max(x[2] for x in runs[-1]):
                runs[-1].append(c)
            else:
                runs.append([c])
        want += [r for r in runs if max(c[2] for c in r) - r[0][1] >= least]
    out = {"unit": [], "counted": []}
    chaining._add_counted(out, 3, np.array(chains))
    right = pa.table(out).append_column("high", pa.nulls(1, pa.int64())).append_column("words", pa.nulls(1, pa.binary()))
    runs, held = chaining._passages(chaining.Unit(_unit(["a b"])), right, 5, least, 80)
    assert runs.tolist() == [[r[0][0], r[0][1], max(c[2] for c in r)] for r in want]
    assert sorted(map(tuple, held.tolist())) == sorted(c for r in want for c in r)


def test_buckets_hold_more_of_a_large_input(spark, monkeypatch):
    from ledgermill.llm import units

    monkeypatch.setattr(units, "UNIT_BYTES", 1 << 10)
    monkeypatch.setattr(units, "BUCKET_BYTES", 1 << 11)
    monkeypatch.setattr(units, "GROW_FROM", 1 << 13)
    passage = " ".join(f"p{i}" for i in range(80))
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(60)) + (" " + passage if i % 9 == 2 else "")) for i in range(200)]
    total = sum(len(t) for _, t in rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    (_, n, bits), (_, most, most_bits) = (units.unit_frame(df, "doc_id", "text", grow=g) for g in (True, False))
    assert most == total // (1 << 10) + 1 and most_bits == (total // (1 << 11)).bit_length()
    assert n == most and bits <= most_bits - 3  # units stay, as the ends of chains depend on them
    found = {tuple(r) for r in chaining.repeated_passages(df).select("doc_id", "source_id", "n_words").collect()}
    assert found == {(i, 2, 80) for i in range(11, 200, 9)}


def test_texts_without_a_seed_have_no_passages(spark):
    df = spark.createDataFrame([(1, "a b"), (2, ""), (None, "a b c d e f g h i j k l"), (3, None)], "doc_id long, text string")
    assert chaining.repeated_passages(df).count() == 0
    assert sorted(map(tuple, chaining.cut_passages(df).collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


def test_chain_prefers_collinear_blocks():
    chains = chaining.chains_of([0, 12, 30], [100, 112, 5], [10, 10, 10])
    assert chains[0] == [0, 1] and [2] in chains


def _ranks():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_bpe_matches_tiktoken_and_round_trips(docs, none, texts):
    import tiktoken

    path, pattern = _ranks()
    other = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    encoded = byte_bpe.encode(docs, path, pattern)
    want = sorted((i, tuple(other.encode_ordinary(t or ""))) for i, t in texts if i is not None)
    assert sorted((r["doc_id"], tuple(r["ids"])) for r in encoded.where("doc_id is not null").collect()) == want
    back = byte_bpe.decode(encoded, path, pattern).where("doc_id is not null").collect()
    assert sorted((r["doc_id"], r["text"]) for r in back) == sorted((i, t or "") for i, t in texts if i is not None)
    digests = {r["doc_id"]: r for r in byte_bpe.digests(docs, path, pattern).collect()}
    ids = np.array(dict(want)[10], "<u4").tobytes()
    assert digests[10]["ids_sha256"] == hashlib.sha256(ids).hexdigest()
    assert digests[10]["decoded_sha256"] == hashlib.sha256(dict(texts)[10].encode()).hexdigest()
    assert byte_bpe.digests(none, path, pattern).count() == 0


def test_bpe_pieces_of_odd_texts():
    import tiktoken

    path, pattern = _ranks()
    bpe = byte_bpe.ByteBpe(path, pattern)
    other = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    rng = random.Random(1)
    odd = ["".join(rng.choice(rng.choice([" \n\t'sab1", "éüß漢😀", "  \r\n\x0b\x85 \x00\x1c"])) for _ in range(rng.randrange(60)))
           for _ in range(1500)] + ["<|endoftext|> it's", " lead", "tail ", "\n\nx"]
    assert [x.tolist() for x in bpe.encode(odd)] == [other.encode_ordinary(t) for t in odd]


def test_mix_meets_targets(docs, none, texts):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(texts)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    by = defaultdict(lambda: [0, 0.0, 0])
    for r in rows:
        by[r["source"]][0] += r["taken"]
        by[r["source"]][1], by[r["source"]][2] = r["target"], r["source_size"]
    assert all(abs(taken - target) <= 2 * mixing.BLOCK_WORDS and target <= 3 * size for taken, target, size in by.values())
    assert sum(t for _, t, _ in by.values()) == pytest.approx(sum(s for *_, s in by.values()))
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mixing.mix(docs).collect()), key=repr)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = sum(len(WORD.findall(r["text"] or "")) for r in mixed.select("text").collect())
    assert words == sum(r["taken"] for r in rows)
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, node long, rank int"


def _vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(12, 8))
    rows = [(i, [float(x) for x in base[i % 12] + rng.normal(size=8) * 0.03], i % 2, 0, 0) for i in range(150)]
    rows += [(200 + i, rows[3][1], 1, 0, 0) for i in range(30)]  # copies
    rows += [(300, None, 1, 0, 0), (301, [None] * 8, 1, 0, 0), (302, [float("nan")] * 8, 1, 0, 0), (303, [0.0] * 8, 1, 0, 0),
             (304, [1.0, 2.0], 1, 0, 0), (305, rows[3][1], None, 0, 0), (None, rows[3][1], 1, 0, 0)]
    return rows, spark.createDataFrame(rows, VECTORS).repartition(3)


def test_topk(spark):
    rows, df = _vectors(spark)
    fine = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int)) for i, v, *_ in rows
            if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    want = []
    for q, v in fine:
        if q % 20 == 0:
            scored = sorted((-int(v @ w), c) for c, w in fine if c != q and len(v) == len(w))[:20]
            want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(scored)]
    assert sorted(tuple(r) for r in topk_search.top_k(df).collect()) == sorted(want)
    assert topk_search.top_k(df.where("false")).count() == 0


def test_near_duplicate_vectors(spark):
    rows, df = _vectors(spark)
    fine = {i: (l, np.array(v, np.float32).astype(float)) for i, v, l, *_ in rows
            if i is not None and l is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)}
    up = {i: i for i, *_ in rows if i is not None}
    links = dict.fromkeys(up, 0)

    def root(x):
        return x if up[x] == x else root(up[x])

    for i, (l, v) in fine.items():
        for j, (m, w) in fine.items():
            if i < j and l == m and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98:
                links[i], links[j] = links[i] + 1, links[j] + 1
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in nn_descent.near_duplicates(df).collect()}
    got.pop(None, None)
    assert got == {i: (links[i], root(i), root(i) == i) for i in up}
    assert nn_descent.near_duplicates(df.where("false")).count() == 0


def test_chains_of_links_stay_connected(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "BLOCK", 4)  # groups over several blocks
    rng = random.Random(3)
    rows, want = [], {}
    for chain, ids in enumerate([[1, 3, 4, 2], rng.sample(range(10, 40), 30)]):
        for i, at in enumerate(ids):
            angle = np.radians(11 * i)
            rows.append((at, f"l{chain}", [float(np.cos(angle)), float(np.sin(angle))]))
            want[at] = (min(ids), at == min(ids))
    df = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    got = {r["vec_id"]: (r["component_id"], r["kept"]) for r in nn_descent.near_duplicates(df).collect()}
    assert got == want


@pytest.mark.parametrize("lost", ["node >= 1000", "true"])
def test_pairs_that_the_descent_misses_are_found(spark, monkeypatch, lost):
    graph = nn_descent._graph
    monkeypatch.setattr(nn_descent, "_graph", lambda *a: graph(*a).where(f"not ({lost})"))
    monkeypatch.setattr(nn_descent, "ATTEMPTS", 1)
    rng = np.random.default_rng(8)
    base = rng.normal(size=(11, 16))
    rows = [(i, base[0] + rng.normal(size=16) * 0.01) for i in range(120)]
    rows += [(1000 + i, base[1 + i // 2] + rng.normal(size=16) * 0.01) for i in range(20)]
    df = spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in nn_descent.near_duplicates(df).collect()}
    assert got == {i: (119, 0) if i < 1000 else (1, i - i % 2) for i, _ in rows}


def test_main_text(spark):
    page = ("<html><head><title>T</title></head><body><nav><a href=x>Home</a></nav><article><h1>Head</h1><p>One &amp; two<br>"
            "three<p>Short.</p></article><div class='comments'><p>" + "nice " * 30 + "</p></div><footer>&copy; x</footer></body></html>")
    rows = [(1, "u", page, "k"), (2, None, None, "k"), (None, "v", "", "k"), (4, "w", "<p>" + "word " * 4000, "k"), (1, "u", page, "k")]
    got = main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert [r["text"] for r in got if r["page_id"] == 1] == ["Head\nOne & two three\nShort."] * 2
    assert {r["page_id"]: r["n_chars"] for r in got} == {1: 27, 2: 0, None: 0, 4: 19999}


@pytest.mark.parametrize("wrapper", ["<form id=form1>%s</form>", "<form><article>%s</article></form>", "<div class=sidebar><main>%s</main></div>",
                                     "<div class='content has-sidebar'>%s</div>", "<div id='main' class='with-search'>%s</div>",
                                     "<div class='post has-comments'>%s</div>"])
def test_main_text_inside_wrappers(wrapper):
    prose = "".join(f"<p>{'plain words of prose without links ' * 5}</p>" for _ in range(4))
    page = ("<body><nav><a href=x>Home</a></nav><form class=search>Search this site</form>" + wrapper % prose
            + "<div class=comments><p>" + "nice " * 30 + "</p></div><form>Your name and your mail</form></body>")
    got = main_text.main_text(page, main_text.trained_tree())
    assert got == "\n".join([("plain words of prose without links " * 5).strip()] * 4)


@pytest.mark.parametrize("operator,label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifiers_on_held_out_rows(spark, operator, label):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = operator.score(docs, labels).join(labels, "doc_id").where("held_out").select("score", label).collect()
    good = sum((r["score"] >= 0.5) == (r[label] == 1) for r in rows)
    assert len(rows) > 50 and good / len(rows) >= 0.9


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_classifiers_on_odd_rows(docs, none, texts, operator):
    labels = docs.select("doc_id", F.lit(None).cast("int").alias("toxic"), F.lit(2).alias("quality"))
    rows = operator.score(docs, labels).collect()
    assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 for r in rows)
    assert operator.score(none, labels).count() == 0


def test_quality_learns_from_every_unlabelled_document(spark):
    rng = random.Random(9)
    order = [r["id"] for r in spark.range(7500).orderBy(F.xxhash64("id"), "id").collect()]

    def text(good):
        return " ".join(rng.choice(["reading", "mountain", "river", "paper"]) if good else rng.choice(["{", "|", "9", "!!"])
                        for _ in range(20))

    unlabelled = set(order) - set(range(600))
    late = set([i for i in order if i in unlabelled][-600:])  # one source, all bad, beyond the first 6000 by hash
    rows = [(i, text(i % 2 and i not in late), "late" if i in late else "web", "en" if i % 2 or rng.random() < 0.3 else "de", 100)
            for i in order]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, quality int")
    scores = {r["doc_id"]: r["metadata_score"] for r in quality.score(docs, labels).collect()}
    english = {i for i, _, _, lang, _ in rows if lang == "en"}
    assert np.mean([scores[i] for i in late & english]) < np.mean([scores[i] for i in english - late]) - 0.1


def test_inserted_characters_stay_close():
    toxic = [["you", "idiot", f"word{i}"] for i in range(60)]
    other = [["plain", "thing", f"noun{i}"] for i in range(60)]
    model = toxicity.train(toxic, other)
    plain, gapped, clean = model.decisions(["idiot", "idxiot", "plain"])
    assert plain > gapped > clean
    assert "idiot" in toxicity.words_of("you i d i o t now") and toxicity.clean("i-d-i-o-t") == "idiot"


def test_keep_one_loses_no_text(spark):
    rng = random.Random(8)

    def prose():
        return " ".join(f"w{rng.randint(0, 900)}" for _ in range(60))

    a, b, c = prose(), prose(), prose()
    rows = [(0, a, "en"), (1, a + " more", "en"), (1, b, "en"), (2, c, "en"), (2, c, "de"), (2, c, "de"), (None, a, "en"), (None, a, "en"), (5, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted((tuple(r) for r in jaccard_join.keep_one_of_each(docs).collect()), key=repr)
    assert got == sorted([(0, a, "en"), (1, b, "en"), (2, c, "de"), (None, a, "en"), (None, a, "en"), (5, None, None)], key=repr)
    assert jaccard_join.keep_one_of_each(docs.where("false")).count() == 0


def test_short_texts_with_a_common_line_link_like_brute_force(spark):
    rng = random.Random(12)
    line = " ".join(f"common{i}" for i in range(14))
    rows = []
    for i in range(260):
        if i % 4 == 0 or not rows:
            own = [f"u{rng.randint(0, 5000)}" for _ in range(rng.randint(6, 26))]
            at = rng.randint(0, len(own))
            words = [*own[:at], *line.split(), *own[at:]]
        else:
            words = rng.choice(rows)[1].split()
            for _ in range(rng.randint(1, 3)):
                edit = rng.choice(["first", "last", "grow", "any"])
                at = {"first": 0, "last": len(words) - 1, "grow": len(words)}.get(edit, rng.randrange(len(words)))
                words[at : at + 1] = [f"v{rng.randint(0, 5000)}"]
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = _sets(rows, 4)
    up = list(range(len(rows)))

    def root(x):
        return x if up[x] == x else root(up[x])

    for i, a in sets:
        for j, b in sets:
            if 100 * len(a & b) >= 85 * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == {i: root(i) for i, _ in sets} and len(set(got.values())) < 250


def test_near_copies_too_far_apart_to_link_never_become_pairs(spark, monkeypatch):
    base = [f"b{i}" for i in range(120)]
    rows = [(i, " ".join([*base[: 7 * i + 4], *[f"e{i}x{j}" for j in range(3)], *base[7 * i + 7 :]])) for i in range(16)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = dict(_sets(rows, 4))
    assert max(100 * len(a & b) / len(a | b) for i, a in sets.items() for j, b in sets.items() if i < j) < 85
    seen, promising = [], jaccard_join._promising

    def counted(pairs, kept, percent):
        seen.append(pairs.count())
        return promising(pairs, kept, percent)

    monkeypatch.setattr(jaccard_join, "_promising", counted)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == {i: i for i in sets} and seen[-1] <= len(rows)  # all 120 of them met before


def test_sets_that_share_many_lists_meet_once(spark, monkeypatch):
    base = [f"b{i}" for i in range(120)]
    rows = [(i, " ".join([*base[: 7 * i + 4], *[f"e{i}x{j}" for j in range(3)], *base[7 * i + 7 :]])) for i in range(16)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    distinct, seen = type(docs).distinct, []

    def counted(frame):
        if frame.columns == ["x", "y", "cx", "cy"]:
            seen.append((frame.count(), distinct(frame).count()))
        return distinct(frame)

    monkeypatch.setattr(type(docs), "distinct", counted)
    monkeypatch.setattr(jaccard_join.F, "bit_count", lambda c: jaccard_join.F.lit(0))  # parity bits part none
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == {i: i for i in range(16)} and seen[-1][0] == seen[-1][1] > len(rows)


def test_sketches_differ_no_more_than_sets():
    rng = np.random.default_rng(3)
    for n in (6, 40, 300, 3000):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.union1d(a[n // 5 :], rng.integers(0, 1 << 63, n // 6, dtype=np.uint64))
        bits = sum(int(x).bit_count() for x in (jaccard_join.sketch_of(a) ^ jaccard_join.sketch_of(b)).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b)) and jaccard_join.sketch_of(a).tolist() == jaccard_join.sketch_of(a[::-1]).tolist()


def test_what_workers_forget_goes_back_to_the_system():
    def held():
        return int(open("/proc/self/statm").read().split()[1]) * 4096

    words = [bytes(3000) for _ in range(100_000)]
    del words[:-1]  # the last one keeps the rest from going by itself
    before = held()
    toxicity.forget()
    assert before - held() > 200_000_000


def test_workers_forget_words_and_pieces():
    class Shared:
        value = toxicity.Model(np.zeros(toxicity._CODES), 0.0, 1.0, -5.0)

    assert len(toxicity._scorer(Shared())(["some text", "", "more"])) == 3 and toxicity._known
    toxicity.forget()
    assert not toxicity._known
    bpe = byte_bpe.ByteBpe(*_ranks())
    ids = bpe.encode(["some text", "some more"])
    assert bpe._known
    bpe.forget()
    assert not bpe._known and all((a == b).all() for a, b in zip(ids, bpe.encode(["some text", "some more"])))


def test_top_k_of_repeated_ids_and_of_very_long_vectors(spark):
    rows = [(20, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.9, 0.0]), (2, [1e9, 1.0]), (3, [1e300, 0.0]), (40, [0.0, 1.0]), (40, [0.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk_search.top_k(frame).collect()}
    assert got[20, 1] == (1, 64 * 57) and got[20, 2] == (1, 64 * 32)
    assert {v for v, _ in got.values()} <= {1, 20, 40} and got[40, 1][1] == 0
    assert len([1 for q, _ in got if q == 40]) == 3


@pytest.mark.parametrize("n", [3, 400])
def test_many_sources_of_less_than_a_block(spark, n):
    docs = spark.createDataFrame([(i, "one two three", f"s{i:04d}") for i in range(n)], "doc_id long, text string, source string")
    rows = mixing.mix(docs).collect()
    assert len(rows) == n and all(0 <= r["taken"] <= 9 for r in rows)
    assert abs(sum(r["taken"] for r in rows) - 3 * n) <= 3 * n
    plan = mixing.quotas(spark.range(2000).selectExpr("id as rank", "0 as shard", "1 as blocks", "0.1D + id % 3 as want"))
    assert plan.agg(F.sum("quota")).first()[0] == int(sum(0.1 + i % 3 for i in range(2000)) + 0.5)
