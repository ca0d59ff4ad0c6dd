"""Random inputs against small plain-Python models of what must come out."""

import random
from collections import Counter

import pytest

from ledgermill.operators import combine, filings, joins, merge

KEYS = [None, 1, 2, 3, 4, 5]


def random_rows(rng, n, keys):
    return [(rng.choice(KEYS) if keys else i, rng.choice([None, "x", "y"]), rng.choice("abc")) for i in range(n)]


def expected(old, new, mode):
    old_keys, new_keys = {r[:2] for r in old}, {r[:2] for r in new}
    if mode == "overwrite":
        return Counter(new)
    if mode == "append":
        return Counter(old) + Counter(new)
    if mode == "incremental":
        return Counter(old) + Counter(r for r in new if r[:2] not in old_keys)
    return Counter(r for r in old if r[:2] not in new_keys) + Counter(new)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("mode", merge.WRITE_MODES)
def test_merges(spark, mode, seed):
    rng = random.Random(seed)
    schema = "k int, j string, v string"
    old, new = random_rows(rng, 12, True), random_rows(rng, 8, True)
    if mode == "upsert":
        new = list({r[:2]: r for r in new}.values())
    out = merge.merge(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), ["k", "j"], mode)
    assert Counter(tuple(r) for r in out.collect()) == expected(old, new, mode)


@pytest.mark.parametrize("seed", range(3))
def test_newest_row(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(KEYS), rng.randrange(4), rng.choice("abcd")) for _ in range(40)]
    best = {}
    for r in rows:
        best[r[0]] = max(best.get(r[0], r), r, key=lambda r: r[1:])
    out = combine.newest_per_key(spark.createDataFrame(rows, "k int, at int, v string"), ["k"], ["at"])
    assert {r["k"]: tuple(r) for r in out.collect()} == best


@pytest.mark.parametrize("seed", range(3))
def test_gaps(spark, seed):
    rng = random.Random(seed)
    codes, axis = [1, 2, 3, 4], [10, 20, 30]
    landed = [(rng.choice([1, 2, 3, 9]), rng.choice([10, 20, 99, None])) for _ in range(8)]
    got = joins.coverage_gaps(
        spark.createDataFrame([(c,) for c in codes], "code int"),
        spark.createDataFrame([(a,) for a in axis], "v int"),
        spark.createDataFrame(landed, "code int, v int"),
        "code",
        "v",
    )
    assert {tuple(r) for r in got.collect()} == {(c, a) for c in codes for a in axis} - set(landed)


TAGS = {"S1": {"t1": "a", "t2": "a", "t3": "b"}, "S2": {"t1": "b", "t4": "c"}}
VALUE_TAGS = ["t1", "t2", "t3", "t4", "t5"]
CONTEXTS = ["CurrentYearDuration", "X_CurrentYearInstant", "Prior1YearDuration", "CurrentYearInstant_NonConsolidatedMember"]


def random_facts(rng):
    facts = []
    for d in range(40):
        path, index = f"d{d}", 0
        entries = []
        for tag in filings.DOCUMENT_TAGS:
            if rng.random() < 0.97:
                some = ["S1", "S2", "S1", "S3"] if tag == "AccountingStandardsDEI" else ["7", "8"]
                values = [None if rng.random() < 0.03 else rng.choice(some) for _ in range(rng.choice([1, 1, 2]))]
                entries += [(tag, v, "F", None) for v in values]
        entries += [
            (rng.choice(VALUE_TAGS), rng.choice(["1", "2", "bad", None, "1e1"]), rng.choice(CONTEXTS), rng.choice([None, "l"]))
            for _ in range(rng.randrange(8))
        ]
        rng.shuffle(entries)
        for tag, value, context, label in entries:
            facts.append((path, index, tag, value, context, None, label))
            index += 1
    return facts


def wide_model(facts):
    out = {}
    for path in {f[0] for f in facts}:
        mine = sorted((f for f in facts if f[0] == path), key=lambda f: f[1])
        meta = {f[2]: f[3] for f in mine if f[2] in filings.DOCUMENT_TAGS}
        tags = TAGS.get(meta.get("AccountingStandardsDEI"), {})
        if len(meta) < 5 or None in meta.values():
            continue
        seen = {
            (tags[t], label if label is not None else t, context, value)
            for _, _, t, value, context, _, label in mine
            if t in tags and context.endswith(tuple(filings.CURRENT_YEAR_CONTEXTS))
        }
        values = {a: [float(v) for b, _, _, v in seen if b == a and v not in (None, "bad")] for a in "abc"}
        if any(values.values()):
            row = [meta[t] for t in filings.DOCUMENT_TAGS]
            out[path] = (*row, *[sum(v) / len(v) if v else None for v in values.values()], path)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_filings(spark, seed):
    facts = random_facts(random.Random(seed))
    schema = "source_path string, fact_index bigint, local_name string, value string, context_id string, unit_id string, label string"
    out = filings.normalise_filing_facts(spark.createDataFrame(facts, schema).repartition(5), TAGS)
    got = {r["source_path"]: tuple(r) for r in out.collect()}
    want = wide_model(facts)
    assert got.keys() == want.keys() and len(got) > 2
    for path in got:
        assert got[path] == pytest.approx(want[path])
