"""Fuzzy substring dedup: repeated passages found by collinear chaining of shared word k-mers.

1. Seeds: of every ``WINDOW`` consecutive k-mers of words the one with the smallest hash, so that any ``k + WINDOW - 1``
   equal words share one. Units of documents send their distinct seed hashes to buckets, which answer which of them occur
   in more than one unit or document; for those the unit then sends the smallest document and place it has, and is told
   the smallest of all. So every later occurrence of a seed is matched with its first one: matches grow with the seeds,
   not with pairs, and a seed shared by a third of all documents is sent once a unit. Where the seeds are phrases that many
   texts use, their first occurrences lie scattered and say nothing of a later copy. So every run of ``LONG`` words whose
   seeds are all repeated is a seed too, matched with its own first occurrence: each word of a stretch of ``LONG`` or more
   words that an earlier document holds is then in a match long enough to count.
2. Matches of a document with one source are joined into blocks along diagonals and chained: a block follows the best one
   that ends before it in both texts, its score less a cost for each skipped word, kept in a Fenwick tree over source
   places. Chains are cut at gaps of more than ``GAP`` words.
3. The words of the sources' stretches are sent to the units that ask for them (one stretch for each unit and source), and
   every chain is aligned: blocks as they are, gaps by edit distance, ends extended while words are equal. Chains of at
   least ``SHORTEST`` words with ``percent`` of words equal count.
4. What else of a document has seeds close enough to be part of a passage is open: its first occurrences may have been the
   wrong partners. Two of them that follow one another in a chain with their first occurrences, or that have these as close
   together in one document, are explained: any other document with both has no more seeds there than that one, so only that
   one is tried (again). For the others every earlier document that holds both is found: units learn which of their seeds
   are asked for, send each two that lie close enough to follow one another in a chain, one row for each text, with hashes of
   the words between them, and one join gives the earlier documents that share both but not the words between. Without such
   two a chain is one run of equal words, which step 1 finds by itself if it is long enough to count. Nothing is capped;
   documents without open seeds have no part in it. The words round such seeds are sent, and all runs of k words that both
   texts have there are chained and aligned like the others.
5. A run of at least ``least`` words covered by counted chains is a repeated passage. Its parts may have different sources.

What a step finds is written, and the exchanges it needed are removed before the next one deals the texts to units again; the
passes over the units within a step read one exchange. Memory: a unit, or the hashes of a bucket.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.suffix_dedup import _MARKS, _answer_anchors, _sliding_min, _tail
from ledgermill.llm.text import _power_tables, bytes_of, mix, sequence_hashes
from ledgermill.llm.units import Unit, arrays, bucket_ranges, joined, schema_of, unit_frame, unit_of
from ledgermill.scratch import write_step

WINDOW = 4
#: Longest gap inside a chain, shortest chain that counts (words), and the cost of a skipped word.
GAP, SHORTEST, GAP_COST = 16, 20, 0.5
#: Fewest matches with one source that can make a chain that counts: words equal around a single one are under ``SHORTEST``.
FEWEST = 2
#: Words of a long seed: as many as make a chain that counts.
LONG = SHORTEST
#: Repeated seeds at most so many words from an open one are matched with all their occurrences, too.
NEAR = 2 * SHORTEST
_U = np.uint64
_MOST_BYTES = 0x7FFFFFFF


def _word_sums(word_hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, down): ``(sums[b] - sums[a]) * down[a]`` is a hash of the words from a to b."""
    n = len(word_hashes)
    up, down = _power_tables(n + 1)
    with np.errstate(over="ignore"):
        return np.concatenate(([_U(0)], np.cumsum(word_hashes * up[:n], dtype=_U))), down


def _spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places from ``begin`` on, ``size`` of them, of one after the other."""
    return np.arange(int(size.sum())) + np.repeat(begin - np.cumsum(size) + size, size)


def _ordered(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of hashes, and the hashes in it: their upper bits with their places below are sorted as values, which is
    several times faster, and is the order unless different hashes agree in the upper bits."""
    low = _U((1 << len(hashes).bit_length()) - 1)
    key = (hashes & ~low) | np.arange(len(hashes), dtype=_U)
    key.sort()
    order = (key & low).view(np.int64)
    ordered = hashes.take(order)
    if (ordered[1:] < ordered[:-1]).any():
        order = np.argsort(hashes, kind="stable")
        ordered = hashes.take(order)
    return order, ordered


def _packed(*columns: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]] | None:
    """Columns, the first counts most, as one number a row, and each one's (bits, smallest value); None if it takes over 64."""
    if not len(columns[0]):
        return np.empty(0, _U), [(0, 0)] * len(columns)
    least = [int(x.min()) for x in columns]
    bits = [(int(x.max()) - a).bit_length() for x, a in zip(columns, least)]
    if sum(bits) > 64:
        return None
    key = np.zeros(len(columns[0]), _U)
    for x, n, a in zip(columns, bits, least):
        if n:
            key <<= _U(n % 64)  # 64 bits are one column alone, after zeros
            key |= (x - a).view(_U)
    return key, list(zip(bits, least))


def _unpacked(key: np.ndarray, how: list[tuple[int, int]]) -> list[np.ndarray]:
    out = []
    for n, a in reversed(how):
        out.append((key & _U((1 << n) - 1)).view(np.int64) + a)
        key = key >> _U(n) if n < 64 else np.zeros_like(key)
    return out[::-1]


def _order_of(*columns: np.ndarray) -> np.ndarray:
    """The order of rows by these columns, the first counts most."""
    packed = _packed(*columns, np.arange(len(columns[0])))
    if packed is None:
        return np.lexsort(columns[::-1])
    key, how = packed
    key.sort()
    return (key & _U((1 << how[-1][0]) - 1)).view(np.int64)


def _distinct_rows(*columns: np.ndarray) -> list[np.ndarray]:
    """Distinct rows of these columns, by them."""
    packed = _packed(*columns)
    if packed is not None:
        key, how = packed
        key.sort()
        return _unpacked(key[np.r_[True, key[1:] != key[:-1]][: len(key)]], how)
    by = np.lexsort(columns[::-1])
    columns = [x[by] for x in columns]
    new = np.logical_or.reduce([np.r_[True, x[1:] != x[:-1]] for x in columns])
    return [x[new] for x in columns]


def _in_rows(values: np.ndarray, size: np.ndarray) -> pa.Array | pa.ChunkedArray:
    """Values that lie end to end as a binary for each row, of ``size`` values."""
    offsets = np.concatenate(([0], np.cumsum(size))) * values.itemsize
    if offsets[-1] > _MOST_BYTES and len(size) > 1:  # more than an array can hold
        half = len(size) // 2
        at = int(offsets[half]) // values.itemsize
        parts = [_in_rows(values[:at], size[:half]), _in_rows(values[at:], size[half:])]
        return pa.chunked_array([y for x in parts for y in (x.chunks if isinstance(x, pa.ChunkedArray) else [x])])
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(values)])


class Kinds:
    """Seeds (hash, word place within the text, row) by hash: distinct hashes, each with its smallest document and place.

    Places of sources count from the first text of a doc_id: several texts under one doc_id are one source, end to end.
    """

    def __init__(self, unit: Unit, hashes: np.ndarray, place: np.ndarray, first: np.ndarray):
        """``place``: ascending, within the unit."""
        self.hash = hashes
        self.row = np.repeat(np.arange(len(first) - 1), np.diff(np.searchsorted(place, first)))
        self.place = place - first[self.row]
        self.source_place = place - first[unit.first_text].take(self.row)
        self.order, ordered = _ordered(self.hash)  # seeds come by document and source place
        new = np.r_[True, ordered[1:] != ordered[:-1]] if len(ordered) else np.empty(0, bool)
        self.first = np.flatnonzero(new)
        docs = unit.doc.take(self.row.take(self.order))
        self.kinds = ordered[self.first]
        self.low_doc, self.low_place = docs[self.first], self.source_place.take(self.order.take(self.first))
        last = np.append(self.first[1:], len(ordered))[: len(self.first)] - 1
        self.many = self.low_doc != docs[last]
        self.size = np.diff(np.append(self.first, len(self.order)))


class Seeds(Kinds):
    """Seeds of ``k`` words of a unit, and the unit's words."""

    def __init__(self, unit: Unit, k: int):
        self.words = unit.texts.words()
        self.word_hashes = self.words.hashes()
        first = self.words.first
        grams = sequence_hashes(self.word_hashes, k)
        n = np.diff(first) - k + 1
        rows = np.flatnonzero((n > 0) & unit.known)
        n, a = n[rows], first[:-1][rows]
        # the leftmost smallest of each window; a document shorter than a window has one
        count = np.maximum(n - WINDOW, 0) + 1
        windows = _spread(a, count)
        low = _U(0xFFFFFF)
        at = np.arange(len(grams), dtype=_U)
        if len(grams) > int(low):
            at -= np.repeat(first[:-1], np.diff(first))[: len(grams)].astype(_U)
        at &= low
        key = (grams & ~low) | at
        lowest = np.empty(len(windows), _U)
        whole = np.repeat(n >= WINDOW, count)
        lowest[whole] = _sliding_min(key, WINDOW).take(windows[whole]) if whole.any() else 0
        short = np.flatnonzero(n < WINDOW)
        smallest = key.take(a[short])
        for i in range(1, WINDOW - 1):
            longer = n[short] > i
            smallest[longer] = np.minimum(smallest[longer], key.take(a[short[longer]] + i))
        lowest[~whole] = smallest
        lowest -= at.take(windows)
        lowest &= low
        self.lowest = windows + lowest.view(np.int64)
        at = self.lowest[np.r_[True, self.lowest[1:] != self.lowest[:-1]][: len(windows)]]  # ascending, as windows are
        self.unit, self.k, self.windows = unit, k, windows
        super().__init__(unit, grams.take(at), at, first)

    def long(self, repeated: np.ndarray) -> Kinds:
        """The runs of ``LONG`` words all of whose windows have a repeated seed; ``repeated`` tells for each distinct one."""
        first = self.words.first
        found = self.order[np.repeat(repeated, self.size)]
        known = np.zeros(int(first[-1]) + 1, bool)
        known[self.place[found] + first[self.row[found]]] = True
        good = np.zeros(len(known), np.int64)
        good[self.windows[known[self.lowest]]] = 1
        inside = LONG - self.k - WINDOW + 2  # windows that lie within a run, so that its copies have the same seeds
        total = np.concatenate(([0], np.cumsum(good)))
        place = np.flatnonzero(total[inside:] - total[:-inside] == inside) if len(total) > inside else np.empty(0, np.int64)
        place = place[place + LONG <= first[np.searchsorted(first, place, "right").clip(max=len(first) - 1)]]
        sums, down = _word_sums(self.word_hashes)
        with np.errstate(over="ignore"):
            hashes = mix((sums[place + LONG] - sums[place]) * down[place])
        return Kinds(self.unit, hashes, place, first)


def _send_hashes(k: int, bits: int):
    def run(table: pa.Table) -> pa.Table:
        unit = Unit(table)
        seeds = Seeds(unit, k)
        out = {"unit": [], "bucket": [], "hashes": [], "many": []}
        for bucket, a, b in bucket_ranges(seeds.kinds, bits):
            out["unit"].append(unit.number)
            out["bucket"].append(bucket)
            out["hashes"].append(_pack(seeds.kinds[a:b], bits))
            out["many"].append(np.packbits(seeds.many[a:b]).tobytes())
        return pa.table(out, schema_of(_MARKS))

    return run


def _repeated(seeds: Seeds, answers: pa.Table, bits: int):
    """(long seeds, [(bucket, the distinct seeds in it that were answered to be repeated, the long seeds in it)])."""
    told = dict(zip(answers["bucket"].to_pylist(), answers["many"]))
    repeated = np.zeros(len(seeds.kinds), bool)
    short = {}
    for bucket, a, b in bucket_ranges(seeds.kinds, bits):
        if bucket in told:
            repeated[a:b] = np.unpackbits(np.frombuffer(told[bucket].as_buffer(), np.uint8), count=b - a)
            short[bucket] = a + np.flatnonzero(repeated[a:b])
    runs = seeds.long(repeated)
    long = {bucket: np.arange(a, b) for bucket, a, b in bucket_ranges(runs.kinds, bits)}
    nothing = np.empty(0, np.int64)
    return runs, [(x, short.get(x, nothing), long.get(x, nothing)) for x in sorted(short.keys() | long.keys())]


_PLACES = "unit long, bucket int, hashes binary, docs binary, places binary"


def _send_places(k: int, bits: int):
    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        out = {n: [] for n in schema_of(_PLACES).names}
        if len(left) and len(right):
            unit = Unit(left)
            seeds = Seeds(unit, k)
            runs, wanted = _repeated(seeds, right, bits)
            for bucket, *picks in wanted:
                if sum(map(len, picks)):
                    both = list(zip((seeds, runs), picks))
                    out["unit"].append(unit.number)
                    out["bucket"].append(bucket)
                    out["hashes"].append(b"".join(_tail(x.kinds[pick], bits).astype("<u8").tobytes() for x, pick in both))
                    out["docs"].append(b"".join(x.low_doc[pick].astype("<i8").tobytes() for x, pick in both))
                    out["places"].append(b"".join(x.low_place[pick].astype("<u4").tobytes() for x, pick in both))
        return pa.table(out, schema_of(_PLACES))

    return run


_SOURCES = "unit long, bucket int, docs binary, places binary, many binary"


def _answer_places(table: pa.Table) -> pa.Table:
    """Per unit and bucket, for each repeated seed: the smallest document and place that has it."""
    table = table.combine_chunks()
    lists = arrays(table["hashes"], "<u8")
    hashes, docs = joined(lists, "<u8"), joined(arrays(table["docs"], "<i8"), "<i8")
    places = joined(arrays(table["places"], "<u4"), "<u4")
    order = _order_of(hashes.astype(np.int64))
    new = np.r_[True, hashes[order][1:] != hashes[order][:-1]]
    first, of = np.flatnonzero(new), np.cumsum(new) - 1
    kind = np.empty(len(order), np.int64)
    kind[order] = of
    docs, places = docs[order], places[order]
    low_doc = np.minimum.reduceat(docs, first)
    places = np.minimum.reduceat(np.where(docs == low_doc[of], places, np.iinfo(np.uint32).max), first).astype("<u4")
    docs, places = low_doc[kind], places[kind]
    ends = np.cumsum([len(x) for x in lists])
    cut = [(int(e) - len(x), int(e)) for e, x in zip(ends, lists)]
    return pa.table(
        [table["unit"], table["bucket"], pa.array([docs[a:b].tobytes() for a, b in cut], pa.binary()),
         pa.array([places[a:b].tobytes() for a, b in cut], pa.binary())], ["unit", "bucket", "docs", "places"])


def blocks_of(place: np.ndarray, source: np.ndarray, k: int, group: np.ndarray | None = None):
    """Matches of k words joined along diagonals where they touch, in each group: (place, source place, words, group) of each
    block, by group and place, and the order of the matches and block of each in it."""
    group = np.zeros(len(place), np.int64) if group is None else group
    diagonal = source - place
    order = _order_of(group, diagonal, place)
    place, source, diagonal, group = place[order], source[order], diagonal[order], group[order]
    apart = np.r_[True, (np.diff(diagonal) != 0) | (np.diff(place) > k) | (np.diff(group) != 0)][: len(order)]
    first = np.flatnonzero(apart)
    last = np.append(first[1:], len(place))[: len(first)] - 1
    by = _order_of(group[first], place[first], source[first])
    number = np.empty(len(by), np.int64)
    number[by] = np.arange(len(by))
    first, last = first[by], last[by]
    return place[first], source[first], place[last] - place[first] + k, group[first], order, number[np.cumsum(apart) - 1]


def chains_of(place: list[int], source: list[int], words: list[int]) -> list[list[int]]:
    """Collinear chains of blocks (indices in order), best first; a block is in one chain at most."""
    n = len(place)
    if n == 1:
        return [[0]]
    ends = sorted({s + w for s, w in zip(source, words)})
    # a Fenwick tree of prefix maxima over source places, and which block has each
    size = len(ends) + 1
    best, best_at = [-1e18] * size, [-1] * size
    score, before = [0.0] * n, [-1] * n
    closing = sorted(range(n), key=lambda i: place[i] + words[i])
    done = 0
    for i in range(n):
        here = place[i]
        while done < n and place[j := closing[done]] + words[j] <= here:
            source_end = source[j] + words[j]
            # a skipped word costs in either text, so the cost of a gap is the difference of two sums
            value = score[j] + GAP_COST * (place[j] + words[j] + source_end)
            at = bisect_left(ends, source_end) + 1
            while at < size:
                if value > best[at]:
                    best[at], best_at[at] = value, j
                at += at & -at
            done += 1
        value, j = -1e18, -1
        at = bisect_left(ends, source[i] + 1)
        while at > 0:
            if best[at] > value:
                value, j = best[at], best_at[at]
            at -= at & -at
        gain = value - GAP_COST * (here + source[i])
        score[i] = words[i] + max(0.0, gain)
        before[i] = j if gain > 0 else -1
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        if chain:
            chain.reverse()
            part = [chain[0]]
            for a, b in zip(chain, chain[1:]):
                if max(place[b] - place[a] - words[a], source[b] - source[a] - words[a]) > GAP:
                    out.append(part)
                    part = []
                part.append(b)
            out.append(part)
    return out


def _chains_in_groups(place: np.ndarray, source: np.ndarray, words: np.ndarray, group: np.ndarray):
    """Chains of the blocks of each group, which come by group: (the blocks of the chains end to end, blocks of each chain)."""
    cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True]).tolist() if len(group) else []
    of, size = [], []
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b - a == 1:
            of.append(a)
            size.append(1)
        else:
            for chain in chains_of(place[a:b].tolist(), source[a:b].tolist(), words[a:b].tolist()):
                of.extend([a + i for i in chain])
                size.append(len(chain))
    return np.array(of, np.int64), np.array(size, np.int64)


def _pieces(place: np.ndarray, source: np.ndarray, words: np.ndarray, k: int, *group: np.ndarray):
    """Blocks with k words at each end apart, by group and place: where two blocks overlap, a chain can do without such an end."""
    head = np.where(words >= 2 * k, k, words)
    tail = np.where(words >= 3 * k, k, 0)
    cut = np.stack([np.zeros_like(words), head, words - tail, words])
    start, size = cut[:-1].ravel(), np.diff(cut, axis=0).ravel()
    place, source, group = np.tile(place, 3) + start, np.tile(source, 3) + start, [np.tile(x, 3) for x in group]
    by = np.lexsort((source, place, *group))
    by = by[size[by] > 0]
    return place[by], source[by], size[by], *(x[by] for x in group)


def _union(start: np.ndarray, end: np.ndarray):
    """(starts, ends) of the runs that intervals make, touching ones joined."""
    by = np.argsort(start, kind="stable")
    start, end = start[by], np.maximum.accumulate(end[by]) if len(by) else end
    new = np.r_[True, start[1:] > end[:-1]] if len(by) else np.empty(0, bool)
    return start[new], end[np.r_[new[1:], True]] if len(by) else end


def _inside(start: np.ndarray, end: np.ndarray, runs) -> np.ndarray:
    """Which intervals lie in one of these apart runs."""
    at = np.searchsorted(runs[0], start, "right") - 1
    return (at >= 0) & (end <= np.append(runs[1], -1)[at]) if len(runs[0]) else np.zeros(len(start), bool)


def _open(row: np.ndarray, place: np.ndarray, first: np.ndarray, k: int, sure: list[tuple[int, int, int]], least: int) -> np.ndarray:
    """Which of these seeds (by row and place; earlier documents have each) every earlier document must be asked about.

    A chain has at least ``FEWEST`` such seeds, each at most k + GAP words after the one before, and reaches less than
    k + WINDOW words beyond them. Stretches that could be covered so, with those that ``sure`` chains (row, first word, last
    word + 1) cover, make passages from ``least`` words on. Their seeds outside of sure chains are open, and those within
    ``NEAR`` words of an open one are asked about, too.
    """
    if not len(row):
        return np.empty(0, bool)
    new = np.r_[True, (row[1:] != row[:-1]) | (np.diff(place) > k + GAP)]
    group = np.cumsum(new) - 1
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(row)) - 1
    many = tails - heads + 1 >= FEWEST
    shift = first[:-1] + 2 * NEAR * np.arange(len(first) - 1)  # texts apart, so that their runs stay apart
    words = np.diff(first)
    a = shift[row[heads]] + np.maximum(place[heads] - k - WINDOW, 0)
    b = shift[row[heads]] + np.minimum(place[tails] + 2 * k + WINDOW, words[row[heads]])
    rows, starts, ends = np.array(sure, np.int64).reshape(-1, 3).T
    covered = _union(shift[rows] + starts, shift[rows] + ends)
    may = _union(np.concatenate([a[many], covered[0]]), np.concatenate([b[many], covered[1]]))
    long = may[1] - may[0] >= least
    at = shift[row] + place
    good = many[group] & _inside(at, at + k, (may[0][long], may[1][long]))
    open_ = good & ~_inside(at, at + k, covered)
    if not open_.any():
        return open_
    return good & _inside(at, at, _union(at[open_] - NEAR, at[open_] + NEAR + 1))


class Near:
    """Seeds that may be open, by row and place: their hashes, the document and place of their first occurrences, and the chain
    that these are in."""

    def __init__(self, row, place, hashes, source, from_place, chain):
        self.columns = row, place, hashes, source, from_place, chain
        self.row, self.place, self.hash, self.source, self.from_place, self.chain = self.columns

    @staticmethod
    def read(table: pa.Table) -> Near:
        table = table.filter(pa.compute.is_valid(table["near"]))
        kinds = {"near": "<i4", "hashes": "<u8", "sources": "<i8", "froms": "<u4", "chains": "<i4"}
        lists = {n: arrays(table[n], t) for n, t in kinds.items()}
        row = np.repeat(table["row"].to_numpy(), [len(x) for x in lists["near"]])
        columns = [joined(x, kinds[n]).astype(_U if n == "hashes" else np.int64) for n, x in lists.items()]
        by = np.lexsort((columns[0], row))
        return Near(row[by], *(x[by] for x in columns))

    def take(self, which: np.ndarray) -> Near:
        return Near(*(x[which] for x in self.columns))

    def pairs(self, k: int):
        """Each two seeds that may follow one another in a chain, but don't in that of their first occurrences: (first, second,
        whether first occurrences explain them).

        They are explained if one document has the first occurrences of both as close: another one with the two has no more
        seeds there than that.
        """
        for step in range(1, k + GAP + 1):
            i = np.flatnonzero((self.row[step:] == self.row[:-step]) & (self.place[step:] - self.place[:-step] <= k + GAP))
            if not len(i):
                break
            i = i[(self.chain[i] != self.chain[i + step]) | (self.chain[i] < 0)]
            yield i, i + step, self.explained(i, i + step, k)

    def explained(self, i: np.ndarray, j: np.ndarray, k: int) -> np.ndarray:
        apart, there = self.place[j] - self.place[i], self.from_place[j] - self.from_place[i]
        in_order = (there > 0) & (there <= k + GAP) & ((there == apart) | (there >= k) & (apart >= k))
        return (self.source[i] == self.source[j]) & in_order

    def add_to(self, out: dict, unit: int, k: int) -> None:
        """A row for each text that has pairs to be looked at."""
        rows = [self.row[i] for i, _, _ in self.pairs(k)]
        for one in np.unique(joined(rows, np.int64)).tolist():
            mine = self.take(self.row == one)
            _add_row(out, unit=unit, row=one, near=mine.place.astype("<i4").tobytes(), hashes=mine.hash.astype("<u8").tobytes(),
                     sources=mine.source.astype("<i8").tobytes(), froms=mine.from_place.astype("<u4").tobytes(),
                     chains=mine.chain.astype("<i4").tobytes())


_NEAR = "near binary, hashes binary, sources binary, froms binary, chains binary"
_CHAINS = f"unit long, row long, source long, low long, high long, blocks binary, {_NEAR}"


def _send_chains(k: int, bits: int, least: int, percent: int):
    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        out = {n: [] for n in schema_of(_CHAINS).names}
        if len(left) and len(right):
            unit = Unit(left)
            seeds = Seeds(unit, k)
            told = {b: (np.frombuffer(d.as_buffer(), "<i8"), np.frombuffer(p.as_buffer(), "<u4"))
                    for b, d, p in zip(right["bucket"].to_pylist(), right["docs"], right["places"]) if d.is_valid}
            marks = right.filter(pa.compute.is_valid(right["many"]))
            runs, wanted = _repeated(seeds, marks, bits)
            matches = []
            for part, kinds, words in ((0, seeds, k), (1, runs, LONG)):
                source = np.full(len(kinds.kinds), -1, np.int64)
                source_place = np.zeros(len(kinds.kinds), np.int64)
                there = np.zeros(len(kinds.kinds), bool)
                for bucket, *picks in wanted:
                    if bucket in told:
                        mine = slice(0, len(picks[0])) if part == 0 else slice(len(picks[0]), None)
                        source[picks[part]], source_place[picks[part]] = (x[mine] for x in told[bucket])
                        there[picks[part]] = True
                if part == 0:
                    firsts = there, source, source_place
                of = np.repeat(np.flatnonzero(there), kinds.size[there])
                take = kinds.order[np.repeat(there, kinds.size)]
                earlier = source.take(of) < unit.doc.take(kinds.row.take(take))
                take, of = take[earlier], of[earlier]
                # a long match as matches of k words that touch
                shifts = np.unique([*range(0, words - k, k), words - k])[:, None]
                matches.append([(x + y).ravel() for x, y in zip(
                    (kinds.row[take], source[of], kinds.place[take], source_place[of]), (0 * shifts, 0 * shifts, shifts, shifts))])
            row, doc_from, place, place_from = (np.concatenate(x) for x in zip(*matches))
            numbers = pa.array(doc_from).dictionary_encode()
            docs = np.sort(numbers.dictionary.to_numpy())
            number = np.searchsorted(docs, numbers.dictionary.to_numpy()).take(numbers.indices.to_numpy())
            row, number, place, place_from = _distinct_rows(row, number, place, place_from)
            new = np.r_[True, (row[1:] != row[:-1]) | (number[1:] != number[:-1])][: len(row)]
            size = np.diff(np.append(np.flatnonzero(new), len(row)))
            enough = np.repeat(size >= FEWEST, size)
            row, number, place, place_from = row[enough], number[enough], place[enough], place_from[enough]
            size = size[size >= FEWEST]
            group = np.repeat(np.arange(len(size)), size)
            row_of, number_of = (x[np.cumsum(size) - size] for x in (row, number))
            p, s, w, g, order, block = blocks_of(place, place_from, k, group)
            of, n = _chains_in_groups(p, s, w, g)
            chain = np.empty(len(of), np.int64)
            chain[of] = np.repeat(np.arange(len(n)), n)
            matches = row[order], place[order], docs[number[order]], place_from[order], chain[block]
            last = np.cumsum(n)
            p, s, w, g = p[of], s[of], w[of], g[of]
            first, last = last - n, last - 1
            keep = (size[g[first]] > FEWEST) | (n > 1) | (w[first] > k)  # not two seeds far apart
            blocks, n, first, last = np.repeat(keep, n), n[keep], first[keep], last[keep]
            beyond = k + WINDOW  # how many words before and after the chain its ends may reach
            rows, low, high = row_of[g[first]], np.maximum(s[first] - beyond, 0), s[last] + w[last] + beyond
            begin, n_words = p[first], np.maximum(p[last] + w[last] - p[first], s[last] + w[last] - s[first])
            equal = np.concatenate(([0], np.cumsum(w)))
            equal = equal[last + 1] - equal[first]
            # chains that count whatever their gaps and ends hold: those can only add to the share of equal words
            sure = (p[last] + w[last] - begin >= SHORTEST) & (100 * equal >= percent * n_words)
            _add_near(out, seeds, *firsts, matches, np.stack([rows, begin, p[last] + w[last]], axis=1)[sure], least)
            at = _spread(3 * (np.cumsum(n) - n), n)
            flat = np.empty(3 * len(at), "<i4")
            for i, x in enumerate((p, s, w)):
                flat[at + i * np.repeat(n, n)] = x[blocks]
            sources = docs[number_of[g[first]]]
            _add_chains(out, unit.number, rows, sources, n, flat)
            asks = pa.table({"unit": np.full(len(n), unit.number), "source": sources, "low": low, "high": high})
            schema = schema_of(_CHAINS)
            asks = asks.group_by(["unit", "source"]).aggregate([("low", "min"), ("high", "max")]).rename_columns(asks.column_names)
            asks = [asks[x.name] if x.name in asks.column_names else pa.nulls(len(asks), x.type) for x in schema]
            return pa.concat_tables([pa.table(asks, schema=schema), pa.table(out, schema)])
        return pa.table(out, schema_of(_CHAINS))

    return run


#: Chains of a unit in one row.
_PACK = 1 << 16


def _add_chains(out: dict, unit: int, rows: np.ndarray, sources: np.ndarray, size: np.ndarray, blocks: np.ndarray) -> None:
    """Packed chains: their rows (``froms``), sources, blocks of each (``chains``), and the blocks end to end, of each chain the
    places, source places and words."""
    ends = np.concatenate(([0], np.cumsum(3 * size)))
    for i in range(0, len(size), _PACK):
        j = min(i + _PACK, len(size))
        _add_row(out, unit=unit, froms=rows[i:j].astype("<u4").tobytes(), sources=sources[i:j].astype("<i8").tobytes(),
                 chains=size[i:j].astype("<i4").tobytes(), blocks=blocks[ends[i] : ends[j]].tobytes())


def _add_row(out: dict, **values) -> None:
    for name in out:
        out[name].append(values.get(name))


def _add_near(out: dict, seeds: Seeds, there: np.ndarray, source: np.ndarray, from_place: np.ndarray, matches, sure: list,
              least: int) -> None:
    """Rows with the places and hashes of seeds that may be open. ``source``: the first document with each distinct seed,
    where ``there``, and its place in it; ``matches``: row, place, source, place there and chain of each match."""
    kind = np.repeat(np.arange(len(seeds.kinds)), seeds.size)
    earlier = there[kind] & (source[kind] < seeds.unit.doc[seeds.row[seeds.order]])
    which = np.sort(seeds.order[earlier])
    which = which[_open(seeds.row[which], seeds.place[which], seeds.words.first, seeds.k, sure, least)]
    of = np.empty(len(seeds.order), np.int64)
    of[seeds.order] = kind
    of = of[which]
    first = seeds.words.first
    at = first[seeds.row[which]] + seeds.place[which]
    seed = np.full(int(first[-1]) + 1, -1)
    seed[at] = np.arange(len(which))
    row, place, doc_from, place_from, chain = matches
    mine = seed[first[row] + place]
    same = (mine >= 0) & (doc_from == source[of][mine]) & (place_from == from_place[of][mine]) if len(of) else np.zeros(len(row), bool)
    chain_of = np.full(len(which), -1)
    chain_of[mine[same]] = chain[same]
    near = Near(seeds.row[which], seeds.place[which], seeds.hash[which], source[of], from_place[of], chain_of)
    near.add_to(out, seeds.unit.number, seeds.k)


def _pack(hashes: np.ndarray, bits: int) -> bytes:
    tail = _tail(hashes, bits)
    return (tail >> _U(8)).astype("<u4").tobytes() + (tail & _U(255)).astype(np.uint8).tobytes()


_WANTED = "unit long, bucket int, hashes binary"


def _ask_seeds(k: int, bits: int):
    """The hashes of a unit's open seeds by bucket, without those that first occurrences explain."""
    def run(table: pa.Table) -> pa.Table:
        out = {n: [] for n in schema_of(_WANTED).names}
        near = Near.read(table)
        hashes = np.unique(joined([near.hash[x[~explained]] for *both, explained in near.pairs(k) for x in both], _U))
        for bucket, a, b in bucket_ranges(hashes, bits):
            _add_row(out, unit=table["unit"][0].as_py(), bucket=bucket, hashes=_pack(hashes[a:b], bits))
        return pa.table(out, schema_of(_WANTED))

    return run


def _unpack(packed) -> list[np.ndarray]:
    sizes = [len(x.as_buffer()) // 5 for x in packed]
    return [(np.frombuffer(x.as_buffer(), "<u4", n).astype(_U) << _U(8)) | np.frombuffer(x.as_buffer(), np.uint8, n, 4 * n)
            for x, n in zip(packed, sizes)]


_ASKED_SEEDS = "unit long, bucket int, many binary"


def _asked_seeds(_, left: pa.Table, right: pa.Table) -> pa.Table:
    """Per unit and bucket: which of the sent hashes are asked for, where there are any."""
    out = {n: [] for n in schema_of(_ASKED_SEEDS).names}
    if len(left) and len(right):
        asked = np.unique(joined(_unpack(right["hashes"]), _U))
        lists = _unpack(left["hashes"])
        hashes = joined(lists, _U)
        there = asked.take(np.searchsorted(asked, hashes), mode="clip") == hashes if len(asked) else np.zeros(len(hashes), bool)
        ends = np.cumsum([len(x) for x in lists])
        some = np.diff(np.cumsum(there)[ends - 1], prepend=0) > 0
        units, buckets = left["unit"].to_numpy(), left["bucket"].to_numpy()
        for i in np.flatnonzero(some).tolist():
            out["unit"].append(units[i])
            out["bucket"].append(buckets[i])
            out["many"].append(np.packbits(there[ends[i] - len(lists[i]) : ends[i]]).tobytes())
    return pa.table(out, schema_of(_ASKED_SEEDS))


_PAIRS = ("key long, least long, most long, unit long, row long, doc long, start int, end int, asks int, places array<int>, "
          "sources array<int>")
_HOLDS, _ASKS, _GIVEN = 0, 1, 2


def _by_text(asks: int, unit: int, group: tuple, between: np.ndarray, places: np.ndarray, sources: np.ndarray) -> pa.Table:
    """One row for all places of a key in a text: ``group`` has key, row, doc, start and end; ``least`` and ``most`` of the
    words between."""
    if not len(between):
        return schema_of(_PAIRS).empty_table()
    by = np.lexsort((sources, places, between, *group))
    group, between = [x[by] for x in group], between[by]
    new = np.logical_or.reduce([np.r_[True, x[1:] != x[:-1]] for x in group])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(by))
    key, row, doc, start, end = (x[first] for x in group)
    cut = pa.array(np.append(first, len(by)), pa.int32())
    lists = [pa.ListArray.from_arrays(cut, pa.array(x[by], pa.int32())) for x in (places, sources)]
    columns = (key, between[first], between[last - 1], np.full(len(first), unit), row, doc, start, end, np.full(len(first), asks))
    schema = schema_of(_PAIRS)
    return pa.table([*(pa.array(x, t) for x, t in zip(columns, schema.types)), *lists], schema=schema)


def _send_pairs(k: int, bits: int):
    """Each two seeds that are asked for and lie close enough to follow one another in a chain: a row for each text that holds
    them, and one (``_ASKS``) for those that are open there and that first occurrences do not explain; ``start`` and ``end``:
    the words that chains through them may cover. Those that lie with one source are matched with that again (``_GIVEN``)."""
    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        out, asks, given = [], [], []
        near = Near.read(right) if len(right) else None
        if len(left) and near is not None and (len(near.row) or right["many"].null_count < len(right)):
            unit = Unit(left)
            seeds = Seeds(unit, k)
            told = {b: x for b, x in zip(right["bucket"].to_pylist(), right["many"]) if x.is_valid}
            asked = np.zeros(len(seeds.kinds), bool)
            for bucket, a, b in bucket_ranges(seeds.kinds, bits):
                if bucket in told:
                    asked[a:b] = np.unpackbits(np.frombuffer(told[bucket].as_buffer(), np.uint8), count=b - a)
            which = np.sort(seeds.order[np.repeat(asked, seeds.size)])  # by row and place
            row, place, doc, hashes = seeds.row[which], seeds.place[which], unit.doc[seeds.row[which]], seeds.hash[which]
            from_place = seeds.source_place[which]
            first = seeds.words.first
            new = np.r_[True, (np.diff(near.row) != 0) | (np.diff(near.place) > 2 * NEAR)][: len(near.row)]
            stretch = np.cumsum(new) - 1
            starts = np.maximum(near.place[new] - NEAR, 0)[stretch]
            ends = (near.place[np.r_[new[1:], True][: len(new)]] + k + NEAR)[stretch]
            for i, _, explained in near.pairs(k):
                i = i[explained]
                given.append((np.zeros(len(i), np.int64), near.row[i], near.source[i], starts[i], ends[i], i, near.place[i], near.from_place[i]))
            which_open = np.full(int(first[-1]) + 1, -1)
            which_open[first[near.row] + near.place] = np.arange(len(near.row))
            which_open = which_open[first[row] + place]
            sums, down = _word_sums(seeds.word_hashes)
            for step in range(1, k + GAP + 1):
                i = np.flatnonzero((row[step:] == row[:-step]) & (place[step:] - place[:-step] <= k + GAP))
                if not len(i):
                    break
                for t in range(step):  # in text that repeats itself, the next seed of its kind and not the one itself
                    i = i[hashes[i + t] != hashes[i + step]]
                j = i + step
                with np.errstate(over="ignore"):
                    key = mix(mix(hashes[i]) * _U(0x9E3779B97F4A7C15) + hashes[j])
                    end = first[row[j]] + place[j]
                    start = np.minimum(first[row[i]] + place[i] + k, end)
                    between = mix((sums[end] - sums[start]) * down[start] + (place[j] - place[i]).astype(_U))
                key, between = key.view(np.int64), between.view(np.int64)
                no = np.zeros(len(i), np.int64)
                out.append((key, row[i], doc[i], no, no, between, no, from_place[i]))
                x, y = which_open[i], which_open[j]
                at = np.flatnonzero((x >= 0) & (y >= 0))
                x, y = x[at], y[at]
                ask = ((near.chain[x] != near.chain[y]) | (near.chain[x] < 0)) & ~near.explained(x, y, k)
                at, x = at[ask], x[ask]
                asks.append((key[at], row[i[at]], doc[i[at]], starts[x], ends[x], between[at], place[i[at]], no[at]))
        parts = []
        for kind, found in ((_HOLDS, out), (_ASKS, asks), (_GIVEN, given)):
            if found:
                *group, between, places, sources = map(np.concatenate, zip(*found))
                if kind == _HOLDS:
                    # a source is matched with its first place that looks so; the texts of a document are one source
                    by = np.lexsort((sources, between, group[0], group[2]))
                    new = np.logical_or.reduce([np.r_[True, x[by][1:] != x[by][:-1]] for x in (between, group[0], group[2])])[: len(by)]
                    by = by[new]
                    group, between, places, sources = [x[by] for x in group], between[by], places[by], sources[by]
                    group[1] = np.zeros(len(by), np.int64)
                parts.append(_by_text(kind, unit.number, tuple(group), between, places, sources))
        return pa.concat_tables(parts) if parts else schema_of(_PAIRS).empty_table()

    return run


def _other_sources(by_unit, sent: DataFrame, counted: DataFrame, k: int, bits: int) -> DataFrame:
    """Stretches of open seeds (words ``start`` to ``end``) and, of every earlier document that shares two of them, but not the
    words between, the words that may belong to such a stretch. ``met``: places of such seeds, here and there."""
    wanted = counted.groupBy("unit").applyInArrow(_ask_seeds(k, bits), _WANTED)
    asked = sent.groupBy("bucket").cogroup(wanted.groupBy("bucket")).applyInArrow(_asked_seeds, _ASKED_SEEDS)
    told = counted.unionByName(asked, allowMissingColumns=True).withColumnRenamed("unit", "u")
    pairs = write_step(by_unit.cogroup(told.groupBy("u")).applyInArrow(_send_pairs(k, bits), _PAIRS), "passages-pairs")
    later = pairs.where(F.col("asks") == _ASKS).drop("sources").withColumnRenamed("doc", "below")
    earlier = pairs.where(F.col("asks") == _HOLDS).select(
        "key", F.col("least").alias("from"), F.col("most").alias("to"), F.col("doc").alias("source"), "sources")
    other = (F.col("from") != F.col("most")) | (F.col("to") != F.col("least"))  # not all have the same words between
    met = later.join(earlier, (later["key"] == earlier["key"]) & (F.col("source") < F.col("below")) & other)
    columns = ["unit", "row", "start", "end", "source", "places", "sources"]
    met = met.select(columns).union(pairs.where(F.col("asks") == _GIVEN).withColumnRenamed("doc", "source").select(columns))
    met = met.groupBy("unit", "row", "source", "start", "end").agg(
        F.min(F.array_min("sources") - F.array_max("places")).alias("off"),
        F.max(F.array_max("sources") - F.array_min("places")).alias("most"),
        F.collect_list(F.struct("places", "sources")).alias("met"))
    low, high = F.greatest(F.col("start") + F.col("off") - NEAR, F.lit(0)), F.col("end") + F.col("most") + NEAR
    return met.select("unit", "row", "source", low.cast("long").alias("low"), high.cast("long").alias("high"), "start", "end", "met")


_ASKED = "asker long, source long, low long, high long"


def _ask(table: pa.Table) -> pa.Table:
    """One stretch of each source that a unit's chains need."""
    table = table.filter(pa.compute.is_valid(table["high"]))
    if not len(table):
        return schema_of(_ASKED).empty_table()
    found = table.group_by(["unit", "source"]).aggregate([("low", "min"), ("high", "max")])
    return pa.table([found["unit"], found["source"], found["low_min"], found["high_max"]], names=schema_of(_ASKED).names)


_REPLIES = "unit long, source long, low long, words binary"


def _reply(_, left: pa.Table, right: pa.Table) -> pa.Table:
    if not len(left) or not len(right):
        return schema_of(_REPLIES).empty_table()
    unit = Unit(left)
    docs = unit.doc[: np.count_nonzero(unit.known)]  # ascending
    asker, source, low, high = (right[c].to_numpy() for c in schema_of(_ASKED).names)
    first, last = np.searchsorted(docs, source), np.searchsorted(docs, source, "right")
    there = first < last
    asker, source, low, high, first, last = (x[there] for x in (asker, source, low, high, first, last))
    change = np.bincount(first, minlength=len(left) + 1) - np.bincount(last, minlength=len(left) + 1)
    needed = np.cumsum(change)[:-1] > 0
    words = unit.texts.take(np.flatnonzero(needed)).words()
    row = np.concatenate(([0], np.cumsum(needed)))  # the texts of a document stay together
    a, b = words.first[row[first]], words.first[row[last]]
    begin, end = np.minimum(a + low, b), np.minimum(a + high, b)
    change = np.bincount(begin, minlength=len(words.start) + 1) - np.bincount(end, minlength=len(words.start) + 1)
    asked = np.flatnonzero(np.cumsum(change)[:-1] > 0)
    hashes = np.empty(len(words.start), "<u4")
    hashes[asked] = words.hashes(asked)
    stretches = [hashes[x:y] for x, y in zip(begin.tolist(), end.tolist())]
    return pa.table([pa.array(asker), pa.array(source), pa.array(low), _in_rows(joined(stretches, "<u4"), end - begin)],
                    schema=schema_of(_REPLIES))


def _equal_words(mine: np.ndarray, theirs: np.ndarray, a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Words that a least-cost alignment of two gaps pairs with an equal one, for each two: ``n`` words of mine from ``a`` on and
    ``m`` of theirs from ``b`` on."""
    out = np.zeros(len(n), np.int64)
    some = np.flatnonzero((n > 0) & (m > 0))
    most = 1 << 16  # so many pairs of places at once, or those of one gap
    for part in np.array_split(some, max(1, len(some) * (int(m[some].max()) + 1) // most) if len(some) else 1):
        if len(part):
            at = np.arange(m[part].max())
            own = theirs.take(b[part][:, None] + at, mode="clip")
            inside = at < m[part][:, None]
            best = np.zeros((len(part), len(at) + 1), np.int32)
            for i in range(n[part].max()):
                same = (own == mine.take(a[part] + i, mode="clip")[:, None]) & inside & (i < n[part])[:, None]
                best[:, 1:] = np.maximum.accumulate(np.maximum(best[:, 1:], np.where(same, best[:, :-1] + 1, 0)), axis=1)
            out[part] = best[:, -1]
    return out


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many words two texts have in common from their beginning."""
    n, at, step = min(len(a), len(b)), 0, 32
    while at < n:
        differ = a[at : min(at + step, n)] != b[at : min(at + step, n)]
        first = int(differ.argmax())
        if differ[first]:
            return at + first
        at, step = at + len(differ), 4 * step
    return n


def _agree_all(mine: np.ndarray, theirs: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """How many words agree from ``a`` and ``b`` on, for each two, forwards (``step`` 1) or backwards (-1), of ``most``."""
    out = np.zeros(len(a), np.int64)
    more = np.arange(len(a))
    for begin, end in ((0, 8), (8, 40)):
        reach = np.arange(begin, end)
        for some in np.array_split(more, len(more) // (1 << 14) + 1) if len(more) else ():
            same = mine.take(a[some, None] + step * reach, mode="clip") == theirs.take(b[some, None] + step * reach, mode="clip")
            same &= reach < most[some, None]
            out[some] = begin + np.where(same.all(axis=1), len(reach), same.argmin(axis=1))
        more = more[(out[more] == end) & (most[more] > end)]
    for i in more.tolist():
        x, y, n = int(a[i]), int(b[i]), int(most[i])
        if step > 0:
            out[i] = _agree(mine[x : x + n], theirs[y : y + n])
        else:
            out[i] = _agree(mine[x - n + 1 : x + 1][::-1], theirs[y - n + 1 : y + 1][::-1])
    return out


def _align_all(mine: np.ndarray, begin: np.ndarray, end: np.ndarray, theirs: np.ndarray, their_begin: np.ndarray,
               their_end: np.ndarray, place: np.ndarray, source: np.ndarray, words: np.ndarray, size: np.ndarray, low: np.ndarray):
    """(place, words, source place, source words, equal words) of each chain, extended while words are equal. Blocks lie end to
    end, ``size`` of them a chain; a chain's places count from ``begin``, and its text ends at ``end``. Of a source only the
    words from place ``low`` on are there."""
    last = np.cumsum(size) - 1
    first = last - size + 1
    a, sa = begin + place[first], their_begin + source[first]
    b, sb = begin + place[last] + words[last], their_begin + source[last] + words[last]
    inner = np.ones(max(len(words), 1), bool)  # blocks with another after them
    inner[last] = False
    at = np.flatnonzero(inner[: len(words)])
    of = np.repeat(np.arange(len(size)), size)[at]
    ends, source_ends = place[at] + words[at], source[at] + words[at]
    gaps = _equal_words(mine, theirs, begin[of] + ends, place[at + 1] - ends, their_begin[of] + source_ends, source[at + 1] - source_ends)
    equal = np.concatenate(([0], np.cumsum(words)))
    equal = equal[last + 1] - equal[first] + np.bincount(of, gaps, len(size)).astype(np.int64)
    before = _agree_all(mine, theirs, a - 1, sa - 1, np.minimum(place[first], source[first] - low), -1)
    after = _agree_all(mine, theirs, b, sb, np.minimum(end - b, their_end - sb), 1)
    return a - begin - before, b - a + before + after, sa - their_begin - before, sb - sa + before + after, equal + before + after


def align(mine: np.ndarray, theirs: np.ndarray, low: int, blocks: np.ndarray) -> tuple[int, int, int, int, int]:
    """:func:`_align_all` of one chain with the words from ``low`` on of a source."""
    place, source, words = blocks.astype(np.int64)
    begin, end, their_begin, their_end, size, low = (np.array([x]) for x in (0, len(mine), -low, len(theirs), len(words), low))
    found = _align_all(mine, begin, end, theirs, their_begin, their_end, place, source, words, size, low)
    return tuple(int(x[0]) for x in found)


def _shared_runs(mine: np.ndarray, a: np.ndarray, n: np.ndarray, theirs: np.ndarray, b: np.ndarray, m: np.ndarray, met, k: int):
    """Runs of k words that are equal in two stretches, for each two (``n`` words of mine from ``a`` on and ``m`` of theirs from
    ``b`` on): which two, and the places within them. They are sought on the diagonal of each two places that met, within
    ``NEAR`` words; and a run's first place in the source is tried."""
    grams = sequence_hashes(mine.take(_spread(a, n)).astype(_U), k)
    known = sequence_hashes(theirs.take(_spread(b, m)).astype(_U), k)
    if not len(grams) or not len(known):
        return np.empty((3, 0), np.int64)
    a, b = np.cumsum(n) - n, np.cumsum(m) - m
    n, m = np.maximum(n - k + 1, 0), np.maximum(m - k + 1, 0)
    two = np.arange(len(n))
    of, at, known_of, known_at = np.repeat(two, n), _spread(a, n), np.repeat(two, m), _spread(b, m)
    apart = mix(two.astype(_U) + _U(1))  # runs of different stretches are different
    order, kinds = _ordered(mix(known[known_at] ^ apart[known_of]))
    new = np.r_[True, kinds[1:] != kinds[:-1]][: len(kinds)]
    order, kinds = order[new], kinds[new]
    own = mix(grams[at] ^ apart[of])
    kind = np.searchsorted(kinds, own).clip(max=len(kinds) - 1)
    there = np.flatnonzero(kinds[kind] == own) if len(kinds) else np.empty(0, np.int64)
    place, source = at[there] - a[of[there]], known_at[order[kind[there]]] - b[of[there]]
    found = [(of[there], place, source)]
    reach = np.arange(-NEAR, NEAR + 2 * k + GAP)
    for part in np.array_split(np.arange(len(met[0])), len(met[0]) // (1 << 13) + 1):
        of, place, source = (x[part][:, None] for x in met)
        place, source = place + reach, source + reach
        inside = (place >= 0) & (place < n[of]) & (source >= 0) & (source < m[of])
        of, place, source = np.broadcast_to(of, inside.shape)[inside], place[inside], source[inside]
        same = grams[a[of] + place] == known[b[of] + source]
        found.append((of[same], place[same], source[same]))
    return _distinct_rows(*map(np.concatenate, zip(*found)))


def _met(column: pa.ListArray) -> list[np.ndarray]:
    """Each two places that met: of which row, place here and there."""
    pairs = column.flatten()
    row = np.repeat(np.arange(len(column)), pa.compute.list_value_length(column).to_numpy())
    (places, n), (sources, m) = ((x.flatten().to_numpy().astype(np.int64), pa.compute.list_value_length(x).to_numpy().astype(np.int64))
                                 for x in pairs.flatten())
    first, source_first, size = np.cumsum(n) - n, np.cumsum(m) - m, n * m
    of = np.repeat(np.arange(len(size)), size)
    at = _spread(0 * size, size)
    return _distinct_rows(row[of], places[first[of] + at // m[of]], sources[source_first[of] + at % m[of]])


_COUNTED = f"unit long, row long, counted binary, {_NEAR}"


def _add_counted(out: dict, unit: int, found: np.ndarray) -> None:
    """Packed chains that count, as of :func:`_counted`: the source is the last column, and as long as two others."""
    narrow = np.concatenate([found[:, [0, 1, 2, 4, 5, 6]].astype("<i4"), found[:, 3:4].astype("<i8", order="C").view("<i4")], axis=1)
    for i in range(0, len(found), _PACK):
        _add_row(out, unit=unit, counted=narrow[i : i + _PACK].tobytes())


def _read_counted(column) -> np.ndarray:
    narrow = _values(column, "<i4")[0].reshape(-1, 8)
    found = np.empty((len(narrow), 7), np.int64)
    found[:, [0, 1, 2, 4, 5, 6]] = narrow[:, :6]
    found[:, 3] = np.ascontiguousarray(narrow[:, 6:]).view("<i8")[:, 0]
    return found



def _values(column, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The values of a packed column end to end, and how many each row has."""
    column = column.combine_chunks()
    data, offsets = bytes_of(column if isinstance(column, pa.Array) else pa.array([], pa.binary()))
    return np.frombuffer(data.tobytes(), dtype), np.diff(offsets) // np.dtype(dtype).itemsize


def _counted(unit: Unit, right: pa.Table, percent: int, k: int) -> np.ndarray:
    """The chains that count: columns row, first word, last word + 1, source, the same there, equal words."""
    first_search = "blocks" in right.column_names
    asked = right.filter(pa.compute.is_valid(right["blocks" if first_search else "high"]))
    replies = right.filter(pa.compute.is_valid(right["words"]))
    if not len(asked) or not len(replies):
        return np.empty((0, 7), np.int64)
    if first_search:
        rows, sought = (_values(asked[n], t)[0].astype(np.int64) for n, t in (("froms", "<u4"), ("sources", "<i8")))
    else:
        rows, sought = asked["row"].to_numpy(), asked["source"].to_numpy()
    needed, row = np.unique(rows, return_inverse=True)
    words = unit.texts.take(needed).words()
    hashes, first = words.hashes().astype("<u4"), words.first
    theirs, sizes = _values(replies["words"], "<u4")
    sources, lows = replies["source"].to_numpy(), replies["low"].to_numpy()
    by = np.argsort(sources, kind="stable")
    reply = by[np.searchsorted(sources[by], sought, "right") - 1]  # there is one for each source
    known = sources[reply] == sought
    ends = np.cumsum(sizes)
    if first_search:
        flat, size = _values(asked["blocks"], "<i4")[0], _values(asked["chains"], "<i4")[0].astype(np.int64)
        at = _spread(3 * (np.cumsum(size) - size), size)
        place, source, length = (flat[at + i * np.repeat(size, size)].astype(np.int64) for i in range(3))
        chain = np.arange(len(rows))
    else:
        parts, size, chain = [np.empty((3, 0), np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        start, end, least, most = (asked[n].to_numpy().astype(np.int64) for n in ("start", "end", "low", "high"))
        meetings, all_ = asked["met"].combine_chunks(), np.flatnonzero(known)
        step = np.cumsum((end - start + most - least)[all_]) // (1 << 18)  # so many words at once, or those of one row
        for i in np.split(all_, np.flatnonzero(np.diff(step)) + 1):
            j, begin = reply[i], first[row[i]] + start[i]
            from_ = np.maximum(least[i], lows[j])
            to = np.minimum(most[i], lows[j] + sizes[j])
            of, here, there = _met(meetings.take(pa.array(i)))
            met = of, here - start[i][of], there - from_[of]
            n, m = np.minimum(end[i] - start[i], first[row[i] + 1] - begin), np.maximum(to - from_, 0)
            of, here, there = _shared_runs(hashes, begin, n, theirs, (ends - sizes - lows)[j] + from_, m, met, k)
            blocks = blocks_of(here + start[i][of], there + from_[of], k, of)[:4]
            *blocks, of = _pieces(*blocks[:3], k, blocks[3])
            which, n = _chains_in_groups(*blocks, of)
            head = which[np.cumsum(n) - n]
            keep = (n > 1) | (blocks[2][head] > k)
            parts.append(np.stack(blocks)[:, which[np.repeat(keep, n)]])
            size.append(n[keep])
            chain.append(i[of[head[keep]]])
        place, source, length = np.concatenate(parts, axis=1)
        size, chain = np.concatenate(size), np.concatenate(chain)
    good = known[chain]
    blocks = np.repeat(good, size)
    chain, size = chain[good], size[good]
    row, reply = row[chain], reply[chain]
    a, n, sa, sn, equal = _align_all(hashes, first[row], first[row + 1], theirs, (ends - sizes - lows)[reply], ends[reply],
                                     place[blocks], source[blocks], length[blocks], size, lows[reply])
    counts = (n >= SHORTEST) & (100 * equal >= percent * np.maximum(n, sn))
    return np.stack([rows[chain], a, a + n, sought[chain], sa, sa + sn, equal], axis=1)[counts]


def _align_first(k: int, least: int, percent: int):
    """What counts of the first search, and which seeds are still open."""
    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        out = {n: [] for n in schema_of(_COUNTED).names}
        if len(left) and len(right):
            unit = Unit(left)
            found = _counted(unit, right, percent, k)
            near = Near.read(right)
            texts = np.unique(near.row)
            first = unit.texts.take(texts).words().first
            sure = found[np.isin(found[:, 0], texts), :3]
            sure[:, 0] = np.searchsorted(texts, sure[:, 0])
            near.take(_open(np.searchsorted(texts, near.row), near.place, first, k, sure, least)).add_to(out, unit.number, k)
            _add_counted(out, unit.number, found)
        return pa.table(out, schema_of(_COUNTED))

    return run


def _passages(unit: Unit, right: pa.Table, k: int, least: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The repeated passages: columns row, first word, last word + 1; and the chains that make them, as of :func:`_counted`."""
    found = _read_counted(right["counted"])
    more = _counted(unit, right, percent, k)
    if len(more):  # what both searches find is one chain
        known = set(map(tuple, found[np.isin(found[:, 0], more[:, 0])].tolist()))
        more = sorted(set(map(tuple, more.tolist())) - known)
        found = np.concatenate([found, np.array(more, np.int64).reshape(-1, 7)])
    found = found[_order_of(*found.T[:3])]
    row, a, b = found.T[:3]
    text = np.cumsum(np.r_[False, row[1:] != row[:-1]][: len(row)]) * (int(b.max(initial=0)) + 1)  # texts apart
    reach = np.maximum.accumulate(text + b)
    new = np.r_[True, (text + a)[1:] > reach[:-1]][: len(row)]
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(row)))
    runs = np.stack([row[first], a[first], (reach - text)[first + size - 1]], axis=1)
    long = runs[:, 2] - runs[:, 1] >= least
    return runs[long], found[np.repeat(long, size)]


_FOUND = ("doc_id long, source_id long, first_word long, n_words long, source_first_word long, source_n_words long, "
          "equal_words long")


def _list_passages(k: int, least: int, percent: int):
    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return schema_of(_FOUND).empty_table()
        unit = Unit(left)
        row, a, b, source, sa, sb, equal = _passages(unit, right, k, least, percent)[1].T
        columns = unit.doc[row], source, a, b - a, sa, sb - sa, equal
        return pa.table([pa.array(np.ascontiguousarray(x)) for x in columns], schema=schema_of(_FOUND))

    return run


def _cut_passages(columns: list[str], text: str, chars: str, k: int, least: int, percent: int):
    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema(list(left.schema.field("row").type))
        if not len(left):
            return schema.empty_table()
        unit = Unit(left)
        rows = unit.table["row"].combine_chunks()
        texts = rows.field(columns.index(text)).to_pylist()
        counts = rows.field(columns.index(chars)).to_pylist() if chars in columns else None
        data, offsets = unit.texts.data, unit.texts.offsets
        runs = _passages(unit, right, k, least, percent)[0] if len(right) else np.empty((0, 3), np.int64)
        cut = np.flatnonzero(np.r_[True, runs[1:, 0] != runs[:-1, 0], True]).tolist() if len(runs) else [0]
        for i, j in zip(cut[:-1], cut[1:]):
            row = int(runs[i, 0])
            begin, end = int(offsets[row]), int(offsets[row + 1])
            starts = unit.texts.take(np.array([row])).words().start + begin
            kept, at = [], begin
            for a, b in runs[i:j, 1:].tolist():
                kept.append(data[at : starts[a]].tobytes())
                at = int(starts[b]) if b < len(starts) else end
            texts[row] = (b"".join(kept) + data[at:end].tobytes()).decode()
            if counts is not None:
                counts[row] = len(texts[row])
        new = {text: pa.array(texts, schema.field(text).type)}
        if counts is not None:
            new[chars] = pa.array(counts, schema.field(chars).type)
        return pa.table([new.get(c, rows.field(i)) for i, c in enumerate(columns)], schema=schema)

    return run


def _prepared(docs: DataFrame, key: str, text: str, k: int, least: int, percent: int):
    """Units, and for each what its chains and the words of their sources are."""
    rows, units, bits = unit_frame(docs, key, text, grow=True)
    by_unit = rows.groupBy("unit")
    sent = write_step(by_unit.applyInArrow(_send_hashes(k, bits), _MARKS), "passages-sent")
    marks = sent.groupBy("bucket").applyInArrow(_answer_anchors, "unit long, bucket int, many binary")
    marks = write_step(marks.withColumnRenamed("unit", "u"), "passages-marks").repartition("u")
    places = by_unit.cogroup(marks.groupBy("u")).applyInArrow(_send_places(k, bits), _PLACES)
    sources = places.groupBy("bucket").applyInArrow(_answer_places, "unit long, bucket int, docs binary, places binary")
    told = marks.unionByName(sources.withColumnRenamed("unit", "u"), allowMissingColumns=True)
    chains = by_unit.cogroup(told.groupBy("u")).applyInArrow(_send_chains(k, bits, least, percent), _CHAINS).repartition("unit")
    aligned = by_unit.cogroup(_with_words(by_unit, chains, units).groupBy("u")).applyInArrow(_align_first(k, least, percent), _COUNTED)
    counted = write_step(aligned, "passages-counted").repartition("unit")
    more = write_step(_other_sources(by_unit, sent, counted, k, bits), "passages-more").repartition("unit")
    return by_unit, _with_words(by_unit, more, units).unionByName(counted.withColumnRenamed("unit", "u"), allowMissingColumns=True)


def _with_words(by_unit, chains: DataFrame, units: int) -> DataFrame:
    """The chains, and the words of their sources' stretches, by the unit (``u``) of the later text."""
    asked = chains.groupBy("unit").applyInArrow(_ask, _ASKED).withColumn("of", unit_of("source", units))
    replies = by_unit.cogroup(asked.groupBy("of")).applyInArrow(_reply, _REPLIES)
    return chains.unionByName(replies, allowMissingColumns=True).withColumnRenamed("unit", "u")


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, least: int = 50,
                      percent: int = 80) -> DataFrame:
    """One row per chain of a repeated passage: doc_id and place (first word, words) of the later text, source_id and place
    of the earlier one, and how many words the alignment pairs as equal.

    The later document is the one with the larger doc_id. Words are parted by ASCII white space and compared without case
    of A-Z. A null text is empty; rows with a null doc_id take no part; rows that share a doc_id aren't compared. Other
    columns are not read.
    """
    units, answers = _prepared(docs, key, text, k, least, percent)
    return units.cogroup(answers.groupBy("u")).applyInArrow(_list_passages(k, least, percent), _FOUND)


def cut_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", chars: str = "n_chars", k: int = 5,
                 least: int = 50, percent: int = 80) -> DataFrame:
    """The documents, all columns, with repeated passages cut out of the later text; ``chars`` is its new length. The first
    occurrence of a passage and documents without repeats stay as they are."""
    _, answers = _prepared(docs, key, text, k, least, percent)
    answers = write_step(answers, "passages-answers").groupBy("u")
    units = unit_frame(docs, key, text, True, True)[0].groupBy("unit")  # whole rows are dealt once, for the cut
    return units.cogroup(answers).applyInArrow(_cut_passages(docs.columns, text, chars, k, least, percent), docs.schema)
