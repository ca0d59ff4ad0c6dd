"""Exact substring dedup on bytes: column-wise multi-document suffix construction over shared places.

A byte is removed when a run of ``least`` bytes that covers it also starts in a document with a smaller doc_id.

A suffix order of all documents, grown by one symbol of each a round, would take as many rounds as the longest document has
bytes. Only runs of ``least`` bytes matter, so the collection is cut to the places that can repeat, and every string in it
is short (under 2 * ``least`` bytes):

1. Every run of ``least`` bytes has an anchor, its ``ANCHOR``-byte string with the smallest hash (leftmost if equal). Equal
   runs have equal anchors at equal offsets. Each unit of documents sends its distinct anchor hashes to buckets of hash
   values; a bucket answers which of them more than one document has. About one byte in twelve is an anchor, five bytes
   each are sent, and an anchor shared by a third of all documents is sent once a unit.
2. For anchors with more than one document, the unit sends a hash of the bytes of all runs around the anchor, once for each
   distinct string, with its smallest document. The bucket answers which strings a smaller document has as a whole, and
   which are the first of their kind beside others with the same anchor.
3. Only these are sent themselves. The bucket builds the transform and common prefixes of its strings with ``bwt.build``: one
   symbol of every string a round, in external files of the task. Suffixes that share ``least`` bytes are neighbours there;
   the smallest document among them decides what is removed.
4. The answers go back to the units, which cut.

Hash collisions of anchors cost time only; strings are taken as equal without comparison by 96 bits. Nothing is capped.
Memory: a unit (``units.UNIT_BYTES`` or the longest text), or the distinct strings of a bucket.
"""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import bwt
from ledgermill.llm.text import _BYTE, _power_tables, mix
from ledgermill.llm.units import Unit, arrays, bucket_ranges, joined, schema_of, unit_frame

ANCHOR = 28
#: Bytes hashed at once: whole documents, or windows of one longer document.
_PIECE = 1 << 19
_U = np.uint64


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return x if have == width else np.minimum(x[: len(x) - (width - have)], x[width - have :])


class Anchors:
    """Anchors of some documents: hash, hash of the string of all their runs, first run's start, number of runs, row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, least: int, k: int = ANCHOR):
        found: list[tuple[np.ndarray, ...]] = []
        for a, b in self._pieces(offsets, least):
            if b - a >= least:
                found.append(self._piece(data, offsets, a, b, least, k))
        names = ("hash", "content", "start", "runs")
        for name, i in zip(names, range(4)):
            setattr(self, name, joined([f[i] for f in found], _U if i < 2 else np.int64))
        self.row = np.searchsorted(offsets, self.start, "right") - 1

    @staticmethod
    def _pieces(offsets, least):
        row, rows = 0, len(offsets) - 1
        while row < rows:
            to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _PIECE, "right")) - 1)
            a, b = int(offsets[row]), int(offsets[to])
            while b - a > 2 * _PIECE:  # one long document: windows that overlap by a run
                yield a, a + _PIECE + least - 1
                a += _PIECE
            yield a, b
            row = to

    @staticmethod
    def _piece(data, offsets, a, b, least, k):
        part = data[a:b]
        up, down = _power_tables(len(part))
        sums = np.zeros(len(part) + 1, _U)
        with np.errstate(over="ignore"):
            np.cumsum(_BYTE[part] * up[: len(part)], out=sums[1:])
            grams = mix((sums[k:] - sums[:-k]) * down[: len(part) - k + 1])
        low = _U((1 << 21) - 1)
        at = _sliding_min((grams & ~low) | np.arange(len(grams), dtype=_U), least - k + 1)
        ends = offsets[(offsets > a) & (offsets < b)] - a
        inside = np.zeros(len(at) + 1, np.int64)
        np.add.at(inside, np.minimum(np.maximum(ends - least + 1, np.r_[0, ends[:-1]] if len(ends) else ends), len(at)), 1)
        np.add.at(inside, np.minimum(ends, len(at)), -1)
        start = np.flatnonzero(np.cumsum(inside[:-1]) == 0)
        anchor = (at[start] & low).astype(np.int64)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]]) if len(anchor) else np.empty(0, np.int64)
        runs = np.diff(np.append(first, len(anchor)))
        begin = start[first]
        with np.errstate(over="ignore"):
            content = (sums[begin + runs + least - 1] - sums[begin]) * down[begin]
            content = mix(content + runs.astype(_U) * _U(0x9E3779B97F4A7C15))
        return grams[anchor[first]], content, begin + a, runs


def _distinct(hashes: np.ndarray, doc: np.ndarray):
    """Sorted order, starts of equal runs in it, and whether a run has more than one document."""
    order = np.argsort(hashes, kind="stable")
    sorted_ = hashes[order]
    first = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]]) if len(order) else np.empty(0, np.int64)
    if not len(first):
        return order, first, np.empty(0, bool)
    docs = doc[order]
    return order, first, np.minimum.reduceat(docs, first) != np.maximum.reduceat(docs, first)


def _tail(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The 40 bits after the bucket's."""
    return (hashes << _U(bits)) >> _U(24)


def _unit_anchors(table: pa.Table, least: int):
    unit = Unit(table)
    anchors = Anchors(unit.texts.data, unit.texts.offsets, least)
    keep = unit.known[anchors.row]
    for name in ("hash", "content", "start", "runs", "row"):
        setattr(anchors, name, getattr(anchors, name)[keep])
    return unit, anchors, *_distinct(anchors.hash, unit.doc[anchors.row])


_MARKS = "unit long, bucket int, hashes binary, many binary"


def _send_anchors(least: int, bits: int):
    def run(table: pa.Table) -> pa.Table:
        unit, anchors, order, first, many = _unit_anchors(table, least)
        hashes = anchors.hash[order[first]]
        out = {"unit": [], "bucket": [], "hashes": [], "many": []}
        for bucket, a, b in bucket_ranges(hashes, bits):
            tail = _tail(hashes[a:b], bits)
            out["unit"].append(unit.number)
            out["bucket"].append(bucket)
            out["hashes"].append((tail >> _U(8)).astype("<u4").tobytes() + (tail & _U(255)).astype(np.uint8).tobytes())
            out["many"].append(np.packbits(many[a:b]).tobytes())
        return pa.table(out, pa.schema([("unit", pa.int64()), ("bucket", pa.int32()), ("hashes", pa.binary()),
                                        ("many", pa.binary())]))

    return run


def _answer_anchors(table: pa.Table) -> pa.Table:
    """Per unit and bucket: which of the sent hashes several documents have."""
    table = table.combine_chunks()
    parts = [x.as_buffer() for x in table["hashes"]]
    sizes = [len(x) // 5 for x in parts]
    values = joined([(np.frombuffer(x, "<u4", n).astype(_U) << _U(8)) | np.frombuffer(x, np.uint8, n, 4 * n)
                     for x, n in zip(parts, sizes)], _U)
    many = joined([np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=n).astype(bool)
                   for x, n in zip(table["many"], sizes)], bool)
    order = np.argsort(values, kind="stable")
    same = values[order[1:]] == values[order[:-1]]
    many[order[1:][same]] = True
    many[order[:-1][same]] = True
    ends = np.cumsum(sizes)
    back = [np.packbits(many[e - n : e]).tobytes() for e, n in zip(ends, sizes)]
    return pa.table([table["unit"], table["bucket"], pa.array(back, pa.binary())], ["unit", "bucket", "many"])


class _Strings:
    """The distinct strings of a unit in one bucket, around anchors that several documents have: ``heads`` (places of their
    first occurrence in the smallest document), and all occurrences with the string of each."""

    def __init__(self, unit: Unit, anchors: Anchors, place: np.ndarray):
        doc = unit.doc[anchors.row[place]]
        by = np.lexsort((anchors.start[place], doc, anchors.content[place]))
        self.place, doc = place[by], doc[by]
        content = anchors.content[self.place]
        new = np.r_[True, content[1:] != content[:-1]]
        self.of = np.cumsum(new) - 1
        self.heads, self.content, self.doc = self.place[new], content[new], doc[new]
        self.later = doc > self.doc[self.of]


def _told(right: pa.Table, column: str) -> dict:
    """A column's packed arrays by bucket."""
    return {b: x for b, x in zip(right["bucket"].to_pylist(), right[column]) if x.is_valid}


def _strings(unit, anchors, order, first, many: dict, bits: int):
    """(bucket, strings) of the anchors that several documents have."""
    hashes = anchors.hash[order[first]]
    size = np.diff(np.append(first, len(order)))
    for bucket, a, b in bucket_ranges(hashes, bits):
        if bucket in many:
            marked = np.unpackbits(np.frombuffer(many[bucket].as_buffer(), np.uint8), count=b - a).astype(bool)
            take = np.repeat(marked, size[a:b])
            place = order[first[a] : first[a] + len(take)][take]
            if len(place):
                yield bucket, _Strings(unit, anchors, place)


_ENTRIES = "unit long, bucket int, anchor binary, content binary, doc binary"


def _send_entries(least: int, bits: int):
    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        out = {n: [] for n in schema_of(_ENTRIES).names}
        if len(left) and len(right):
            unit, anchors, order, first, _ = _unit_anchors(left, least)
            for bucket, s in _strings(unit, anchors, order, first, _told(right, "many"), bits):
                out["unit"].append(unit.number)
                out["bucket"].append(bucket)
                out["anchor"].append(_tail(anchors.hash[s.heads], bits).astype("<u4").tobytes())
                out["content"].append(s.content.astype("<u8").tobytes())
                out["doc"].append(s.doc.astype("<i8").tobytes())
        return pa.table(out, schema_of(_ENTRIES))

    return run


def _answer_entries(table: pa.Table) -> pa.Table:
    """Per unit and bucket, for each string: 1 if a smaller document has all of it, 2 if it is the first of its kind but
    others share its anchor, else 0."""
    table = table.combine_chunks()
    lists = arrays(table["doc"], "<i8")
    anchor, content = joined(arrays(table["anchor"], "<u4"), "<u4"), joined(arrays(table["content"], "<u8"), "<u8")
    doc = joined(lists, "<i8")
    order = np.lexsort((doc, content, anchor))
    alike = np.r_[False, anchor[order][1:] == anchor[order][:-1]]
    new = np.r_[True, content[order][1:] != content[order][:-1]] | ~alike
    head = order[new]
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    shared = np.r_[False, anchor[head][1:] == anchor[head][:-1]]
    shared |= np.r_[shared[1:], False]
    codes = np.where(doc > doc[head][kind], 1, np.where(shared[kind], 2, 0)).astype(np.uint8)
    ends = np.cumsum([len(x) for x in lists])
    back = [codes[e - len(x) : e].tobytes() for e, x in zip(ends, lists)]
    return pa.table([table["unit"], table["bucket"], pa.array(back, pa.binary())], ["unit", "bucket", "codes"])


_PARTS = "unit long, bucket int, row binary, start binary, mask binary, doc binary, runs binary, bytes binary, of binary"


def _send_strings(least: int, bits: int):
    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        out = {n: [] for n in schema_of(_PARTS).names}
        if len(left) and len(right):
            unit, anchors, order, first, _ = _unit_anchors(left, least)
            data, offsets = unit.texts.data, unit.texts.offsets
            told = _told(right, "codes")
            for bucket, s in _strings(unit, anchors, order, first, _told(right, "many"), bits):
                codes = np.frombuffer(told[bucket].as_buffer(), np.uint8)
                row = anchors.row[s.place]
                start, runs = anchors.start[s.place] - offsets[row], anchors.runs[s.place]
                gone = s.later | (codes[s.of] == 1)
                open_ = ~gone & (codes[s.of] == 2)
                if gone.any():
                    mask = (np.int64(1) << runs[gone]) - 1
                    _append(out, unit=unit.number, bucket=bucket, row=row[gone].astype("<u4"),
                            start=start[gone].astype("<u4"), mask=mask.astype("<u8"))
                if open_.any():
                    ask = np.flatnonzero(codes == 2)
                    begin, length = anchors.start[s.heads[ask]], anchors.runs[s.heads[ask]] + least - 1
                    ends = np.cumsum(length)
                    at = np.arange(ends[-1]) + np.repeat(begin - ends + length, length)
                    _append(out, unit=unit.number, bucket=bucket, row=row[open_].astype("<u4"),
                            start=start[open_].astype("<u4"), doc=s.doc[ask].astype("<i8"),
                            runs=anchors.runs[s.heads[ask]].astype(np.uint8), bytes=data[at],
                            of=np.searchsorted(ask, s.of[open_]).astype("<u4"))
        return pa.table(out, schema_of(_PARTS))

    return run


def _append(out: dict, **values) -> None:
    for name, column in out.items():
        value = values.get(name)
        column.append(value.tobytes() if isinstance(value, np.ndarray) else value)


_SPANS = "unit long, row binary, start binary, mask binary"


def _answer_strings(least: int):
    """Masks of the runs that a smaller document holds; masks that units know already pass through."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        out = {n: [] for n in schema_of(_SPANS).names}
        asked = table["bytes"].is_valid().to_numpy()
        for i in np.flatnonzero(~asked):
            for name, column in out.items():
                column.append(table[name][i].as_py())
        if asked.any():
            mine = table.filter(pa.array(asked))
            lists = arrays(mine["runs"], np.uint8)
            runs, doc = joined(lists, np.uint8).astype(np.int64), joined(arrays(mine["doc"], "<i8"), "<i8")
            length = runs + least - 1
            begin = np.cumsum(length) - length
            with tempfile.TemporaryDirectory() as folder:
                built = bwt.build(joined(arrays(mine["bytes"], np.uint8), np.uint8), begin, length, folder)
                string, size, low = bwt.least_owner(built, least, doc)
            covered = low < doc[string]
            bit = (length[string] - size)[covered]
            mask = np.bincount(string[covered], np.exp2(bit), minlength=len(runs)).astype(np.int64)
            done = 0
            for i, part in enumerate(lists):
                of = np.frombuffer(mine["of"][i].as_buffer(), "<u4")
                found = mask[done : done + len(part)][of]
                done += len(part)
                keep = found > 0
                if keep.any():
                    _append(out, unit=mine["unit"][i].as_py(), mask=found[keep].astype("<u8"),
                            row=np.frombuffer(mine["row"][i].as_buffer(), "<u4")[keep],
                            start=np.frombuffer(mine["start"][i].as_buffer(), "<u4")[keep])
        return pa.table(out, schema_of(_SPANS))

    return run


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(least: int, with_text: bool):
    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        unit = Unit(left)
        data, offsets = unit.texts.data, unit.texts.offsets
        change = np.zeros(len(data) + 1, np.int32)
        row, start = joined(arrays(right["row"], "<u4"), "<u4"), joined(arrays(right["start"], "<u4"), "<u4")
        mask = joined(arrays(right["mask"], "<u8"), "<u8")
        at = offsets[row.astype(np.int64)] + start
        for bit in range(int(mask.max()).bit_length() if len(mask) else 0):
            here = at[(mask >> np.uint64(bit)) & np.uint64(1) > 0] + bit
            np.add.at(change, here, 1)
            np.add.at(change, here + least, -1)
        gone = np.cumsum(change[:-1]) > 0
        rises = gone.copy()
        rises[1:] &= ~gone[:-1]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        rises[edges] = gone[edges]
        out = {n.split()[0]: [] for n in _RESULT.split(", ")} | ({"text": []} if with_text else {})
        for i in range(len(offsets) - 1):
            a, b = offsets[i], offsets[i + 1]
            kept = data[a:b][~gone[a:b]].tobytes()
            out["doc_id"].append(unit.ids[i].as_py())
            out["n_bytes"].append(int(b - a))
            out["n_removed"].append(int(b - a) - len(kept))
            out["n_spans"].append(int(rises[a:b].sum()))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if with_text:
                out["text"].append(kept.decode("utf-8", "replace"))
        fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                  ("kept_sha256", pa.string())] + ([("text", pa.string())] if with_text else [])
        return pa.table(out, pa.schema(fields))

    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 50,
                   with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row, and with ``with_text`` the text that is left (bytes cut
    inside a character show as the replacement character).

    A null text is empty. Rows with a null doc_id lose nothing and take nothing from others. Rows that share a doc_id take
    nothing from each other. Other columns are not read. ``least`` is at most 63.
    """
    if not ANCHOR < least < 64:
        raise ValueError(f"least must lie between {ANCHOR + 1} and 63")
    rows, _, bits = unit_frame(docs, key, text)
    sent = rows.groupBy("unit").applyInArrow(_send_anchors(least, bits), _MARKS)
    answers = sent.groupBy("bucket").applyInArrow(_answer_anchors, "unit long, bucket int, many binary")
    marks = answers.withColumnRenamed("unit", "u").repartition("u")
    entries = rows.groupBy("unit").cogroup(marks.groupBy("u")).applyInArrow(_send_entries(least, bits), _ENTRIES)
    codes = entries.groupBy("bucket").applyInArrow(_answer_entries, "unit long, bucket int, codes binary")
    told = marks.unionByName(codes.withColumnRenamed("unit", "u"), allowMissingColumns=True)
    strings = rows.groupBy("unit").cogroup(told.groupBy("u")).applyInArrow(_send_strings(least, bits), _PARTS)
    spans = strings.groupBy("bucket").applyInArrow(_answer_strings(least), _SPANS)
    spans = spans.withColumnRenamed("unit", "u").groupBy("u")
    result = _RESULT + (", text string" if with_text else "")
    return rows.groupBy("unit").cogroup(spans).applyInArrow(_cut(least, with_text), result)
