"""Records of delimited files whose quoted values hold line breaks, with every file still split over tasks.

A split holds whole lines, so it starts either at a record or inside a quoted value. Which of the two depends on all splits
before it, but each line, and so each split, is a function of that one bit: started outside quotes it ends inside or
outside, and the same started inside. So

1. one pass finds each split's function, composed from its lines in order;
2. a prefix scan over the splits of a file, one row each, gives the state every split starts in;
3. a second pass cuts each split into records from there. A record that a split's edge cuts apart leaves a piece in each of
   the splits it touches; only these pieces are shuffled and put together.

Only quotes decide, and they are read as the parser reads them: a quote opens a value at the start of a field only, a
doubled quote stands for one, and what follows a closing quote is taken up to the next separator.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermill.functions.text import csv_options
from ledgermill.names import quoted

_HEADER_LINES = 64


def _patterns(sep: str) -> tuple[str, str]:
    """Patterns of a line that leaves a quoted value open: begun outside quotes, and begun inside.

    All loops are possessive: they match as a parser walks, without going back, and need no stack for long lines.
    """
    if len(sep) != 1:
        raise NotImplementedError("Line breaks in quotes need a separator of one character")
    s = re.escape(sep)
    body = '(?:[^"]++|"")*+'
    field = f'(?:"{body}"[^{s}]*+|[^"{s}][^{s}]*+|){s}'
    opened = f'(?:{field})*+"{body}\\z'
    return f"\\A{opened}", f'\\A{body}(?:\\z|"[^{s}]*+{s}{opened})'


def _lines(spark: SparkSession, paths: str | Sequence[str], sep: str) -> DataFrame:
    """(file, at, line, opens, stays): lines with their file and split, whether one begun outside quotes ends inside, and
    whether one begun inside ends inside."""
    outside, inside = _patterns(sep)
    line = F.col("value")
    plain = ~F.contains(line, F.lit('"'))
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("at"),
        line.alias("line"),
        F.when(plain, F.lit(False)).otherwise(line.rlike(outside)).alias("opens"),
        F.when(plain, F.lit(True)).otherwise(line.rlike(inside)).alias("stays"),
    )


def has_broken_records(spark: SparkSession, paths: str | Sequence[str], sep: str = ",") -> bool:
    """Whether some line ends inside quotes. While none does, every line is a record. One pass, nothing shuffled."""
    return bool(_lines(spark, paths, sep).agg(F.bool_or("opens")).first()[0])


def _after(opens: np.ndarray, stays: np.ndarray, state: bool) -> np.ndarray:
    """State after each line. A line either leaves the state, flips it, or sets it whatever it was."""
    sets, flips = opens == stays, opens & ~stays
    last = np.maximum.accumulate(np.where(sets, np.arange(len(opens)), -1))
    flipped = np.concatenate(([0], np.cumsum(flips)))
    base = np.where(last >= 0, opens[last], state)
    since = flipped[1:] - np.where(last >= 0, flipped[last + 1], 0)
    return base ^ (since % 2 == 1)


def _splits(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """Runs of lines of one split."""
    file, at = batch.column("file").to_numpy(), batch.column("at").to_numpy()
    edges = np.flatnonzero((file[1:] != file[:-1]) | (at[1:] != at[:-1])) + 1
    cuts = [0, *edges.tolist(), len(batch)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield (int(file[a]), int(at[a])), batch.slice(a, b - a)


def _flags(part: pa.RecordBatch, name: str) -> np.ndarray:
    return part.column(name).to_numpy(zero_copy_only=False)


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, at, opens, stays) of whole splits."""
    found: dict[tuple[int, int], tuple[bool, bool]] = {}
    for batch in batches:
        for split, part in _splits(batch):
            opens, stays = _flags(part, "opens"), _flags(part, "stays")
            outside, inside = found.get(split, (False, True))
            found[split] = bool(_after(opens, stays, outside)[-1]), bool(_after(opens, stays, inside)[-1])
    yield pa.record_batch({
        "file": pa.array([f for f, _ in found], pa.int64()), "at": pa.array([a for _, a in found], pa.int64()),
        "opens": pa.array([o for o, _ in found.values()], pa.bool_()), "stays": pa.array([s for _, s in found.values()], pa.bool_()),
    })


def _begun_inside(lines: DataFrame) -> frozenset[tuple[int, int]]:
    """The splits that begin inside quotes. The driver holds no more than its list of splits."""
    splits = lines.select("file", "at", "opens", "stays").mapInArrow(_functions, "file long, at long, opens boolean, stays boolean")
    order = Window.partitionBy("file").orderBy("at")
    flips = (F.col("opens") & ~F.col("stays")).cast("int")
    splits = splits.withColumn("flips", F.sum(flips).over(order))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("set", F.last(F.when(F.col("opens") == F.col("stays"), F.struct("opens", "flips")), True).over(before))
    splits = splits.withColumn("before", F.coalesce(F.lag("flips").over(order), F.lit(0)))
    since = F.col("before") - F.coalesce(F.col("set.flips"), F.lit(0))
    inside = F.coalesce(F.col("set.opens"), F.lit(False)) != (since % 2 == 1)
    return frozenset((r["file"], r["at"]) for r in splits.where(inside).select("file", "at").collect())


#: What a row of the second pass is: a whole record, the rest of one begun in an earlier split, or the start of one that
#: goes on in a later split.
_WHOLE, _REST, _START = 0, 1, 2


class _Cutter:
    """Cuts one split into records, batch by batch."""

    def __init__(self, split: tuple[int, int], inside: bool):
        self.split, self.state, self.rest = split, inside, inside
        self.open: list[str] = []  # lines of a record that is not at its end yet
        self.headed = split[1] != 0  # the first record of a file is its header

    def _rows(self, lines: pa.Array, kinds: list[int] | None = None, headers: list[bool] | None = None) -> pa.RecordBatch:
        n = len(lines)
        return pa.record_batch({
            "file": pa.array(np.full(n, self.split[0])), "at": pa.array(np.full(n, self.split[1])), "record": lines,
            "kind": pa.array(kinds or [_WHOLE] * n, pa.int32()), "header": pa.array(headers or [False] * n, pa.bool_()),
        })

    def cut(self, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        after = _after(_flags(part, "opens"), _flags(part, "stays"), self.state)
        before = np.concatenate(([self.state], after[:-1]))
        # lines that are a record of their own go as they are; a Python loop sees only the others, and a file's beginning
        alone = ~before & ~after if self.headed else np.zeros(len(after), bool)
        if alone.any():
            yield self._rows(part.column("line").filter(pa.array(alone)))
        found: list[str] = []
        kinds: list[int] = []
        headers: list[bool] = []
        rest = np.flatnonzero(~alone)
        for line, was, inside in zip(part.column("line").take(pa.array(rest)).to_pylist(), before[rest].tolist(), after[rest].tolist()):
            if was or inside:
                self.open.append(line)
            if not inside:
                text = "\n".join(self.open) if was else line
                found.append(text)
                kinds.append(_REST if was and self.rest else _WHOLE)
                headers.append(not self.headed and bool(text.strip(" \t\r")))
                self.headed |= headers[-1]
                self.open, self.rest = [], False
        self.state = bool(after[-1])
        if found:
            yield self._rows(pa.array(found, pa.string()), kinds, headers)

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.open:
            yield self._rows(pa.array(["\n".join(self.open)]), [_REST if self.rest else _START], [not self.headed])


def _cut(inside: frozenset[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = None
        for batch in batches:
            for split, part in _splits(batch):
                if cutter is None or cutter.split != split:
                    if cutter is not None:
                        yield from cutter.end()
                    cutter = _Cutter(split, split in inside)
                yield from cutter.cut(part)
        if cutter is not None:
            yield from cutter.end()

    return run


def records(spark: SparkSession, paths: str | Sequence[str], sep: str = ",") -> DataFrame:
    """(record, header): the records of delimited files as text, and whether one is the header of its file. Line ends are
    LF or CRLF; blank lines between records give none. A value left open at the end of a file ends there."""
    lines = _lines(spark, paths, sep)
    inside = _begun_inside(lines)
    rows = lines.mapInArrow(_cut(inside), "file long, at long, record string, kind int, header boolean")
    if inside:
        # the pieces of a record: the start that was last before them, and them, in the order of the splits
        pieces = rows.where(F.col("kind") != _WHOLE)
        order = Window.partitionBy("file").orderBy("at", "kind")
        pieces = pieces.withColumn("run", F.sum((F.col("kind") == _START).cast("int")).over(order))
        mended = pieces.groupBy("file", "run").agg(F.sort_array(F.collect_list(F.struct("at", "record"))).alias("p"), F.bool_or("header").alias("header"))
        mended = mended.select(F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"), "header")
        rows = rows.where(F.col("kind") == _WHOLE).select("record", "header").unionByName(mended)
    return rows.select(F.regexp_replace("record", r"\r\z", "").alias("record"), "header").where(F.trim("record") != "")


def _header(lines: DataFrame, rows: DataFrame) -> str:
    """The first record of a file: by a look at first lines, or among all records where it is cut by a split."""
    seen = lines.where("at = 0").limit(_HEADER_LINES).collect()
    state, held = False, []
    for r in seen:
        if r["file"] != seen[0]["file"]:
            break
        if not state and not held and not r["line"].strip(" \t\r"):
            continue
        held.append(r["line"])
        state = r["stays"] if state else r["opens"]
        if not state:
            return "\n".join(held).removesuffix("\r")
    found = rows.where("header").select("record").limit(1).collect()
    return found[0]["record"] if found else ""


def _names(header: Sequence[str]) -> list[str]:
    """Distinct names: an unnamed column is called after its place, one whose name is taken gets its place added."""
    out: list[str] = []
    for i, name in enumerate(header):
        name = name or f"_c{i}"
        out.append(f"{name}{i}" if name in out or list(header).count(name) > 1 else name)
    return out


def parse(record: Column, names: Sequence[str], sep: str) -> Column:
    """One record as a struct of text columns; values that are missing at the end are null."""
    options = csv_options(sep, multiline=True)
    options.pop("header")
    return F.from_csv(record, ", ".join(f"{quoted(n)} string" for n in names), options)


def scan_records(spark: SparkSession, paths: str | Sequence[str], sep: str = ",") -> DataFrame:
    """Text columns of delimited files with a header, all files with the same one, whatever their values hold."""
    rows = records(spark, paths, sep)
    header = _header(_lines(spark, paths, sep), rows)
    names = _names(next(csv.reader(io.StringIO(header, newline=""), delimiter=sep), []))
    parsed = rows.where(~F.col("header")).select(parse(F.col("record"), names, sep).alias("r"))
    return parsed.select(*[F.col(f"r.{quoted(n)}") for n in names])


def text_columns(spark: SparkSession, paths: str | Sequence[str], sep: str = ",", multiline: bool | None = None) -> DataFrame:
    """Foreign delimited files with a header, as text columns.

    ``multiline`` says whether quoted values hold line breaks. By default one pass over the files finds out; while none
    does, lines are records and Spark's own reader takes them.
    """
    if multiline is None:
        multiline = len(sep) == 1 and has_broken_records(spark, paths, sep)
    return scan_records(spark, paths, sep) if multiline else spark.read.options(**csv_options(sep)).csv(paths)
