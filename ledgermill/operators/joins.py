"""Null-safe equi-joins, join chains with a row guard, anti/semi joins by key, and coverage gaps.

Keys compare null-safe: a null key matches a null key, as in an in-memory frame merge. Spark plans ``<=>`` as a hash or
sort-merge join on ``coalesce``/``isnull`` pairs, so this costs no nested loop.

Hot keys. Adaptive execution splits a hot partition of either side of an inner join, but only of the kept side of an
outer or anti join. So a join that could meet a hot key on a side that cannot be split is written as
``inner`` + ``anti`` (:func:`null_safe_join` with ``split_hot``), and every anti or semi join first reduces the key side
to distinct keys, which collapses a hot key before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgermill.names import col, quoted, require_columns
from ledgermill.scratch import write_scratch

JOIN_TYPES = ("inner", "left", "right", "outer")


def _comparable(a: T.DataType, b: T.DataType) -> bool:
    if a == b:
        return True
    numeric = isinstance(a, T.NumericType) and isinstance(b, T.NumericType)
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return numeric or (isinstance(a, times) and isinstance(b, times))


def _on(keys: Sequence[str], nulls_match: bool = True) -> Column:
    """Equality of the key columns of the frames aliased ``l`` and ``r``."""

    def same(k: str) -> Column:
        a, b = F.col(f"l.{quoted(k)}"), F.col(f"r.{quoted(k)}")
        return a.eqNullSafe(b) if nulls_match else a == b

    return reduce(lambda x, y: x & y, [same(k) for k in keys])


def _check_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> None:
    require_columns(left, keys, "the left frame")
    require_columns(right, keys, "the right frame")
    for k in keys:
        a, b = left.schema[k].dataType, right.schema[k].dataType
        if not _comparable(a, b):
            raise ValueError(f"Join key {k!r} is {a.simpleString()} on one side and {b.simpleString()} on the other")


def anti_by_keys(
    df: DataFrame, other: DataFrame, keys: Sequence[str], distinct: bool = True, nulls_match: bool = True
) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``other`` (null-safe).

    ``distinct=False`` skips the reduction to distinct keys when ``other`` is known to hold each key once, and
    ``nulls_match=False`` compares by plain equality when one side is known to have no null in its keys.
    """
    return _by_keys(df, other, keys, "left_anti", distinct, nulls_match)


def semi_by_keys(
    df: DataFrame, other: DataFrame, keys: Sequence[str], distinct: bool = True, nulls_match: bool = True
) -> DataFrame:
    """Rows of ``df`` whose key is present in ``other`` (null-safe); see :func:`anti_by_keys`."""
    return _by_keys(df, other, keys, "left_semi", distinct, nulls_match)


def _by_keys(
    df: DataFrame, other: DataFrame, keys: Sequence[str], how: str, distinct: bool, nulls_match: bool
) -> DataFrame:
    _check_keys(df, other, keys)
    right = other.select(*[col(k) for k in keys])
    if distinct:
        right = right.distinct()
    return df.alias("l").join(right.alias("r"), _on(keys, nulls_match), how)


def null_safe_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    split_hot: bool = False,
    nulls_match: bool = True,
) -> DataFrame:
    """Equi-join on ``keys``: key columns once, other columns both frames have as ``name_x`` / ``name_y``.

    Column order is the left frame's, then the right frame's other columns. ``split_hot`` writes a left or right join
    as inner + anti, for an other side that may repeat a key very often; a full outer join is always written so.
    ``nulls_match=False`` says that one side is known to have no null in the keys, so plain equality gives the same rows
    with cheaper keys.
    """
    if how not in JOIN_TYPES:
        raise ValueError(f"Unknown join type {how!r}; use one of {JOIN_TYPES}")
    _check_keys(left, right, keys)
    shared = {c for c in left.columns if c in right.columns and c not in keys}
    right_rest = [c for c in right.columns if c not in keys]
    left_name = {c: f"{c}_x" if c in shared else c for c in left.columns}
    right_name = {c: f"{c}_y" if c in shared else c for c in right_rest}
    on = _on(keys, nulls_match)

    def joined(kind: str, key_side: str) -> DataFrame:
        out = [
            F.col(f"{key_side if c in keys else 'l'}.{quoted(c)}").alias(left_name[c]) for c in left.columns
        ] + [F.col(f"r.{quoted(c)}").alias(right_name[c]) for c in right_rest]
        return left.alias("l").join(right.alias("r"), on, kind).select(*out)

    def left_only() -> DataFrame:
        rest = anti_by_keys(left, right, keys)
        return rest.select(
            *[col(c).alias(left_name[c]) for c in left.columns],
            *[F.lit(None).cast(right.schema[c].dataType).alias(right_name[c]) for c in right_rest],
        )

    def right_only() -> DataFrame:
        rest = anti_by_keys(right, left, keys)
        return rest.select(
            *[
                (col(c) if c in keys else F.lit(None).cast(left.schema[c].dataType)).alias(left_name[c])
                for c in left.columns
            ],
            *[col(c).alias(right_name[c]) for c in right_rest],
        )

    if how == "inner":
        return joined("inner", "l")
    if how == "left":
        return joined("inner", "l").unionByName(left_only()) if split_hot else joined("left", "l")
    if how == "right":
        return joined("inner", "r").unionByName(right_only()) if split_hot else joined("right", "r")
    return joined("inner", "l").unionByName(left_only()).unionByName(right_only())


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once with their row count ``n`` (nulls count as equal)."""
    require_columns(df, keys)
    return df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def has_repeated_keys(df: DataFrame, keys: Sequence[str]) -> bool:
    """True when some key occurs more than once. Runs one job over the key columns."""
    return not repeated_keys(df, keys).isEmpty()


def key_profiles(frames: Sequence[tuple[DataFrame, Sequence[str]]]) -> list[tuple[bool, bool]]:
    """For each ``(frame, keys)``: whether some key repeats, and whether some key has a null.

    One job over the key columns of all frames, which Spark reads side by side.
    """
    parts = []
    for i, (df, keys) in enumerate(frames):
        require_columns(df, keys, "the joined frame")
        any_null = reduce(lambda x, y: x | y, [col(k).isNull() for k in keys])
        counts = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(
            counts.agg(F.max("_n").alias("most"), F.bool_or(any_null).alias("null")).select(F.lit(i).alias("i"), "*")
        )
    if not parts:
        return []
    rows = reduce(DataFrame.unionByName, parts).collect()
    return [((r["most"] or 0) > 1, bool(r["null"])) for r in sorted(rows, key=lambda r: r["i"])]


def join_row_counts(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """One row ``(base_rows, joined_rows)`` for a join, without producing the joined rows.

    Both sides are first counted per key, so a hot key costs one row per side however often it repeats.
    """
    _check_keys(left, right, keys)
    key_columns = [col(k) for k in keys]
    a = left.groupBy(*key_columns).agg(F.count(F.lit(1)).alias("nl")).withColumn("nr", F.lit(0).cast("bigint"))
    b = right.groupBy(*key_columns).agg(F.count(F.lit(1)).alias("nr")).withColumn("nl", F.lit(0).cast("bigint"))
    per_key = a.unionByName(b).groupBy(*key_columns).agg(F.sum("nl").alias("nl"), F.sum("nr").alias("nr"))
    nl, nr, one = F.col("nl"), F.col("nr"), F.lit(1).cast("bigint")
    rows = {
        "inner": nl * nr,
        "left": nl * F.greatest(nr, one),
        "right": F.greatest(nl, one) * nr,
        "outer": F.when((nl == 0) | (nr == 0), nl + nr).otherwise(nl * nr),
    }[how]
    zero = F.lit(0).cast("bigint")
    return per_key.agg(
        F.coalesce(F.sum(nl), zero).alias("base_rows"), F.coalesce(F.sum(rows), zero).alias("joined_rows")
    )


def guard_report(base: DataFrame, joined: DataFrame) -> DataFrame:
    """One row ``(base_rows, joined_rows)`` counting two frames in one job."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    rows = base.select(one.alias("b"), zero.alias("j")).unionByName(joined.select(zero.alias("b"), one.alias("j")))
    return rows.agg(
        F.coalesce(F.sum("b"), zero).alias("base_rows"), F.coalesce(F.sum("j"), zero).alias("joined_rows")
    )


def join_chain(
    base: DataFrame,
    steps: Sequence[tuple[DataFrame, Sequence[str] | None, str]],
    row_guard: bool = True,
) -> DataFrame:
    """Join ``base`` with each ``(frame, keys, how)`` in order; a step without keys is skipped.

    Runs one job over the keys of the joined frames to see which repeat a key or have a null one. A chain of left joins
    onto frames that repeat none keeps the base rows by construction, so the guard needs no join to be run;
    otherwise it compares exact counts and raises ``ValueError`` when the chain changed the number of rows. The joins before
    the last are then written to the scratch folder, counted there by key, and go on from there, so the chain runs once.
    A frame without null keys is joined by plain equality.
    """
    steps = [(frame, list(keys), how) for frame, keys, how in steps if keys]
    for _, _, how in steps:
        if how not in JOIN_TYPES:
            raise ValueError(f"Unknown join type {how!r}; use one of {JOIN_TYPES}")
    out, before_last = base, base
    keeps_rows = True
    profiles = key_profiles([(frame, keys) for frame, keys, _ in steps])
    for (frame, keys, how), (repeated, has_null) in zip(steps, profiles):
        keeps_rows = keeps_rows and how == "left" and not repeated
        if row_guard and not keeps_rows and out is not base and frame is steps[-1][0]:
            out = write_scratch(out, "joined")
        before_last = out
        # a right join keeps the other side whole, so there it is the left frame that could be hot
        split = repeated if how == "left" else how == "right"
        out = null_safe_join(out, frame, keys, how, split, nulls_match=has_null)
    if row_guard and steps and not keeps_rows:
        frame, keys, how = steps[-1]
        joined_rows = join_row_counts(before_last, frame, keys, how).first()["joined_rows"]
        base_rows = base.count()
        if joined_rows != base_rows:
            raise ValueError(f"Joining changed the row count from {base_rows} to {joined_rows}")
    return out


def in_codes(
    df: DataFrame, codes: DataFrame | Sequence[object], column: str, code_column: str | None = None
) -> DataFrame:
    """Rows whose code is in a code table or an inline list (null never is).

    A list becomes a filter, which reaches the file scan; a table is a semi-join that Spark broadcasts when it is small.
    """
    require_columns(df, [column])
    if not isinstance(codes, DataFrame):
        return df.filter(col(column).isin(list(codes)))
    code_column = code_column or codes.columns[0]
    right = codes.select(col(code_column).alias("_code")).distinct()
    return df.join(right, col(column) == F.col("_code"), "left_semi")


def request_grid(codes: DataFrame, axis: DataFrame | Column, name: str) -> DataFrame:
    """Every code row with every axis value.

    ``axis`` is an array column (:func:`ledgermill.functions.scalar.each_day`) or a one-column table. An array is
    exploded inside each row. A table of any length is dealt over buckets and each code row visits every bucket once, an
    equi-join that spreads evenly whatever the codes are.
    """
    if isinstance(axis, Column):
        return codes.withColumn(name, F.explode(axis))
    buckets = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values_in = axis.select(col(axis.columns[0]).alias(name)).distinct().filter(col(name).isNotNull())
    values_in = values_in.withColumn("_b", F.pmod(F.xxhash64(col(name)), F.lit(buckets)))
    every_bucket = F.sequence(F.lit(0).cast("bigint"), F.lit(buckets - 1).cast("bigint"))
    visits = codes.withColumn("_b", F.explode(every_bucket))
    return visits.join(values_in, "_b").drop("_b")


#: Axis values are numbered by tasks of at most about this many.
_NUMBERED_ROWS = 1 << 16
_WORD_BITS = 64


def numbered_axis(axis: DataFrame) -> tuple[DataFrame, int]:
    """(value, number) of the distinct values of a one-column table, numbered from 0 without gaps, and how many there are.

    Values are dealt to slices by hash, counted by slice, and numbered within each from the sum of the counts before it.
    """
    values = axis.select(col(axis.columns[0]).alias("value")).filter("value is not null").distinct()
    values = write_scratch(values, "axis")
    n = values.count()
    values = values.withColumn("slice", F.pmod(F.xxhash64("value"), F.lit(n // _NUMBERED_ROWS + 1)))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = values.groupBy("slice").agg(F.count(F.lit(1)).alias("held"))  # one row per slice
    counts = counts.select("slice", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("slice").orderBy("value")) - 1
    values = values.withColumn("inside", inside).join(counts, "slice")
    return values.select("value", (F.col("base") + F.col("inside")).alias("number")), n


def _as_landed(value: Column, given: T.DataType, kind: T.DataType) -> Column:
    """An axis value in the landed column's type; null when that type cannot hold it, so that nothing landed equals it."""
    cast = value.try_cast(kind)
    return value if given == kind else F.when(cast.try_cast(given) == value, cast)


def coverage_gaps(
    codes: DataFrame, axis: DataFrame | Column, landed: DataFrame, code: str, name: str
) -> DataFrame:
    """The ``(code, axis value)`` pairs that the landed table does not hold.

    The axis must be comparable with the landed column, otherwise an error is raised. Gaps have the axis's type, but the
    landed type where both are whole numbers (one that does not fit is an error). A value that the landed type cannot hold
    exactly (1.5 in a whole-number column, a time of day in a date column) is a gap of every code. Null axis values are
    left out; a null code is a code.

    With an array axis the landed table is reduced to one row per code with the set of its axis values (never longer than
    the axis), and only the missing values are exploded. The values of an axis table are numbered once; what a code has
    landed becomes bits of 64-bit words, combined before and after the one exchange, in which every wanted code takes
    part with empty words. Only the zero bits that remain become rows, so codes and axis are never paired as rows.
    """
    require_columns(landed, [code, name], "the landed table")
    kind = landed.schema[name].dataType
    if isinstance(axis, Column):
        wanted = codes.select(col(code)).distinct()
        present = (
            landed.select(col(code), col(name))
            .distinct()
            .withColumn("_wanted", F.array_contains(axis, col(name)))
            .filter("_wanted")
            .groupBy(col(code))
            .agg(F.collect_set(col(name)).alias("_present"))
        )
        none = F.array().cast(T.ArrayType(kind))
        return null_safe_join(wanted, present, [code], "left").select(
            col(code), F.explode(F.array_except(axis, F.coalesce(F.col("_present"), none))).alias(name)
        )
    given = axis.schema[axis.columns[0]].dataType
    if not _comparable(given, kind):
        raise ValueError(f"The axis is {given.simpleString()}, but {name!r} of the landed table is {kind.simpleString()}")
    code_kinds = (codes.schema[code].dataType, landed.schema[code].dataType)
    if not _comparable(*code_kinds):
        raise ValueError(f"The codes are {code_kinds[0].simpleString()}, but those landed {code_kinds[1].simpleString()}")

    numbers, n = numbered_axis(axis)
    numbers = write_scratch(numbers, "axis-numbers")
    zero = F.lit(0).cast("bigint")
    words = F.explode(F.sequence(zero, F.lit((n - 1) // _WORD_BITS).cast("bigint"))) if n else F.explode(F.array().cast("array<bigint>"))
    empty = codes.select(col(code).alias("code"), words.alias("word"), zero.alias("bits"), F.lit(True).alias("wanted"))
    key = _as_landed(F.col("value"), given, kind).alias("key")
    held = landed.select(_as_landed(col(code), *reversed(code_kinds)).alias("code"), col(name).alias("key"),
                         (col(code).isNull() | _as_landed(col(code), *reversed(code_kinds)).isNotNull()).alias("fits"))
    held = held.filter("fits").join(numbers.select(key, "number"), "key")
    bit = F.expr("shiftleft(1L, cast(number % 64 as int))")
    held = held.select("code", F.floor(F.col("number") / _WORD_BITS).alias("word"), bit.alias("bits"), F.lit(False).alias("wanted"))
    seen = empty.unionByName(held).groupBy("code", "word").agg(F.bit_or("bits").alias("bits"), F.bool_or("wanted").alias("wanted"))

    by_word = numbers.withColumn("word", F.floor(F.col("number") / _WORD_BITS)).groupBy("word")
    by_word = by_word.agg(F.collect_list(F.struct(F.expr("shiftleft(1L, cast(number % 64 as int))").alias("bit"), "value")).alias("values"))
    gaps = seen.filter("wanted").join(by_word, "word")
    missing = F.filter("values", lambda v: F.col("bits").bitwiseAND(v["bit"]) == 0)
    gaps = gaps.select("code", F.explode(missing).alias("gap"))
    value = F.col("gap.value")
    if given != kind and isinstance(given, T.IntegralType) and isinstance(kind, T.IntegralType):
        refusal = F.concat(F.lit(f"The landed column {name!r} cannot hold the axis value "), value.cast("string"))
        value = F.coalesce(value.try_cast(kind), F.raise_error(refusal).cast(kind))
    return gaps.select(F.col("code").alias(code), value.alias(name))
