"""Exact medians of any number of columns at once, over all rows or by group, without sorting or gathering values.

Each column (of each group) keeps an open range that holds its middle rank. A round has two passes over the rows, however
many columns there are: one takes a quantile sketch of what lies in each range, from which come three of its values around
the rank; the other counts exactly what lies between and on them. The piece that holds the rank becomes the
next range, or the rank falls on one of the three and is found. Counts are exact, so the answer is; the sketch only decides
how fast ranges shrink. A range of fewer rows than the sketch keeps is found in its round.

Sketches and counts are taken before the exchange, so a hot group is never gathered. Per-group state is a table that is
written once a round; without groups it is one row that the driver holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions.coerce import without_nan
from ledgermill.names import col, require_columns
from ledgermill.operators.joins import null_safe_join
from ledgermill.scratch import write_scratch

#: Values that a sketch of one column and group keeps at its widest level.
SKETCH = 4096
#: Even steps through the sketch of a narrowed range; its next range has about this share of it.
_STEPS = 256
#: State of one column: how many values; the open range, what lies below and in it; three values around the wanted rank; the
#: lower middle value once found, how many values go up to it, and the value that follows.
STATE = ("n long, low double, high double, below long, held long, lo double, mid double, hi double, one double, upto long, "
         "following double")


def present_double(df: DataFrame, name: str) -> Column:
    return without_nan(col(name), df.schema[name].dataType).cast("double")


def opening(values: Column, size: int = SKETCH) -> Column:
    """Aggregate for :func:`opened`: how many values there are, and their sketch."""
    return F.struct(F.count(values).alias("n"), F.kll_sketch_agg_double(values, size).alias("sketch"))


def _quantiles(sketch: Column, held: Column, ranks: list[float]) -> Column:
    """Values of a sketch at constant ranks; null for a sketch of nothing."""
    return F.when(held > 0, F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(r) for r in ranks])))


def _around_middle(sketch: Column, n: Column, size: int) -> tuple[Column, Column, Column]:
    """Values just below, at and just above the middle of all values, as far as the sketch can tell."""
    slack = 3.0 / size**0.9
    values = _quantiles(sketch, n, [max(0.0, 0.5 - slack), 0.5, min(1.0, 0.5 + slack)])
    return values[0], values[1], values[2]


def _around(sketch: Column, offset: Column, held: Column) -> tuple[Column, Column, Column]:
    """Values of a range around a wanted offset, from a grid of ``_STEPS`` even steps through the sketch."""
    values = _quantiles(sketch, held, [i / _STEPS for i in range(_STEPS + 1)])
    at = F.floor((offset + 0.5) / held * _STEPS).cast("int")
    return tuple(F.get(values, F.least(F.greatest(at + d, F.lit(0)), F.lit(_STEPS))) for d in (-1, 0, 2))


def _state(n, low, high, below, held, around, one, upto, following) -> Column:
    lo, mid, hi = around
    null = F.lit(None).cast("double")
    return F.struct(
        n.cast("long").alias("n"), F.coalesce(low, null).alias("low"), F.coalesce(high, null).alias("high"),
        below.cast("long").alias("below"), held.cast("long").alias("held"), F.coalesce(lo, null).alias("lo"),
        F.coalesce(mid, null).alias("mid"), F.coalesce(hi, null).alias("hi"), F.coalesce(one, null).alias("one"),
        F.coalesce(upto, F.lit(None)).cast("long").alias("upto"), F.coalesce(following, null).alias("following"),
    )


def _rank(n: Column) -> Column:
    """Zero-based rank of the lower of the two middle values."""
    return F.floor((n - 1) / 2)


def opened(opening: Column, size: int = SKETCH) -> Column:
    """State of a column before the first count, from an :func:`opening`."""
    n, null = opening["n"], F.lit(None)
    around = _around_middle(opening["sketch"], n, size)
    return _state(n, null, null, F.lit(0), n, around, null, null, null)


def _is_open(state: Column) -> Column:
    return (state["n"] > 0) & state["one"].isNull()


def _inside(value: Column, state: Column) -> Column:
    """The value where it lies in the open range of a column whose median is not found yet."""
    fits = (state["low"].isNull() | (value > state["low"])) & (state["high"].isNull() | (value < state["high"]))
    return F.when(_is_open(state) & fits, value)


def _counts(value: Column, state: Column) -> list[Column]:
    """What lies in the six pieces that the three values cut a range into (the seventh is the rest), and the values
    that follow the three in the whole column."""
    v, (lo, mid, hi) = _inside(value, state), (state[x] for x in ("lo", "mid", "hi"))
    pieces = (v < lo, v == lo, (v > lo) & (v < mid), (v == mid) & (v > lo), (v > mid) & (v < hi), (v == hi) & (v > mid))
    return [F.count_if(p) for p in pieces] + [F.min(F.when(value > x, value)) for x in (lo, mid, hi)]


def _piece(state: Column, counts: Column) -> Column:
    """Which of the seven pieces the wanted offset lies in, from the first six pieces' counts."""
    offset, total, out = _rank(state["n"]) - state["below"], F.lit(0), F.lit(0)
    for i in range(6):
        total = total + counts[i]
        out = out + F.when(offset >= total, 1).otherwise(0)
    return out


def _narrowed(state: Column, counts: Column, following: Column, piece: Column) -> Column:
    """The state after a count: the piece that holds the rank is the next range, or one of its edges is the answer."""
    s, none = state, F.lit(None).cast("double")
    before = F.aggregate(F.slice(counts, 1, piece), F.lit(0).cast("bigint"), lambda x, y: x + y)
    held = F.when(piece < 6, F.get(counts, piece)).otherwise(s["held"] - before)
    edges = F.array(s["low"], s["lo"], s["mid"], s["hi"], s["high"])
    place = F.floor(piece / 2).cast("int")
    found = piece % 2 == 1
    # pieces 1, 3 and 5 are the three values; the others lie between two neighbouring edges
    one = F.when(found, F.get(edges, place + 1))
    upto = F.when(found, s["below"] + before + F.get(counts, piece))
    narrowed = _state(s["n"], F.when(~found, F.get(edges, place)), F.when(~found, F.get(edges, place + 1)), s["below"] + before,
                      held, (none, none, none), one, upto, F.when(found, F.get(following, place)))
    return F.when(_is_open(s), narrowed).otherwise(s)


def median_of(state: Column) -> Column:
    """The median once both middle values are known; null without values."""
    second = F.when(state["upto"] > F.floor(state["n"] / 2), state["one"]).otherwise(state["following"])
    return F.when(state["n"] > 0, state["one"] / 2.0 + second / 2.0)


def _read_counts(i: int, state: Column) -> list[Column]:
    """Counts and following values of column ``i`` as two arrays."""
    parts = _counts(F.col(f"v{i}"), state)
    return [F.array(*parts[:6]).alias(f"c{i}"), F.array(*parts[6:]).alias(f"f{i}")]


def _overall(rows: DataFrame, states: dict[int, dict], size: int) -> dict[int, dict]:
    """Rounds without groups: the driver holds one state a column, and a round reads only columns that are still open."""
    fields = [f.split() for f in STATE.split(", ")]

    def literal(state: dict) -> Column:
        return F.struct(*[F.lit(state[name]).cast(kind).alias(name) for name, kind in fields])

    def still() -> dict[int, Column]:
        return {i: literal(s) for i, s in states.items() if s["n"] and s["one"] is None}

    while now := still():
        seen = rows.agg(*[c for i, s in now.items() for c in _read_counts(i, s)])
        seen = seen.select("*", *[_piece(s, F.col(f"c{i}")).alias(f"p{i}") for i, s in now.items()])
        seen = seen.select(*[_narrowed(s, F.col(f"c{i}"), F.col(f"f{i}"), F.col(f"p{i}")).alias(f"s{i}") for i, s in now.items()])
        found = seen.first()
        states |= {i: found[f"s{i}"].asDict() for i in now}
        if now := still():
            seen = rows.agg(*[F.kll_sketch_agg_double(_inside(F.col(f"v{i}"), s), size).alias(f"k{i}") for i, s in now.items()])
            seen = seen.select(*[F.struct(*_around(F.col(f"k{i}"), _rank(s["n"]) - s["below"], s["held"])).alias(f"a{i}") for i, s in now.items()])
            found = seen.first()
            for i in now:
                states[i] |= dict(zip(("lo", "mid", "hi"), found[f"a{i}"]))
    return states


def _by_group(rows: DataFrame, keys: list[str], places: range, size: int) -> DataFrame:
    """Rounds by group: one row of states a group, written once a round; finished groups take no further part."""
    states = [f"s{i}" for i in places]

    def settled(frame: DataFrame) -> DataFrame:
        is_open = F.lit(False)
        for s in states:
            is_open = is_open | _is_open(F.col(s))
        return write_scratch(frame.select(*keys, *states, is_open.alias("open")), "medians")

    state = rows.groupBy(*keys).agg(*[opening(F.col(f"v{i}"), size).alias(f"o{i}") for i in places])
    state = settled(state.select(*keys, *[opened(F.col(f"o{i}"), size).alias(f"s{i}") for i in places]))
    done = state.where("not open")
    while not (state := state.where("open")).isEmpty():
        seen = null_safe_join(rows, state, keys).groupBy(*keys).agg(*[c for i in places for c in _read_counts(i, F.col(f"s{i}"))])
        seen = null_safe_join(state, seen, keys)
        seen = seen.select("*", *[_piece(F.col(f"s{i}"), F.col(f"c{i}")).alias(f"p{i}") for i in places])
        news = [_narrowed(F.col(f"s{i}"), F.col(f"c{i}"), F.col(f"f{i}"), F.col(f"p{i}")).alias(f"s{i}") for i in places]
        state = settled(seen.select(*keys, *news))
        done = done.unionByName(state.where("not open"))
        state = state.where("open")
        sketches = null_safe_join(rows, state, keys).groupBy(*keys).agg(
            *[F.kll_sketch_agg_double(_inside(F.col(f"v{i}"), F.col(f"s{i}")), size).alias(f"k{i}") for i in places])
        news = []
        for i in places:
            s = F.col(f"s{i}")
            around = _around(F.col(f"k{i}"), _rank(s["n"]) - s["below"], F.when(_is_open(s), s["held"]))
            news.append(F.when(_is_open(s), _state(*[s[x] for x in ("n", "low", "high", "below", "held")], around,
                                                   s["one"], s["upto"], s["following"])).otherwise(s).alias(f"s{i}"))
        if not state.isEmpty():
            state = settled(null_safe_join(state, sketches, keys).select(*keys, *news))
    return done


def exact_medians(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), size: int = SKETCH, state: Sequence | None = None
) -> DataFrame:
    """The median of each column (mean of the two middle values for an even count), one row per group, or one row.

    Nulls and NaN are left out; a column without values gives null. Null groups are groups. ``state`` has a collected
    :func:`opened` of each column, when an earlier pass without groups has taken them. Runs the rounds now.
    """
    require_columns(df, [*by, *columns])
    places, keys = range(len(columns)), [f"_k{i}" for i in range(len(by))]
    rows = df.select(*[col(g).alias(k) for g, k in zip(by, keys)],
                     *[present_double(df, c).alias(f"v{i}") for i, c in enumerate(columns)])
    if by:
        out = _by_group(rows, keys, places, size)
        return out.select(*[F.col(k).alias(g) for g, k in zip(by, keys)], *[median_of(F.col(f"s{i}")).alias(c) for i, c in enumerate(columns)])
    if state is None:
        first = rows.agg(*[opening(F.col(f"v{i}"), size).alias(f"o{i}") for i in places])
        state = first.select(*[opened(F.col(f"o{i}"), size) for i in places]).first()
    states = _overall(rows, {i: s.asDict() for i, s in enumerate(state)}, size)

    def median(s: dict) -> float | None:
        if not s["n"]:
            return None
        return s["one"] / 2.0 + (s["one"] if s["upto"] > s["n"] // 2 else s["following"]) / 2.0

    kinds = T.StructType([T.StructField(c, T.DoubleType()) for c in columns])
    return df.sparkSession.createDataFrame([tuple(median(states[i]) for i in places)], kinds)
