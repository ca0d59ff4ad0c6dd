"""Structured predicates whose null rules are those of an in-memory frame filter.

A null operand makes every test false except ``!=`` and ``not in``, and ``not`` flips that two-valued result. Spark SQL
text keeps SQL's three-valued rules; use the structured form when rows with nulls must survive ``!=``.

Forms: ``(column, op, value)``, ``("and", p, q, ...)``, ``("or", p, q, ...)``, ``("not", p)``. A value that names
another column is written ``Ref("other")``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.names import col


@dataclass(frozen=True)
class Ref:
    """The value side of a test when it is another column."""

    column: str


_TESTS = {
    "==": lambda a, b: a == b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}


def _compile(node: Sequence[Any], negatable: bool) -> Column:
    """``negatable`` asks for a never-null result; where null already means "drop the row" the bare test is kept,
    because only the bare test reaches the file scan."""
    head = node[0]
    if head in ("and", "or"):
        parts = [_compile(p, negatable) for p in node[1:]]
        out = parts[0]
        for p in parts[1:]:
            out = (out & p) if head == "and" else (out | p)
        return out
    if head == "not":
        return ~_compile(node[1], True)
    name, op, value = node
    left = col(name)
    right = col(value.column) if isinstance(value, Ref) else value
    if op == "!=":
        if isinstance(value, Ref):
            return ~F.coalesce(left == right, F.lit(False))
        return ~left.eqNullSafe(F.lit(right))
    if op == "not in":
        return ~F.coalesce(left.isin(list(right)), F.lit(False))
    if op == "in":
        test = left.isin(list(right))
    elif op in _TESTS:
        test = _TESTS[op](left, right if isinstance(right, Column) else F.lit(right))
    else:
        raise ValueError(f"Unknown predicate operator {op!r}")
    return F.coalesce(test, F.lit(False)) if negatable else test


def predicate(node: Sequence[Any]) -> Column:
    """Boolean column of a structured predicate."""
    return _compile(node, False)


def apply_where(df: DataFrame, where: Any) -> DataFrame:
    """Filter by SQL text, a ready column, or a structured predicate."""
    if where is None:
        return df
    if isinstance(where, str):
        return df.filter(F.expr(where))
    if isinstance(where, Column):
        return df.filter(where)
    return df.filter(predicate(where))
