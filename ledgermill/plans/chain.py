"""Ordered stages over a frame: plain functions, transformers and estimators.

A chain is a list of dicts ``{"kind": name, ...}``. ``kind`` names one of the stages below, or any name when the dict
carries its own ``"stage"``: a function from frame to frame, a ``pyspark.ml`` transformer or an estimator, which is
fitted on the frame as it stands and then applied to it.
"""

from __future__ import annotations

import json
from datetime import date, datetime
from decimal import Decimal
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from ledgermill.names import col
from ledgermill.operators.fill import fill_values, resolve_fills
from ledgermill.operators.sparse import dense_columns
from ledgermill.spec import FillSpec


class _SparseParams(Params):
    threshold = Param(Params._dummy(), "threshold", "a column stays below this missing fraction", TypeConverters.toFloat)
    columns = Param(Params._dummy(), "columns", "columns kept", TypeConverters.toListString)


class SparseColumnDropper(Estimator, _SparseParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns which columns are dense enough to keep."""

    @keyword_only
    def __init__(self, *, threshold: float = 0.5):
        super().__init__()
        self._set(threshold=threshold)

    def _fit(self, dataset: DataFrame) -> SparseColumnModel:
        model = SparseColumnModel()
        model._set(columns=dense_columns(dataset, self.getOrDefault(self.threshold)))
        return model


class SparseColumnModel(Model, _SparseParams, DefaultParamsReadable, DefaultParamsWritable):
    """Keeps the learned columns."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.select(*[col(c) for c in self.getOrDefault(self.columns)])


# Values that JSON has no form for, kept with the name of their type.
_TAGGED = {
    "decimal": (Decimal, str, Decimal),
    "timestamp": (datetime, datetime.isoformat, datetime.fromisoformat),
    "date": (date, date.isoformat, date.fromisoformat),
}


def _as_tagged(value: Any) -> dict[str, str]:
    for tag, (kind, to_text, _) in _TAGGED.items():
        if isinstance(value, kind):
            return {tag: to_text(value)}
    raise TypeError(f"A fill cannot hold a {type(value).__name__}")


def _from_tagged(found: dict[str, Any]) -> Any:
    if len(found) == 1:
        tag, value = next(iter(found.items()))
        if tag in _TAGGED and isinstance(value, str):
            return _TAGGED[tag][2](value)
    return found


class _FillParams(Params):
    fills = Param(Params._dummy(), "fills", "column -> statistic or constant, as JSON", TypeConverters.toString)


class NullFiller(Estimator, _FillParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the fill value of each column: statistics for numeric columns, constants otherwise."""

    @keyword_only
    def __init__(self, *, fills: Mapping[str, Any] | None = None):
        super().__init__()
        self._set(fills=json.dumps(dict(fills or {}), default=_as_tagged))

    def _fit(self, dataset: DataFrame) -> NullFillModel:
        wanted = json.loads(self.getOrDefault(self.fills), object_hook=_from_tagged)
        model = NullFillModel()
        learned = resolve_fills(dataset, [FillSpec(c, v) for c, v in wanted.items()])
        model._set(fills=json.dumps(learned, default=_as_tagged))
        return model


class NullFillModel(Model, _FillParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fills nulls with the learned values."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        values = json.loads(self.getOrDefault(self.fills), object_hook=_from_tagged)
        return fill_values(dataset, {c: v for c, v in values.items() if c in dataset.columns})


class FrameFunction(Transformer):
    """A function from frame to frame as a stage."""

    def __init__(self, fn: Callable[[DataFrame], DataFrame]):
        super().__init__()
        self.fn = fn

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fn(dataset)


STAGES: dict[str, Callable[..., Any]] = {
    "drop_sparse": SparseColumnDropper,
    "fill_nulls": NullFiller,
}


def _stage(item: Mapping[str, Any]) -> Any:
    if not isinstance(item, Mapping):
        raise NotImplementedError("Each chain element must be a dict")
    options = {k: v for k, v in item.items() if k not in ("kind", "stage")}
    if "stage" in item:
        stage = item["stage"]
    elif item.get("kind") in STAGES:
        stage = STAGES[item["kind"]](**options)
    else:
        raise NotImplementedError(f"Unknown stage {item.get('kind')!r}")
    if isinstance(stage, (Estimator, Transformer)):
        return stage
    if callable(stage):
        return FrameFunction(stage)
    raise NotImplementedError("A stage must be a function, a transformer or an estimator")


def run_chain(df: DataFrame, stages: Sequence[Mapping[str, Any]]) -> tuple[dict[str, Transformer], DataFrame]:
    """Apply the stages in order. Returns the (fitted) stage of each kind and the final frame."""
    built = [(item.get("kind") if isinstance(item, Mapping) else None, _stage(item)) for item in stages]
    fitted: dict[str, Transformer] = {}
    for kind, stage in built:
        model = stage.fit(df) if isinstance(stage, Estimator) else stage
        df = model.transform(df)
        fitted[str(kind)] = model
    return fitted, df
