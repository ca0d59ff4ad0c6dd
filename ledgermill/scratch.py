"""Shared scratch folder: where intermediate tables go so that they outlive any one executor.

The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a local session without that setting gets a
folder of its own, because a machine-local folder is invisible to other executors.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ledgermill.hadoop import file_system

_LOCAL: dict[str, str] = {}
_OPEN = threading.local()


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="ledgermill-")
    return _LOCAL[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def write_scratch(df: DataFrame, label: str) -> DataFrame:
    """Write the frame once and return it read back: lineage ends here and sizes are known to the planner."""
    path = scratch_path(df.sparkSession, label)
    for owned in getattr(_OPEN, "stack", [])[-1:]:
        owned.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark's own switch to remove the shuffle files of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_step(df: DataFrame, label: str) -> DataFrame:
    """:func:`write_scratch` for a step with large exchanges: their files go when it is written, not when the driver happens
    to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return write_scratch(df.select("*"), label)  # the switch counts when a frame is made
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables written inside are deleted at the end, also when the work fails.

    For work that ends in a stored table; a frame that is handed out lazily must not be built in a scope.
    """
    if not hasattr(_OPEN, "stack"):
        _OPEN.stack = []
    _OPEN.stack.append([])
    try:
        yield
    finally:
        for path in _OPEN.stack.pop():
            fs, p, _ = file_system(spark, path)
            fs.delete(p, True)
