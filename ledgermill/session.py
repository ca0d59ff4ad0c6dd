"""Session settings the engine is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution splits skewed joins (also where that costs another shuffle), evens out writes and picks joins from
# true sizes.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, pass ``SETTINGS`` to ``spark-submit`` and size
    ``spark.sql.shuffle.partitions`` to about one partition per 200 MB of shuffled data."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("ledgermill")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
