"""One place for the session settings the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "dialoom") -> SparkSession:
    """A session with adaptive execution, Arrow transfer and a UTC clock.

    On a cluster leave ``shuffle_partitions`` high: adaptive execution merges
    small partitions, and it can't split those that were made too large.
    """
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
