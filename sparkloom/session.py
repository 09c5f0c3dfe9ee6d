"""The session that the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, partitions: int | None = None, name: str = "sparkloom") -> SparkSession:
    """UTC, ANSI, adaptive execution, last value of a map key wins. On a cluster, sizes are left to the submitter."""
    b = SparkSession.builder.appName(name)
    for k, v in {
        "spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.mapKeyDedupPolicy": "LAST_WIN", "spark.sql.execution.arrow.pyspark.enabled": "true",
    }.items():
        b = b.config(k, v)
    if master:
        b = b.master(master)
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    return b.getOrCreate()
