"""Session settings the jobs profit from. None of them changes a result."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan from measured sizes: coalesce small partitions, split skewed ones, broadcast
    # what turned out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A fact is written into few borough folders: keep one writer open per folder and skip
    # the sort of every task's output (beyond this many folders Spark sorts as usual).
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
