"""Session settings the plans of this package are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

CLUSTER_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Join sides are broadcast, partitions merged and hot partitions split by their measured size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even when that costs one more shuffle above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def configure(builder: SparkSession.Builder, shuffle_partitions: int, **settings: str) -> SparkSession.Builder:
    """Apply the settings; ``shuffle_partitions`` should put about 100-200 MB of the largest shuffle in each one.
    Adaptive execution merges partitions that turn out small, so rather give too many than too few."""
    merged = {**CLUSTER_SETTINGS, "spark.sql.shuffle.partitions": str(shuffle_partitions), **settings}
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder
