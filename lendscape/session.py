"""Session settings for large batch runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Initial shuffle partition count: about 128 MB each and at least two waves of tasks.

    Adaptive execution merges small partitions afterwards, so erring high costs little,
    while erring low makes every partition spill.
    """
    by_size = -(-input_bytes // TARGET_PARTITION_BYTES)
    return int(max(by_size, 2 * cores))


def tune(builder: SparkSession.Builder, input_bytes: int, cores: int) -> SparkSession.Builder:
    """Apply the settings the jobs are written for; the master is left to the caller."""
    settings = {
        "spark.sql.shuffle.partitions": shuffle_partitions(input_bytes, cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": TARGET_PARTITION_BYTES,
        # Writers kept open side by side, so that few output partitions need no sort.
        "spark.sql.maxConcurrentOutputFileWriters": 16,
        "spark.sql.files.maxPartitionBytes": TARGET_PARTITION_BYTES,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "zstd",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder
