"""Session settings that follow the size of the input."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

MIB = 1024 * 1024

# Bytes of shuffled data meant for one task: small enough to sort and aggregate in memory.
_PER_TASK = 256 * MIB


def session_settings(log_bytes: int, shuffled_share: float = 0.5, cores: int = 8) -> dict[str, str]:
    """Settings for a feature job over a log of ``log_bytes``.

    ``shuffled_share`` is how much of the stored log the label join shuffles: the seven used
    columns, uncompressed rows against compressed columns. The partition count is a ceiling:
    adaptive execution joins small partitions again, but cannot cut an aggregate's partition
    that was planned too large.
    """
    partitions = max(cores, math.ceil(log_bytes * shuffled_share / _PER_TASK))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(_PER_TASK),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_PER_TASK // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * _PER_TASK),
    }


def path_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the files under the paths (globs count too), from the file system's listing."""
    total = 0
    for text in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(text)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        total += sum(files.getContentSummary(found.getPath()).getLength() for found in files.globStatus(path) or [])
    return total


@contextmanager
def sized_for(spark: SparkSession, log_bytes: int) -> Iterator[int]:
    """Inside the block, at least as many shuffle partitions as a log of this size needs; the
    session's own number stays where it is larger, and comes back afterwards."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    needed = int(session_settings(log_bytes, cores=1)[key])
    spark.conf.set(key, str(max(int(before), needed)))
    try:
        yield max(int(before), needed)
    finally:
        spark.conf.set(key, before)
