"""Task sizes that fit the input.

Adaptive execution merges small shuffle partitions and splits skewed joins, but it never
adds partitions to a deduplication or an aggregate. Jobs therefore start with enough
partitions for their input and leave the merging to adaptive execution. Both sides of a
shuffle are bounded, because the driver keeps a size per pair of map and reduce task;
beyond the bounds the tasks grow and spill.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

PARTITION_BYTES = 128 * 1024 * 1024
# Shuffled rows take more room than the column files they come from.
ROW_EXPANSION = 3
MAX_SHUFFLE_PARTITIONS = 40_000
MAX_READ_TASKS = 100_000

_READ_BYTES = "spark.sql.files.maxPartitionBytes"
_READ_BYTES_DEFAULT = ("134217728b", "128MB", "134217728")
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def bytes_of(spark: SparkSession, paths: Iterable[str]) -> int:
    """Size of all files below ``paths``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.agg(F.sum("length")).first()[0] or 0


def fit_tasks(spark: SparkSession, input_bytes: int) -> int:
    """Raise the initial number of shuffle partitions, and the bytes per read task, to the input.

    Neither is lowered, and a read size that the session chose is left alone.
    """
    per_read = math.ceil(input_bytes / MAX_READ_TASKS)
    if per_read > PARTITION_BYTES and spark.conf.get(_READ_BYTES) in _READ_BYTES_DEFAULT:
        spark.conf.set(_READ_BYTES, f"{per_read}b")

    current = int(spark.conf.get(_INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(math.ceil(input_bytes * ROW_EXPANSION / PARTITION_BYTES), MAX_SHUFFLE_PARTITIONS)
    if wanted > current:
        spark.conf.set(_INITIAL, str(wanted))
    return max(wanted, current)
