"""Shuffle sizes that follow the data."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_PARTITIONS = "spark.sql.shuffle.partitions"

# Input bytes for each shuffle partition. Adaptive execution merges partitions that turn out small
# but cannot split what was planned too large, so the plan starts with enough of them.
BYTES_PER_PARTITION = 256 * 1024**2

# Session setting: the most shuffle partitions a job may plan. Unset means no limit. A driver with little
# memory may need one, as it keeps the sizes of all map outputs; partitions then get larger and spill.
MOST_PARTITIONS = "assaylake.shuffle.mostPartitions"


def partitions_for(input_bytes: int, at_least: int, most: int | None = None) -> int:
    wanted = -(-input_bytes // BYTES_PER_PARTITION)
    return max(at_least, wanted if most is None else min(most, wanted))


@contextmanager
def shuffle_sized_for(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Raise the number of shuffle partitions to suit an input; never lower what the session has."""
    before = spark.conf.get(_PARTITIONS)
    most = spark.conf.get(MOST_PARTITIONS, None)
    spark.conf.set(_PARTITIONS, partitions_for(input_bytes, int(before), int(most) if most else None))
    try:
        yield
    finally:
        spark.conf.set(_PARTITIONS, before)
