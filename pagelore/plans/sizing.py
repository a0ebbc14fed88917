"""Number of shuffle partitions that follows the size of the input."""

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from pagelore.sources.writers import input_bytes

# Input files are compressed; this much of them makes a partition that sorts in memory.
BYTES_PER_PARTITION = 256 * 1024 * 1024
_SETTING = "spark.sql.shuffle.partitions"
# Whether two sides must be dealt out by all join keys, or some of them (the page) will do.
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def shuffle_partitions(spark: SparkSession, *paths: str) -> int:
    """Enough partitions for the files under all paths, never fewer than the session has."""
    needed = math.ceil(sum(input_bytes(spark, path) for path in paths) / BYTES_PER_PARTITION)
    return max(int(spark.conf.get(_SETTING)), needed)


@contextmanager
def sized_shuffles(spark: SparkSession, *paths: str) -> Iterator[None]:
    """Use that many partitions for the queries inside; Spark merges those that stay small."""
    with _setting(spark, _SETTING, str(shuffle_partitions(spark, *paths))):
        yield


@contextmanager
def joined_by_page(spark: SparkSession) -> Iterator[None]:
    """Let tables laid out by page stay where they are in joins by page and something else."""
    with _setting(spark, _ALL_KEYS, "false"):
        yield


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)
