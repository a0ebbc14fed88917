"""Parquet output and file compaction."""

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Size of an output file when the number of files is worked out from the input.
TARGET_FILE_BYTES = 512 * 1024 * 1024


def write_parquet(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Snappy Parquet; fails when the path is taken unless ``overwrite`` is set.

    What is overwritten stays until the new files are complete: they are written beside it and
    take its place by renaming. A job that fails leaves the old table, and a job may read the
    table that it replaces.
    """
    if overwrite:
        _replace(df, path)
    else:
        _write(df, path)


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("compression", "snappy").parquet(path)


def _replace(df: DataFrame, path: str) -> None:
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    # Readers of the parent folder skip names with a full stop in front.
    beside, old = (
        spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}-{what}")
        for what in ("new", "old")
    )
    try:
        _write(df, beside.toString())
    except Exception:
        files.delete(beside, True)
        raise
    taken = files.exists(target)
    if taken and not files.rename(target, old):
        raise OSError(f"cannot rename {path}")
    if not files.rename(beside, target):
        if taken:
            files.rename(old, target)
        raise OSError(f"cannot rename {beside.toString()} to {path}")
    if taken:
        files.delete(old, True)
    spark.catalog.refreshByPath(path)


def write_by_page(
    df: DataFrame, table: str, buckets: int, path: str | None = None, overwrite: bool = False
) -> None:
    """A snappy Parquet table of the catalog in ``buckets`` parts by the hash of url, sorted.

    Tables of as many buckets are joined and grouped by page where they lie. The rows of a page
    are one part of one file, so this is for crawls in which no page outgrows a task; without
    it, joins shuffle and Spark splits hot pages. ``path`` puts the files elsewhere than in the
    warehouse.
    """
    mode = "overwrite" if overwrite else "errorifexists"
    writer = df.repartition(buckets, "url").write.mode(mode).option("compression", "snappy")
    if path is not None:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, "url").sortBy("url").saveAsTable(table)


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under a path. Only file listings are read, no content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.sum("length").alias("bytes")).first().bytes or 0


def file_count(spark: SparkSession, path: str) -> int:
    """How many files the content under a path fills."""
    return max(1, math.ceil(input_bytes(spark, path) / TARGET_FILE_BYTES))


def compact(df: DataFrame, files: int) -> DataFrame:
    """Merge neighbouring partitions so that at most ``files`` files are written.

    There is no shuffle, but no more than ``files`` tasks either: let the number grow
    with the data (:func:`file_count`).
    """
    return df.coalesce(files)


def merge_small(df: DataFrame) -> DataFrame:
    """Merge what parsing gives into fewer partitions, without fewer tasks for the parsing.

    The rows are shuffled once; Spark then merges or splits partitions by their real size,
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.
    """
    return df.hint("rebalance")
