"""Staged tables and binary files in the folder that the whole cluster shares."""

import posixpath
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from pagelore.sources.staging import fresh_path


_open = threading.local()
# Names that Hadoop has for file systems which Arrow calls otherwise.
_ARROW_NAMES = {"s3a": "s3", "s3n": "s3"}


def stage(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it back, so that lost executors cost no
    recomputation and two uses do not compute it twice.

    Inside :func:`temporaries` it is removed at the end, unless it is to be kept because the
    result still reads it.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    if not keep and getattr(_open, "paths", None) is not None:
        _open.paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporaries(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside when the block ends, however it ends."""
    before = getattr(_open, "paths", None)
    _open.paths = mine = []
    try:
        yield
    finally:
        _open.paths = before
        for path in mine:
            drop_path(spark, path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a staged folder that no later step reads."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder; any place that Arrow reaches (file, hdfs, s3, gs, abfs).

    The addresses are those of Spark, ``s3a://`` too. ``hdfs`` needs libhdfs on the workers;
    credentials come from the environment, as Arrow does not see the settings of Hadoop.
    """
    scheme, colon, rest = uri.partition("://")
    return pafs.FileSystem.from_uri(f"{_ARROW_NAMES.get(scheme, scheme)}{colon}{rest}")


class FileWriter:
    """A file that counts only once :meth:`close` has given it its final name.

    The name is new for each attempt of a task, so a repeated task never meets the remains of
    one that was lost; readers take the names that successful tasks reported.
    """

    def __init__(self, folder: str, stem: str):
        self._fs, path = open_folder(folder)
        self._fs.create_dir(path, recursive=True)
        self.name = f"{stem}-{uuid.uuid4().hex}.bin"
        self._path = posixpath.join(path, self.name)
        self._out = self._fs.open_output_stream(self._path + ".part")
        self.size = 0

    def write(self, data) -> None:
        self._out.write(data)
        self.size += len(memoryview(data).cast("B"))

    def close(self) -> None:
        self._out.close()
        self._fs.move(self._path + ".part", self._path)


def open_file(folder: str, name: str):
    fs, path = open_folder(folder)
    return fs.open_input_file(posixpath.join(path, name))
