"""Intermediate tables in the shared folder of the cluster."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str | None:
    """The folder named by ``spark.checkpoint.dir``, or None when the session has none."""
    return spark.conf.get("spark.checkpoint.dir", None)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table.

    Only a local session may go without a shared folder; it gets a temporary one.
    """
    folder = shared_folder(spark)
    if folder is None:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="pagelore-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Later stages then start from files instead of recomputing lost work, and joins know the
    real size. Without a shared folder the table stays a plan.
    """
    spark = df.sparkSession
    if shared_folder(spark) is None:
        return df
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
