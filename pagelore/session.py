"""Session settings the jobs rely on; all of them are ordinary Spark options."""

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime re-planning: joins pick broadcast or shuffle from measured sizes, hot
    # partitions of a join are split, small ones are merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
