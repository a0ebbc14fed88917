"""Columns added to feed, url and anchor tables. Map-only."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelore import schemas
from pagelore.functions.markup import tag_attr
from pagelore.functions.urls import hostname


def with_hostname(df: DataFrame, page_col: str = "page") -> DataFrame:
    return df.withColumn("hostname", hostname(F.col(page_col)))


def parse_feeds(feeds: DataFrame) -> DataFrame:
    """Host name and link attributes of each feed tag; the type becomes lower case."""
    return feeds.select(
        "page",
        "tag",
        F.lower("type").alias("type"),
        hostname(F.col("page")).alias("hostname"),
        *(tag_attr(F.col("tag"), name).alias(name) for name in ("rel", "href", "title")),
    ).select(schemas.FEEDS.names)
