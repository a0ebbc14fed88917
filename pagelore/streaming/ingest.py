"""Incremental runs of the map-only jobs: only files that have not been seen are processed.

The operators are the same as for tables; only reading and writing differ. A run takes what
is there and ends; progress lies in the checkpoint folder, so a run that was broken off is
taken up where it was, without loss or duplicates.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pagelore import schemas
from pagelore.operators.enrichment import parse_feeds
from pagelore.operators.extraction import tweet_links, wiki_link_paragraphs
from pagelore.operators.quads import annotations_from_quads
from pagelore.sources.readers import complete_pages, json_lines, split_wiki_links


def append_new(df: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Process the files that are there now and append the result to Parquet."""
    writer = df.writeStream.format("parquet").option("compression", "snappy")
    return (
        writer.option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def new_feeds(spark: SparkSession, source: str, escape: str = '"') -> DataFrame:
    reader = spark.readStream.schema(schemas.FEEDS_RAW).options(header=False, escape=escape)
    return parse_feeds(reader.csv(source).fillna(""))


def new_annotations(spark: SparkSession, source: str, on_error: str = "keep") -> DataFrame:
    return annotations_from_quads(spark.readStream.text(source), on_error=on_error)


def new_wiki_links(spark: SparkSession, source: str, on_bad: str = "fail") -> DataFrame:
    return split_wiki_links(spark.readStream.text(source), on_bad)


def new_wiki_paragraphs(spark: SparkSession, source: str, on_bad: str = "fail") -> DataFrame:
    return wiki_link_paragraphs(_new_pages(spark, source, on_bad))


def new_tweet_links(spark: SparkSession, source: str, on_bad: str = "fail") -> DataFrame:
    return tweet_links(_new_pages(spark, source, on_bad))


def _new_pages(spark: SparkSession, source: str, on_bad: str) -> DataFrame:
    mode = "FAILFAST" if on_bad == "fail" else "PERMISSIVE"
    reader = json_lines(spark.readStream).schema(schemas.PAGES).option("mode", mode)
    return complete_pages(reader.json(source), on_bad)
