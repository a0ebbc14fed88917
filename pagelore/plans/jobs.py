"""The jobs. Each one reads its inputs, transforms them and writes Parquet.

``files`` is the number of output files of the compacting jobs, and of their tasks. Left out,
jobs that parse use all tasks and merge their rows by size afterwards; compaction without
parsing works the number out from the size of the input.

With ``buckets``, the target of the jobs on pages is a table of the catalog, laid out by page;
the knowledge base then reads ``tables`` instead of folders.

Jobs that may meet bad input return how many rows they wrote and how many of these, or of the
lines left out, were bad. The counts are made on the way, in the same pass.
"""

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pagelore.fixed_values import QUAD_ERROR_SUBJECT

from pagelore.operators.domains import suffix_rules
from pagelore.operators.enrichment import parse_feeds, with_hostname
from pagelore.operators.extraction import tweet_links, wiki_link_paragraphs
from pagelore.operators.matching import Strategy, name_exact_match
from pagelore.operators.quads import annotations_from_quads
from pagelore.operators.substitution import (
    count_copies,
    repeat_copies,
    substitute_objects,
    substitute_subjects,
)
from pagelore.plans.sizing import joined_by_page, sized_shuffles
from pagelore.sources import readers, writers
from pagelore.sources.members import read_member_lines
from pagelore.sources.staging import cut_lineage


def transform_feeds(
    spark: SparkSession, source: str, target: str, files: int | None = None, escape: str = '"'
) -> dict[str, int]:
    feeds = parse_feeds(readers.read_feeds_csv(spark, source, escape=escape))
    feeds, report = _counted(
        feeds, no_hostname=_empty("hostname"), no_rel=_empty("rel"), no_href=_empty("href"),
        no_title=_empty("title"),
    )
    writers.write_parquet(_merged(feeds, files), target)
    return report.get


def urls_to_parquet(
    spark: SparkSession, source: str, target: str, files: int | None = None
) -> None:
    urls = readers.read_urls_csv(spark, source)
    writers.write_parquet(_merged(urls, files), target)


def transform_urls(spark: SparkSession, source: str, target: str) -> dict[str, int]:
    urls, report = _counted(
        with_hostname(readers.read_parquet(spark, source)), no_hostname=_empty("hostname")
    )
    writers.write_parquet(urls, target)
    return report.get


def transform_anchors(spark: SparkSession, source: str, target: str) -> dict[str, int]:
    """The same as for urls; other columns pass through."""
    return transform_urls(spark, source, target)


def compact_parquet(
    spark: SparkSession, source: str, target: str, files: int | None = None
) -> None:
    rows = readers.read_parquet(spark, source)
    writers.write_parquet(writers.compact(rows, files or writers.file_count(spark, source)), target)


def raw_pages_to_parquet(
    spark: SparkSession, source: str, target: str, fixed: bool = False, buckets: int | None = None,
    drifting: bool = False,
) -> None:
    """With ``drifting``, fields that change their kind are kept as they came."""
    if drifting:
        pages = readers.read_drifting_json(spark, source)
    else:
        pages = readers.read_pages_json(spark, source, infer=not fixed)
    _write(pages, target, buckets)


def quads_to_parquet(
    spark: SparkSession,
    source: str,
    target: str,
    on_error: str = "keep",
    rules_path: str | None = None,
    min_partitions: int | None = None,
    buckets: int | None = None,
    members: bool = False,
) -> dict[str, int]:
    """With ``members``, gzip files of many members are read by many tasks each."""
    rules = None if rules_path is None else suffix_rules(spark, rules_path)
    if members:
        lines = read_member_lines(spark, source)
    else:
        lines = readers.read_lines(spark, source, min_partitions)
    lines, report = _counted(lines)
    quads, kept = _counted(
        annotations_from_quads(lines, on_error=on_error, rules=rules),
        marked=F.col("subject") == QUAD_ERROR_SUBJECT,
    )
    _write(quads, target, buckets)
    bad = report.get["rows"] - kept.get["rows"] + kept.get["marked"]
    return {"rows": kept.get["rows"], "bad_lines": bad}


def wiki_links_to_parquet(
    spark: SparkSession, source: str, target: str, on_bad: str = "fail", buckets: int | None = None,
    members: bool = False,
) -> dict[str, int]:
    """With ``members``, gzip files of many members are read by many tasks each."""
    lines, report = _counted((read_member_lines if members else readers.read_lines)(spark, source))
    links, kept = _counted(readers.split_wiki_links(lines, on_bad))
    _write(links, target, buckets)
    return {"rows": kept.get["rows"], "bad_lines": report.get["rows"] - kept.get["rows"]}


def extract_wiki_paragraphs(
    spark: SparkSession, source: str, target: str, on_bad: str = "fail"
) -> None:
    pages = readers.read_page_lines(spark, source, on_bad)
    writers.write_parquet(wiki_link_paragraphs(pages), target)


def extract_tweet_links(
    spark: SparkSession, source: str, target: str, on_bad: str = "fail"
) -> None:
    pages = readers.read_page_lines(spark, source, on_bad)
    writers.write_parquet(tweet_links(pages), target)


def build_knowledge_base(
    spark: SparkSession, pages: str, annotations: str, wiki_links: str, target: str,
    strategy: Strategy, tables: bool = False,
) -> None:
    """Match the entities of all pages and rewrite the annotations; replaces the target.

    With ``tables`` the inputs are names of tables laid out by page. Annotations and pages then
    stay where they are; only what is looked up on a page is moved to it.
    """
    names = (pages, annotations, wiki_links)
    if tables:
        found = [spark.table(name) for name in names]
        settings = joined_by_page(spark)
    else:
        found = [readers.read_parquet(spark, path) for path in names]
        settings = sized_shuffles(spark, annotations, wiki_links)
    with settings:
        writers.write_parquet(knowledge_base(*found, strategy), target, overwrite=True)


def build_knowledge_base_by_name(
    spark: SparkSession, pages: str, annotations: str, wiki_links: str, target: str,
    dictionary: str, tables: bool = False,
) -> None:
    strategy = name_exact_match(readers.read_dictionary(spark, dictionary), counted=True)
    build_knowledge_base(spark, pages, annotations, wiki_links, target, strategy, tables)


def knowledge_base(
    pages: DataFrame, annotations: DataFrame, wiki_links: DataFrame, strategy: Strategy
) -> DataFrame:
    """Annotations with matched subjects and objects put in their place.

    The mappings are needed twice, so they are written once where the cluster has a shared
    folder. Otherwise Spark reuses the shuffles the two uses have in common. Equal mappings
    go through the joins as one row with a number of copies.
    """
    triples = annotations.select("url", "subject", "predicate", "obj")
    mappings = cut_lineage(count_copies(strategy(pages, triples, wiki_links)), "mappings")
    substituted = substitute_objects(mappings, substitute_subjects(mappings, triples))
    return repeat_copies(substituted)


def _merged(df: DataFrame, files: int | None) -> DataFrame:
    return writers.compact(df, files) if files else writers.merge_small(df)


def _write(df: DataFrame, target: str, buckets: int | None) -> None:
    if buckets is None:
        writers.write_parquet(df, target)
    else:
        writers.write_by_page(df, target, buckets)


def _empty(column: str) -> Column:
    return F.col(column) == ""


def _counted(df: DataFrame, **conditions: Column) -> tuple[DataFrame, Observation]:
    """Count rows, and those that meet each condition, while the table is written."""
    report = Observation()
    counts = [F.count_if(condition).alias(name) for name, condition in conditions.items()]
    return df.observe(report, F.count("*").alias("rows"), *counts), report
