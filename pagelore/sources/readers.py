"""Readers of the raw dumps. Every path may be a folder or a glob; gzip is read as it is."""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelore import schemas
from pagelore.sources.staging import cut_lineage


# Spark's own default leaves out or nulls lines with texts of more than 20 million characters.
LONGEST_TEXT = 2**31 - 1


def _check(on_bad: str) -> None:
    if on_bad not in ("fail", "drop"):
        raise ValueError(f"on_bad must be fail or drop, not {on_bad!r}")


def read_feeds_csv(spark: SparkSession, path: str, escape: str = '"', **options) -> DataFrame:
    """Headerless CSV -> page, tag, type. Missing and empty fields are ''.

    A quote inside a quoted field is doubled; pass ``escape="\\\\"`` for files that put a
    backslash before it.
    """
    reader = spark.read.schema(schemas.FEEDS_RAW).options(header=False, escape=escape, **options)
    return reader.csv(path).fillna("")


def read_urls_csv(spark: SparkSession, path: str, escape: str = '"', **options) -> DataFrame:
    """Headerless CSV -> page. Surplus fields are left out; an empty address is ''."""
    reader = spark.read.schema(schemas.URLS_RAW).options(header=False, escape=escape, **options)
    return reader.csv(path).fillna("")


def read_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """Text lines as column ``value``.

    Spark already cuts splittable files into enough pieces for the cluster. Only for few
    large gzip files is ``min_partitions`` worth its shuffle; more pieces stay as they are.
    """
    lines = spark.read.text(path)
    if min_partitions is None or lines.rdd.getNumPartitions() >= min_partitions:
        return lines
    return lines.repartition(min_partitions)


def json_lines(reader):
    """A batch or stream reader for JSON lines with texts of any length."""
    return reader.option("maxStringLen", LONGEST_TEXT)


def read_pages_json(
    spark: SparkSession, path: str, infer: bool = True, on_bad: str = "fail"
) -> DataFrame:
    """JSON lines with all their fields, at the price of a second read; without ``infer`` only
    url and content. A line that is no JSON fails the job or is left out."""
    _check(on_bad)
    reader = json_lines(spark.read).option("mode", "FAILFAST" if on_bad == "fail" else "DROPMALFORMED")
    return reader.json(path) if infer else reader.schema(schemas.PAGES).json(path)


def read_drifting_json(spark: SparkSession, path: str, on_bad: str = "fail") -> DataFrame:
    """JSON lines with all their fields, also those that change their kind from line to line.

    Lines are parsed once, to VARIANT, and written to the shared folder; the fields are found by
    an aggregation there, and come in order of their names. A field that is now a number, now a
    text, or an object without fields, is a VARIANT column with each value as it came, at any
    depth; one that is always null is text. Numbers with a point are decimals where they fit.
    Empty lines are no rows. A line that is no JSON object fails the job or is left out. A line
    must fit into one VARIANT (128 MB); :func:`read_pages_json` has no such limit.
    """
    _check(on_bad)
    lines = spark.read.text(path).where(~F.col("value").rlike(r"\A\s*\z"))
    parse = F.parse_json if on_bad == "fail" else F.try_parse_json
    parsed = lines.select(parse(F.col("value")).alias("line"))
    objects = F.coalesce(F.schema_of_variant("line").startswith("OBJECT<"), F.lit(False))
    problem = F.concat(F.lit("no JSON object: "), F.to_json("line"))
    stored = cut_lineage(_only(parsed, objects, on_bad, problem), "json-lines")
    found = stored.agg(F.schema_of_variant_agg("line")).first()[0]
    if not found.startswith("OBJECT<") or found == "OBJECT<>":
        return spark.createDataFrame([], "struct<>") if found == "VOID" else stored.select()
    return stored.select(F.col("line").cast(_ddl(found)).alias("row")).select("row.*")


def _ddl(found: str) -> str:
    """The type that Spark gives for variants, as one that columns can have."""
    names = {"OBJECT<>": "VARIANT", "OBJECT<": "STRUCT<", "VOID": "STRING"}
    parts = r"`(?:[^`]|``)*`|OBJECT<>|OBJECT<|(?<=[ <])VOID(?=[,>])"
    return re.sub(parts, lambda part: names.get(part[0], part[0]), found)


def read_page_lines(spark: SparkSession, path: str, on_bad: str = "fail") -> DataFrame:
    """JSON lines -> content, url. A line that is no JSON or lacks a field fails the job or is
    left out."""
    _check(on_bad)
    mode = "FAILFAST" if on_bad == "fail" else "PERMISSIVE"
    pages = json_lines(spark.read).schema("content string, url string").option("mode", mode).json(path)
    return complete_pages(pages, on_bad)


def complete_pages(pages: DataFrame, on_bad: str) -> DataFrame:
    """Pages that have a url and content; others fail the job or are left out."""
    complete = F.col("content").isNotNull() & F.col("url").isNotNull()
    return _only(pages, complete, on_bad, F.lit("page line without url or content"))


def _only(rows: DataFrame, good: Column, on_bad: str, problem: Column) -> DataFrame:
    """Rows that are good. Failing is a condition of its own: a column can be pruned away."""
    if on_bad == "drop":
        return rows.where(good)
    return rows.where(F.when(good, True).otherwise(F.raise_error(problem).cast("boolean")))


def read_wiki_links_tsv(spark: SparkSession, path: str, on_bad: str = "fail") -> DataFrame:
    """Tab-separated lines -> url, anchorText, wikiLink.

    Exactly three fields are wanted, tabs at the end of the line not counted. Another line
    fails the job or is left out.
    """
    return split_wiki_links(spark.read.text(path), on_bad)


def split_wiki_links(lines: DataFrame, on_bad: str = "fail") -> DataFrame:
    """The same for a table of text lines (column ``value``)."""
    _check(on_bad)
    names = schemas.WIKI_LINKS.names
    complete = F.rtrim("value", F.lit("\t")).rlike(r"\A[^\t]*\t[^\t]*\t[^\t]*\z")
    good = _only(lines, complete, on_bad, F.concat(F.lit("not three fields: "), F.col("value")))
    fields = good.select(F.split(F.rtrim("value", F.lit("\t")), "\t").alias("fields"))
    return fields.select(*(F.col("fields")[i].alias(name) for i, name in enumerate(names)))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Mention dictionary: title, mention; one row per known way to call an entity."""
    return spark.read.schema(schemas.DICTIONARY).parquet(path)
