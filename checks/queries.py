"""One query per operator and job, over inputs derived from the whole given tables."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs
from checks.inputs import derive
from pagelore.functions import sql as sql_functions
from pagelore.functions.annotations import clean_name, wiki_title
from pagelore.functions.urls import hostname
from pagelore.operators import extraction, grouping, matching, substitution
from pagelore.operators.domains import top_private_domain
from pagelore.operators.enrichment import parse_feeds, with_hostname
from pagelore.operators.per_page import per_page
from pagelore.operators.quads import annotations_from_quads, parse_quads
from pagelore.plans import jobs
from pagelore.sources import readers, writers
from pagelore.sources.members import read_member_lines, write_member_lines
from pagelore.sources.staging import cut_lineage, fresh_path

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


# --- expressions and map-only operators ---------------------------------------------------


@query
def hostname_pages(spark, sf_dir):
    """Host names of the crawled pages."""
    pages = inputs.table(spark, sf_dir, "pages")
    return with_hostname(pages.select("page_id", F.col("url").alias("page")))


@query
def hostname_edge(spark, sf_dir):
    return with_hostname(derive(spark, sf_dir, inputs.EDGE_URLS))


@query
def hostname_counts(spark, sf_dir):
    """Addresses per host name; the row for '' stands in for log lines on failures."""
    urls = derive(spark, sf_dir, inputs.EDGE_URLS)
    host = hostname(F.col("page"))
    return urls.groupBy(host.alias("hostname")).agg(F.count("*").alias("n_pages"))


@query
def feed_attrs(spark, sf_dir):
    return parse_feeds(derive(spark, sf_dir, inputs.FEED_TAGS))


@query
def nquads_parse(spark, sf_dir):
    return parse_quads(derive(spark, sf_dir, inputs.QUAD_LINES), on_error="drop")


@query
def nquads_errors(spark, sf_dir):
    quads = parse_quads(derive(spark, sf_dir, inputs.QUAD_LINES), on_error="keep")
    return quads.groupBy((F.col("subject") == "match_error").alias("failed")).agg(
        F.count("*").alias("n_lines")
    )


@query
def annotation_quads(spark, sf_dir):
    return annotations_from_quads(derive(spark, sf_dir, inputs.QUAD_LINES))


@query
def top_private_domain_label(spark, sf_dir):
    return top_private_domain(derive(spark, sf_dir, inputs.HOST_URLS), "url")


@query
def cleaned_names(spark, sf_dir):
    names = derive(spark, sf_dir, inputs.NAMES)
    return names.select("name", clean_name(F.col("name")).alias("cleaned"))


@query
def name_annotations(spark, sf_dir):
    quads = parse_quads(derive(spark, sf_dir, inputs.QUAD_LINES))
    return matching.name_annotations(quads).select("subject", "predicate", "obj", "url")


@query
def wiki_titles(spark, sf_dir):
    links = inputs.shop_links(inputs.shop(spark, sf_dir))
    return links.select("url", "wikiLink", wiki_title(F.col("wikiLink")).alias("title"))


# --- the same through functions of SQL ---------------------------------------------------


def _by_sql(spark, sf_dir, text, rows) -> DataFrame:
    sql_functions.register(spark)
    return spark.sql(text, t=rows)


@query
def feed_attrs_sql(spark, sf_dir):
    return _by_sql(
        spark, sf_dir,
        "SELECT page, tag, lower(type) AS type, page_hostname(page) AS hostname,"
        " tag_rel(tag) AS rel, tag_href(tag) AS href, tag_title(tag) AS title FROM {t}",
        derive(spark, sf_dir, inputs.FEED_TAGS),
    )


@query
def cleaned_names_sql(spark, sf_dir):
    names = derive(spark, sf_dir, inputs.NAMES)
    return _by_sql(spark, sf_dir, "SELECT name, clean_name(flat_text(name)) AS cleaned FROM {t}", names)


@query
def name_annotations_sql(spark, sf_dir):
    quads = parse_quads(derive(spark, sf_dir, inputs.QUAD_LINES))
    text = "SELECT subject, predicate, obj, url FROM {t} WHERE is_name_predicate(predicate)"
    return _by_sql(spark, sf_dir, text, quads)


@query
def wiki_titles_sql(spark, sf_dir):
    links = inputs.shop_links(inputs.shop(spark, sf_dir))
    text = "SELECT url, wikiLink, wiki_title(wikiLink) AS title FROM {t}"
    return _by_sql(spark, sf_dir, text, links)


# --- page markup -------------------------------------------------------------------------


@query
def pages_nonempty(spark, sf_dir):
    pages = derive(spark, sf_dir, inputs.SPARSE_PAGES)
    return extraction.nonempty_pages(pages).select(
        "page_id", "url", F.length("content").cast("bigint").alias("n_chars")
    )


@query
def wiki_page_links(spark, sf_dir):
    return extraction.wiki_page_links(derive(spark, sf_dir, inputs.LINKED_PAGES))


@query
def page_paragraphs(spark, sf_dir):
    paragraphs = extraction.page_paragraphs(derive(spark, sf_dir, inputs.LINKED_PAGES))
    return paragraphs.select("page", "paragraph")


@query
def wiki_link_paragraphs(spark, sf_dir):
    return extraction.wiki_link_paragraphs(derive(spark, sf_dir, inputs.LINKED_PAGES))


@query
def tweet_links(spark, sf_dir):
    return extraction.tweet_links(derive(spark, sf_dir, inputs.LINKED_PAGES))


# --- grouping and matching ----------------------------------------------------------------


def _shop(spark, sf_dir):
    """Three tables from one join, which is staged where the cluster has a shared folder."""
    shop = cut_lineage(inputs.shop(spark, sf_dir), "shop")
    return inputs.shop_pages(shop), inputs.shop_annotations(shop), inputs.shop_links(shop)


def _by_name(spark, sf_dir, counted=False):
    return matching.name_exact_match(inputs.shop_dictionary(spark, sf_dir), counted=counted)


# Few items a part, so that the pages of the check inputs have several.
PART_ITEMS = 3


def _lines(items: str, *fields: str):
    line = lambda t: F.concat_ws("\t", *(t[f].cast("string") for f in (*fields, "copies")))
    return F.array_join(F.array_sort(F.transform(items, line)), "\n")


@query
def triples_by_page(spark, sf_dir):
    annotations = inputs.shop_annotations(inputs.shop(spark, sf_dir))
    return grouping.triples_by_page(annotations, PART_ITEMS).select(
        "url", "part", _lines("triples", "subject", "predicate", "obj").alias("lines")
    )


@query
def wikilinks_by_page(spark, sf_dir):
    links = inputs.shop_links(inputs.shop(spark, sf_dir))
    return grouping.wikilinks_by_page(links, PART_ITEMS).select(
        "url", "part", _lines("wikilinks", "wikiLink").alias("lines")
    )


@query
def pages_with_lists(spark, sf_dir):
    return grouping.pages_with_lists(*_shop(spark, sf_dir), PART_ITEMS).select(
        "url", "content", "part",
        _lines("triples", "subject", "predicate", "obj").alias("triples"),
        _lines("wikilinks", "wikiLink").alias("links"),
    )


@query
def pages_triples_links(spark, sf_dir):
    return grouping.pages_with_both(*_shop(spark, sf_dir))


def _laid_out_by_page(spark, sf_dir, buckets=64) -> list[str]:
    """The three tables of the shop in the catalog, their files in the shared folder."""
    names = []
    for name, rows in zip(("pages", "annotations", "links"), _shop(spark, sf_dir)):
        names.append(f"{name}_{uuid.uuid4().hex}")
        writers.write_by_page(rows, names[-1], buckets, path=fresh_path(spark, name))
    return names


@query
def pages_triples_links_by_page(spark, sf_dir):
    """The same over tables laid out by page."""
    tables = [spark.table(name) for name in _laid_out_by_page(spark, sf_dir)]
    return grouping.pages_with_both(*tables, by_page=True)


@query
def page_wiki_titles(spark, sf_dir):
    return matching.page_wiki_titles(inputs.shop_links(inputs.shop(spark, sf_dir)))


@query
def page_mentions(spark, sf_dir):
    return matching.page_mentions(
        inputs.shop_links(inputs.shop(spark, sf_dir)), inputs.shop_dictionary(spark, sf_dir)
    )


@query
def instance_match(spark, sf_dir):
    return _by_name(spark, sf_dir)(*_shop(spark, sf_dir))


def title_matcher():
    """A page-level strategy: an entity's name is the title of a linked article.

    Titles and names with the same words come one after another (:func:`title_order`), so that
    only one title is remembered at a time. Inner classes travel to the workers with the job,
    wherever this file lies.
    """

    def set_up():
        import re

        prefix = "wikipedia.org/wiki/"

        def words(text):
            return re.sub(r"\W+", " ", text, flags=re.ASCII).strip().lower()

        class TitlePage:
            def __init__(self, url, content):
                self.words = self.title = None

            def add_link(self, link):
                if link is not None and prefix in link:
                    title = link.rsplit(prefix, 1)[1]
                    same = words(title.replace("_", " "))
                    self.title = min(self.title, title) if same == self.words else title
                    self.words = same

            def add_triple(self, subject, predicate, obj):
                if predicate.endswith("/name>") and obj is not None and words(obj) == self.words:
                    yield subject, self.title

            def finish(self):
                return None

        return TitlePage

    return set_up


def title_order():
    """Links by the words of their title, annotations by those of their object."""
    title = F.replace(wiki_title(F.col("link")), F.lit("_"), F.lit(" "))
    return [clean_name(F.coalesce(title, F.col("obj")))]


def title_strategy(pages, annotations, wiki_links):
    """The same strategy over whole tables."""
    names = annotations.where(F.col("predicate").endswith("/name>")).select(
        "url", "subject", clean_name(F.col("obj")).alias("mention")
    )
    titles = matching.page_wiki_titles(wiki_links).select(
        "url", "title", clean_name(F.replace("title", F.lit("_"), F.lit(" "))).alias("mention")
    )
    mentions = grouping.group_to_join(titles, "url", "mention").agg(F.min("title").alias("title"))
    matched = matching.match_names(names, mentions.drop("key_hash"))
    return matched.join(pages.select("url"), "url").select(
        F.col("url").alias("pageUrl"),
        F.col("subject").alias("localEntityUri"),
        F.col("title").alias("dbPediaUri"),
    )


@query
def custom_strategy(spark, sf_dir):
    strategy = per_page(title_matcher(), order=title_order(), content=False)
    return strategy(*_shop(spark, sf_dir))


@query
def custom_strategy_tables(spark, sf_dir):
    return title_strategy(*_shop(spark, sf_dir))


@query
def subject_substitution(spark, sf_dir):
    pages, annotations, links = _shop(spark, sf_dir)
    mappings = _by_name(spark, sf_dir)(pages, annotations, links)
    return substitution.substitute_subjects(mappings, annotations)


@query
def object_substitution(spark, sf_dir):
    return jobs.knowledge_base(*_shop(spark, sf_dir), _by_name(spark, sf_dir, counted=True))


# --- sources and sinks: write, read back ---------------------------------------------------


def _written(spark, name, write) -> str:
    path = fresh_path(spark, name)
    write(path)
    return path


def _feeds_csv(spark, sf_dir) -> str:
    feeds = derive(spark, sf_dir, inputs.FEED_TAGS)
    one_line = feeds.withColumn("tag", F.replace("tag", F.lit("\n"), F.lit(" ")))
    writer = one_line.write.options(escape='"', compression="gzip")
    return _written(spark, "feeds-csv", writer.csv)


def _json_pages(spark, sf_dir, compression) -> str:
    pages = derive(spark, sf_dir, inputs.LINKED_PAGES)
    return _written(spark, "pages-json", pages.write.option("compression", compression).json)


def _tsv_links(spark, sf_dir) -> str:
    links = inputs.shop_links(inputs.shop(spark, sf_dir))
    lines = links.select(F.concat_ws("\t", "url", "anchorText", "wikiLink").alias("value"))
    return _written(spark, "links-tsv", lines.write.text)


def _url_pages(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages").select(F.col("url").alias("page"))
    # A CSV line without a field is no row: addresses that are null are written as empty ones.
    return pages.unionAll(derive(spark, sf_dir, inputs.EDGE_URLS).select("page").fillna(""))


@query
def src_feeds_csv(spark, sf_dir):
    return readers.read_feeds_csv(spark, _feeds_csv(spark, sf_dir))


@query
def src_urls_csv(spark, sf_dir):
    writer = _url_pages(spark, sf_dir).write.options(escape='"', compression="gzip")
    return readers.read_urls_csv(spark, _written(spark, "urls-csv", writer.csv))


@query
def src_text_lines(spark, sf_dir):
    lines = derive(spark, sf_dir, inputs.QUAD_LINES)
    path = _written(spark, "quads", lines.write.option("compression", "gzip").text)
    return readers.read_lines(spark, path, min_partitions=8)


@query
def src_text_lines_members(spark, sf_dir):
    """Gzip files of many members, written and read back by ranges of bytes."""
    lines = derive(spark, sf_dir, inputs.QUAD_LINES)
    path = _written(spark, "quads", lambda out: write_member_lines(lines, out))
    return read_member_lines(spark, path)


@query
def src_pages_json(spark, sf_dir):
    return readers.read_pages_json(spark, _json_pages(spark, sf_dir, "none"), infer=False)


@query
def src_pages_json_inferred(spark, sf_dir):
    path = _json_pages(spark, sf_dir, "none")
    return readers.read_pages_json(spark, path, infer=True).select("url", "content")


@query
def src_pages_json_drifting(spark, sf_dir):
    """A field that is a number on some lines, a text on others and missing on the rest."""
    pages = derive(spark, sf_dir, inputs.LINKED_PAGES)
    line = lambda *mark: F.to_json(F.struct("url", "content", *mark))
    kind = F.length("url") % 3
    lines = pages.select(
        F.when(kind == 0, line(F.length("content").alias("mark")))
        .when(kind == 1, line(F.substring("url", 1, 12).alias("mark")))
        .otherwise(line()).alias("value")
    )
    path = _written(spark, "pages-json", lines.write.option("compression", "gzip").text)
    return readers.read_drifting_json(spark, path).select(
        "url", "content", F.schema_of_variant("mark").alias("kind"),
        F.try_variant_get("mark", "$", "string").alias("mark"),
    )


@query
def src_pages_jsonl(spark, sf_dir):
    return readers.read_page_lines(spark, _json_pages(spark, sf_dir, "gzip"), on_bad="fail")


@query
def src_wiki_tsv(spark, sf_dir):
    return readers.read_wiki_links_tsv(spark, _tsv_links(spark, sf_dir))


@query
def compact_parquet(spark, sf_dir):
    feeds = parse_feeds(derive(spark, sf_dir, inputs.FEED_TAGS))
    source = _written(spark, "feeds", feeds.repartition(8, "page").write.parquet)
    target = fresh_path(spark, "feeds-compact")
    jobs.compact_parquet(spark, source, target, files=2)
    return readers.read_parquet(spark, target)


# --- whole jobs: raw files in, Parquet out ----------------------------------------------------


def _job_output(spark, name, run):
    path = fresh_path(spark, name)
    run(path)
    return readers.read_parquet(spark, path)


@query
def job_feeds(spark, sf_dir):
    source = _feeds_csv(spark, sf_dir)
    return _job_output(spark, "feeds", lambda out: jobs.transform_feeds(spark, source, out))


@query
def job_urls(spark, sf_dir):
    """CSV to Parquet, then the host names."""
    writer = _url_pages(spark, sf_dir).write.options(escape='"', compression="gzip")
    source = _written(spark, "urls-csv", writer.csv)
    urls = fresh_path(spark, "urls")
    jobs.urls_to_parquet(spark, source, urls)
    return _job_output(spark, "urls-parsed", lambda out: jobs.transform_urls(spark, urls, out))


@query
def job_anchors(spark, sf_dir):
    """Other columns of the anchor table pass through."""
    anchors = derive(spark, sf_dir, inputs.EDGE_URLS)
    source = _written(spark, "anchors", anchors.write.parquet)
    return _job_output(
        spark, "anchors-parsed", lambda out: jobs.transform_anchors(spark, source, out)
    )


@query
def job_raw_pages(spark, sf_dir):
    source = _json_pages(spark, sf_dir, "none")
    return _job_output(spark, "pages", lambda out: jobs.raw_pages_to_parquet(spark, source, out))


@query
def job_quads(spark, sf_dir):
    lines = derive(spark, sf_dir, inputs.QUAD_LINES)
    source = _written(spark, "quads", lines.write.option("compression", "gzip").text)
    return _job_output(spark, "annotations", lambda out: jobs.quads_to_parquet(spark, source, out))


@query
def job_quads_members(spark, sf_dir):
    """The same from gzip files of many members."""
    lines = derive(spark, sf_dir, inputs.QUAD_LINES)
    source = _written(spark, "quads", lambda out: write_member_lines(lines, out))
    return _job_output(
        spark, "annotations", lambda out: jobs.quads_to_parquet(spark, source, out, members=True)
    )


@query
def job_wiki_links(spark, sf_dir):
    source = _tsv_links(spark, sf_dir)
    return _job_output(
        spark, "wiki-links", lambda out: jobs.wiki_links_to_parquet(spark, source, out)
    )


@query
def job_wiki_paragraphs(spark, sf_dir):
    source = _json_pages(spark, sf_dir, "gzip")
    return _job_output(
        spark, "paragraphs", lambda out: jobs.extract_wiki_paragraphs(spark, source, out)
    )


@query
def job_tweet_links(spark, sf_dir):
    source = _json_pages(spark, sf_dir, "gzip")
    return _job_output(spark, "tweets", lambda out: jobs.extract_tweet_links(spark, source, out))


@query
def job_knowledge_base(spark, sf_dir):
    tables = [
        _written(spark, name, table.write.parquet)
        for name, table in zip(("pages", "annotations", "wiki-links"), _shop(spark, sf_dir))
    ]
    dictionary = inputs.shop_dictionary(spark, sf_dir)
    mentions = _written(spark, "dictionary", dictionary.write.parquet)
    return _job_output(
        spark, "knowledge-base",
        lambda out: jobs.build_knowledge_base_by_name(spark, *tables, out, mentions),
    )


@query
def job_knowledge_base_by_page(spark, sf_dir):
    tables = _laid_out_by_page(spark, sf_dir)
    dictionary = inputs.shop_dictionary(spark, sf_dir)
    mentions = _written(spark, "dictionary", dictionary.write.parquet)
    return _job_output(
        spark, "knowledge-base",
        lambda out: jobs.build_knowledge_base_by_name(spark, *tables, out, mentions, tables=True),
    )


@query
def sink_overwrite(spark, sf_dir):
    """Writing twice with overwrite leaves the second table."""
    path = fresh_path(spark, "overwritten")
    urls = _url_pages(spark, sf_dir)
    writers.write_parquet(urls.select(F.lit("old").alias("page")), path)
    writers.write_parquet(urls, path, overwrite=True)
    return readers.read_parquet(spark, path)
