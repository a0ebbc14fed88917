"""Column layouts of the tables that the jobs read and write. Everything is text."""

from pyspark.sql.types import StringType, StructField, StructType


def _text_columns(*names: str) -> StructType:
    return StructType([StructField(name, StringType(), True) for name in names])


FEEDS_RAW = _text_columns("page", "tag", "type")
FEEDS = _text_columns("page", "tag", "type", "hostname", "rel", "href", "title")
URLS_RAW = _text_columns("page")
PAGES = _text_columns("url", "content")
ANNOTATIONS = _text_columns("subject", "predicate", "obj", "url", "tpd", "extractor")
WIKI_LINKS = _text_columns("url", "anchorText", "wikiLink")
WIKI_PARAGRAPHS = _text_columns("page", "href", "link", "paragraph")
TWEET_LINKS = _text_columns("page", "url", "query")
DICTIONARY = _text_columns("title", "mention")
MAPPINGS = _text_columns("pageUrl", "localEntityUri", "dbPediaUri")
KNOWLEDGE_BASE = _text_columns("triplePageUrl", "subject", "url", "predicate", "obj")
