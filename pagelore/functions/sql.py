"""The expressions of this package as functions of SQL, without Python in the plan.

``register(spark)`` makes temporary functions whose bodies Spark puts in place of each call.
"""

from pyspark.sql import SparkSession

from pagelore.fixed_values import (
    AUTHORITY,
    NAME_PREDICATE,
    NON_WORD,
    TAG_ATTRIBUTE,
    WIKI_PREFIX,
)


def _text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def _attribute(name: str) -> str:
    return f"coalesce(regexp_extract(tag, {_text(TAG_ATTRIBUTE.format(name=name))}, 1), '')"


_FLAT = r"translate({0}, '\n\r\t', '   ')"

# Name, parameter, result and body of each function.
FUNCTIONS = (
    (
        "page_hostname", "page", "STRING",
        "coalesce(substring_index(substring_index(substring_index("
        f"regexp_extract(page, {_text(AUTHORITY)}, 1), '?', 1), '#', 1), '@', -1), '')",
    ),
    ("tag_rel", "tag", "STRING", _attribute("rel")),
    ("tag_href", "tag", "STRING", _attribute("href")),
    ("tag_title", "tag", "STRING", _attribute("title")),
    ("clean_name", "name", "STRING", f"lower(trim(regexp_replace(name, {_text(NON_WORD)}, ' ')))"),
    (
        "is_name_predicate", "predicate", "BOOLEAN",
        f"endswith(lower(predicate), '/name>') AND lower(predicate) RLIKE {_text(NAME_PREDICATE)}",
    ),
    (
        "wiki_title", "link", "STRING",
        f"CASE WHEN contains(link, {_text(WIKI_PREFIX)})"
        f" THEN substring_index(link, {_text(WIKI_PREFIX)}, -1) END",
    ),
    ("flat_text", "text", "STRING", _FLAT.format("text")),
)


def register(spark: SparkSession) -> None:
    """Make or replace all functions in the session."""
    for name, parameter, result, body in FUNCTIONS:
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameter} STRING)"
            f" RETURNS {result} RETURN {body}"
        )
