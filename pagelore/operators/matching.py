"""Instance matching: which entity of the dictionary each annotated entity of a page is.

A strategy is a function ``(pages, annotations, wiki_links) -> mappings`` over whole tables;
its result has the columns pageUrl, localEntityUri and dbPediaUri. It may have a column
``copies`` as well: how many such rows a row stands for.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelore.functions.annotations import clean_name, is_name_predicate, wiki_title
from pagelore.operators.grouping import group_to_join
from pagelore.operators.prefilter import key_filter, maybe_in
from pagelore.operators.substitution import repeat_copies

Strategy = Callable[[DataFrame, DataFrame, DataFrame], DataFrame]


def name_annotations(annotations: DataFrame) -> DataFrame:
    """The annotations that give an entity its name."""
    return annotations.where(is_name_predicate(F.col("predicate")))


def page_wiki_titles(wiki_links: DataFrame) -> DataFrame:
    """Distinct (url, title); links without the article prefix have no title."""
    return _titles(wiki_links).distinct()


def _titles(wiki_links: DataFrame) -> DataFrame:
    titles = wiki_links.select("url", wiki_title(F.col("wikiLink")).alias("title"))
    return titles.where(F.col("title").isNotNull())


def _cleaned(rows: DataFrame, column: str, strip_literal: bool) -> DataFrame:
    """Add the cleaned text of a column as ``mention``; rows without text never match.

    The mention is declared to be never null. Otherwise Spark would check the result of the
    cleaning for null below each join, which runs the pattern twice.
    """
    cleaned = F.coalesce(clean_name(F.col(column), strip_literal), F.lit(""))
    return rows.where(F.col(column).isNotNull()).withColumn("mention", cleaned)


def page_mentions(
    wiki_links: DataFrame,
    dictionary: DataFrame,
    strip_literal: bool = False,
) -> DataFrame:
    """(url, mention, title): the entity each cleaned mention means on each page.

    When several titles of a page share a mention, the smallest title is taken. Spellings
    that clean to the same mention are merged before they meet the links. Links to titles that
    the dictionary does not have are left out by a filter where they are read, and not moved.
    """
    mentions = _cleaned(dictionary, "mention", strip_literal).select("title", "mention")
    titles = maybe_in(_titles(wiki_links), "title", key_filter(mentions, "title"))
    candidates = titles.distinct().join(mentions.distinct(), "title")
    return group_to_join(candidates, "url", "mention").agg(F.min("title").alias("title")).select(
        "url", "mention", "title"
    )


def match_names(names: DataFrame, mentions: DataFrame) -> DataFrame:
    """(url, subject, mention) joined with (url, mention, title) on page and mention."""
    return names.join(mentions, ["url", "mention"])


def name_exact_match(
    dictionary: DataFrame, strip_literal: bool = False, ignore_empty: bool = False,
    counted: bool = False,
) -> Strategy:
    """Strategy: an entity's cleaned name equals a cleaned mention of a title the page links.

    ``strip_literal`` ignores quotes, language tags and datatypes around names;
    ``ignore_empty`` keeps names without any word character from matching each other. Equal
    names of a page are counted before they meet its mentions and the page; ``counted`` leaves
    the mappings with their number in ``copies``.
    """

    def strategy(pages: DataFrame, annotations: DataFrame, wiki_links: DataFrame) -> DataFrame:
        names = _cleaned(name_annotations(annotations), "obj", strip_literal).select(
            "url", "subject", "mention"
        )
        if ignore_empty:
            names = names.where(F.col("mention") != "")
        names = names.groupBy("url", "subject", "mention").agg(F.count("*").alias("copies"))
        matched = match_names(names, page_mentions(wiki_links, dictionary, strip_literal))
        # An inner join, not a semi join: a page stored twice counts twice.
        mappings = matched.join(pages.select("url"), "url").select(
            F.col("url").alias("pageUrl"),
            F.col("subject").alias("localEntityUri"),
            F.col("title").alias("dbPediaUri"),
            "copies",
        )
        return mappings if counted else repeat_copies(mappings)

    return strategy
