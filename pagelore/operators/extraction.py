"""Links and paragraphs out of page markup. Map-only: nothing here shuffles.

Which anchor texts a paragraph mentions is found by one automaton over all anchors of the page,
run once over each paragraph; that step is Python, in Arrow batches.

``explode_outer`` plus a null check stands where ``explode`` would do: for ``explode``
Spark adds a size filter below the generator, which would run the regular expression over
every page a second time.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelore.functions import markup

_ROWS = 10_000


def nonempty_pages(pages: DataFrame) -> DataFrame:
    """Pages that have both an address and content."""
    return pages.where((F.length("content") > 0) & (F.length("url") > 0))


def _each(pages: DataFrame, items: Column, *keep: Column) -> DataFrame:
    rows = pages.select(*keep, F.explode_outer(items).alias("item"))
    return rows.where(F.col("item").isNotNull())


def wiki_page_links(pages: DataFrame) -> DataFrame:
    """(url, content) -> (page, href, link): one row per encyclopedia link, bag semantics."""
    links = _each(
        nonempty_pages(pages), markup.wiki_links(F.col("content")), F.col("url").alias("page")
    )
    return links.select(
        "page",
        markup.wiki_link_anchor(F.col("item")).alias("href"),
        markup.wiki_link_target(F.col("item")).alias("link"),
    )


def page_paragraphs(pages: DataFrame) -> DataFrame:
    """(url, content) -> (page, position, paragraph), positions from 0 in document order."""
    rows = nonempty_pages(pages).select(
        F.col("url").alias("page"),
        F.posexplode_outer(markup.paragraphs(F.col("content"))).alias("position", "paragraph"),
    )
    return rows.where(F.col("paragraph").isNotNull())


def wiki_link_paragraphs(pages: DataFrame) -> DataFrame:
    """(url, content) -> (page, href, link, paragraph): links with the paragraphs that
    mention their anchor text.

    Paragraphs are cut only in pages that have a link, and stay with their page, whose links
    are all searched for at once: the cost is the length of the page plus what is found.
    """
    with_links = nonempty_pages(pages).select(
        F.col("url").alias("page"), "content", markup.wiki_links(F.col("content")).alias("links")
    )
    link = lambda element: F.struct(
        markup.wiki_link_anchor(element).alias("href"), markup.wiki_link_target(element).alias("link")
    )
    searchable = with_links.select(
        "page",
        F.transform("links", link).alias("links"),
        F.when(F.size("links") > 0, _searchable(F.col("content"))).alias("paragraphs"),
    )
    return searchable.mapInArrow(_mentions, "page string, href string, link string, paragraph string")


def _searchable(content: Column) -> Column:
    return F.transform(
        markup.paragraphs(content),
        lambda p: F.struct(p.alias("paragraph"), F.lower(p).alias("lowered")),
    )


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("page", "href", "link", "paragraph")
    found: list[tuple[str, str, str, str]] = []

    def made() -> pa.RecordBatch:
        columns = list(zip(*found)) or [()] * len(names)
        found.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], list(names))

    for batch in batches:
        for page, links, paragraphs in zip(*batch.columns):
            if not links or not paragraphs.is_valid:
                continue
            by_anchor: dict[str, list[str]] = {}
            for href, link in _pairs(links):
                by_anchor.setdefault(href, []).append(link)
            url = page.as_py()
            for paragraph, anchors in _paragraph_anchors(by_anchor, _pairs(paragraphs)):
                for anchor in anchors:
                    for link in by_anchor[anchor]:
                        found.append((url, anchor, link, paragraph))
                        if len(found) == _ROWS:
                            yield made()
    yield made()


def _pairs(items: pa.ListScalar) -> Iterator[tuple[str, str]]:
    return zip(*(field.to_pylist() for field in items.values.flatten()))


def _paragraph_anchors(
    anchors: dict[str, list[str]], paragraphs: Iterator[tuple[str, str]]
) -> Iterator[tuple[str, set[str]]]:
    """Each paragraph with the anchor texts that its lower-case form contains."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for anchor in anchors:
        if anchor:
            automaton.add_word(anchor, anchor)
    automaton.make_automaton()
    everywhere = {""} & anchors.keys()
    for paragraph, lowered in paragraphs:
        mentioned = set(everywhere)
        if len(automaton):
            mentioned.update(anchor for _, anchor in automaton.iter(lowered))
        yield paragraph, mentioned


def tweet_links(pages: DataFrame) -> DataFrame:
    """(url, content) -> (page, url, query): one row per tweet or profile address."""
    links = _each(
        nonempty_pages(pages), markup.tweet_links(F.col("content")), F.col("url").alias("page")
    )
    return links.select(
        "page",
        markup.tweet_url(F.col("item")).alias("url"),
        markup.tweet_query(F.col("item")).alias("query"),
    )
