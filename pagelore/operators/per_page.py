"""Matching strategies in Python that see the items of a page one after another.

All rows of a page reach one task in a fixed order, as a stream: the page, then its links and
annotations. Neither Spark, which sorts with spilling, nor this module keeps them, so a page of
any size goes through; what a strategy remembers of a page is its own affair, and the order that
it asks for can keep that small.
"""

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain, groupby
from operator import itemgetter
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelore import schemas
from pagelore.operators.matching import Strategy

Match = tuple[str, str]

# What a row of the stream is. LINKED says ahead that the page has a link.
_PAGE, _LINKED, _LINK, _TRIPLE = range(4)
_ROWS = 10_000


class Page(Protocol):
    """One page under way. Pairs are (local entity, matched entity)."""

    def add_link(self, link: str | None) -> None: ...

    def add_triple(
        self, subject: str | None, predicate: str | None, obj: str | None
    ) -> Iterable[Match] | None: ...

    def finish(self) -> Iterable[Match] | None: ...


StartPage = Callable[[str, str | None], Page]


def per_page(
    set_up: Callable[[], StartPage],
    order: Sequence[Column] | None = None,
    content: bool = True,
) -> Strategy:
    """Strategy from a class (or function) that starts a page.

    ``set_up()`` is called once per task; what it returns is called with a page's url and
    content and makes a :class:`Page`. Only pages with a link and an annotation count. A page
    stored several times gives its pairs as often; different contents of one url are pages of
    their own, under way at the same time.

    Items come with links before annotations, each sorted, or by ``order``: ascending columns
    over link, subject, predicate and obj, the latter three null for links and the first for
    annotations. Items that are to meet are best put next to each other. Without ``content`` the page texts
    are not read and are null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = set_up()
        rows = chain.from_iterable(
            zip(*(column.to_pylist() for column in batch.columns[:7])) for batch in batches
        )
        found = []
        for url, items in groupby(rows, itemgetter(0)):
            for local, entity in _page_matches(url, items, start):
                found.append((url, local, entity))
                if len(found) == _ROWS:
                    yield _batch(found)
                    found = []
        yield _batch(found)

    def strategy(pages: DataFrame, annotations: DataFrame, wiki_links: DataFrame) -> DataFrame:
        stream = _stream(pages, annotations, wiki_links, order, content)
        return stream.mapInArrow(run, schemas.MAPPINGS)

    return strategy


def _stream(
    pages: DataFrame, annotations: DataFrame, wiki_links: DataFrame,
    order: Sequence[Column] | None, content: bool,
) -> DataFrame:
    """All rows of the three tables, dealt out by url and sorted."""
    text = F.lit(None).cast("string")

    def rows(table: DataFrame, place: int, **columns: str | Column) -> DataFrame:
        fields = {name: text for name in ("content", "link", "subject", "predicate", "obj")}
        fields.update({name: F.col(c) if isinstance(c, str) else c for name, c in columns.items()})
        return table.where(F.col("url").isNotNull()).select(
            "url", F.lit(place).alias("place"), *(c.alias(name) for name, c in fields.items())
        )

    parts = [
        rows(pages, _PAGE, **({"content": "content"} if content else {})),
        rows(wiki_links, _LINK, link="wikiLink"),
        rows(annotations, _TRIPLE, subject="subject", predicate="predicate", obj="obj"),
    ]
    if order is None:
        keys, at = [], F.col("place")
    else:
        # Links may now come late, so pages that have one are marked first.
        parts.append(rows(wiki_links.select("url").distinct(), _LINKED))
        keys, at = [f"order_{i}" for i in range(len(order))], F.least("place", F.lit(_LINK))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionAll(part)
    keyed = every.select("*", at.alias("turn"), *(c.alias(k) for c, k in zip(order or (), keys)))
    fields = ("place", "link", "subject", "predicate", "obj")
    return keyed.repartition("url").sortWithinPartitions("url", "turn", "content", *keys, *fields)


def _page_matches(url: str, items: Iterable[tuple], start: StartPage) -> Iterator[Match]:
    versions: list[list] = []  # page under way, its content, copies
    linked = annotated = False
    for _, place, content, link, subject, predicate, obj in items:
        if place == _PAGE:
            if versions and versions[-1][1] == content:
                versions[-1][2] += 1
            else:
                versions.append([start(url, content), content, 1])
            continue
        linked = linked or place != _TRIPLE
        if not versions or not linked:
            return
        if place == _LINK:
            for page, _, _ in versions:
                page.add_link(link)
        elif place == _TRIPLE:
            annotated = True
            for page, _, copies in versions:
                for pair in page.add_triple(subject, predicate, obj) or ():
                    yield from (pair for _ in range(copies))
    if annotated:
        for page, _, copies in versions:
            for pair in page.finish() or ():
                yield from (pair for _ in range(copies))


def _batch(found: list[tuple[str, str, str]]) -> pa.RecordBatch:
    names = schemas.MAPPINGS.names
    columns = list(zip(*found)) if found else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names)
