"""Per-page views: counted and ranked items, lists of them, and pages joined with both.

No list is unbounded. Exact copies are counted before anything is collected, and the caller says
how many items one row holds. Pages of few rows are shuffled whole, once; only the hot ones are
ranked over many tasks.
"""

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from pagelore.sources.staging import cut_lineage

_TRIPLE = ("subject", "predicate", "obj")
_LINK = ("wikiLink",)

# Rows are counted in so many buckets of addresses to find hot pages.
_BUCKETS = 131_072
# A bucket of up to so many rows, or of four times the mean, has no hot page.
HOT_ROWS = 10_000


def group_to_join(rows: DataFrame, *keys: str) -> GroupedData:
    """``groupBy`` for a result that is joined on the same keys next.

    Spark would join such a result where it lies, and then cannot split the rows of a hot
    key on the other side. The added column follows from the keys, so the groups are the
    same, but the result counts as laid out otherwise: it goes through one more shuffle,
    after aggregation, and the join can split hot keys.
    """
    return rows.groupBy(*keys, F.xxhash64(*keys).alias("key_hash"))


def counted_triples(annotations: DataFrame) -> DataFrame:
    """(url, subject, predicate, obj, copies): each different annotation of a page once."""
    return _counted(annotations, _TRIPLE)


def counted_wikilinks(wiki_links: DataFrame) -> DataFrame:
    """(url, wikiLink, copies): each different link of a page once."""
    return _counted(wiki_links, _LINK)


def _counted(rows: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    return rows.groupBy("url", *fields).agg(F.count("*").alias("copies"))


def ranked(items: DataFrame, *fields: str) -> DataFrame:
    """Add ``rank``: the place of each item within its page, from 0, in order of the fields.

    Items of a page must differ in the fields. They are dealt out in runs by range, so that a
    page with a third of all items lies in many of them; an item's rank is its place in its
    run and page, plus the page's items in the runs before. Only pages at the borders of runs
    have any, so what is added is at most one row for each run.
    """
    runs = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = items.repartitionByRange(runs, "url", *fields)
    dealt = cut_lineage(dealt.withColumn("run", F.spark_partition_id()), "ranked-items")
    place = F.row_number().over(Window.partitionBy("run", "url").orderBy(*fields)) - 1
    counts = dealt.groupBy(F.col("url").alias("page"), F.col("run").alias("at")).agg(
        F.count("*").alias("n")
    )
    earlier = Window.partitionBy("page").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    carried = counts.select("page", "at", F.sum("n").over(earlier).alias("before"))
    carried = carried.where("before > 0")
    same = (F.col("run") == F.col("at")) & F.col("url").eqNullSafe(F.col("page"))
    return dealt.withColumn("place", place).join(carried, same, "left").select(
        *items.columns, (F.col("place") + F.coalesce("before", F.lit(0))).cast("long").alias("rank")
    )


def triples_by_page(annotations: DataFrame, part_items: int) -> DataFrame:
    """(url, part, triples): array of subject, predicate, obj, copies per page and part.

    A page's different annotations in order, ``part_items`` to a part; parts count from 0.
    """
    return _lists_by_page(annotations, _TRIPLE, "triples", part_items)


def wikilinks_by_page(wiki_links: DataFrame, part_items: int) -> DataFrame:
    """(url, part, wikilinks): array of wikiLink, copies per page and part, in the same way."""
    return _lists_by_page(wiki_links, _LINK, "wikilinks", part_items)


def _lists_by_page(
    rows: DataFrame, fields: tuple[str, ...], out: str, part_items: int
) -> DataFrame:
    hot = _hot_buckets(rows)
    lists = _whole_pages(_where_hot(rows, hot, False), fields, out, part_items)
    if not hot:
        return lists
    return lists.unionAll(_ranked_pages(_where_hot(rows, hot, True), fields, out, part_items))


def _whole_pages(rows: DataFrame, fields: tuple[str, ...], out: str, part_items: int) -> DataFrame:
    """The lists of pages that fit into a task, by one shuffle."""
    dealt = rows.select("url", *fields).repartition("url")
    lists = _counted(dealt, fields).groupBy("url").agg(_list(*fields).alias("items"))
    part = F.posexplode(_parts("items", _n_parts("items", part_items), part_items))
    return lists.select("url", part.alias("part", out)).select(
        "url", F.col("part").cast("long").alias("part"), out
    )


def _ranked_pages(rows: DataFrame, fields: tuple[str, ...], out: str, part_items: int) -> DataFrame:
    """The same for pages of any size, whose items are ranked over all tasks."""
    part = F.floor(F.col("rank") / part_items).cast("long").alias("part")
    items = ranked(_counted(rows, fields), *fields)
    return (
        items.select("url", part, F.struct(*fields, "copies").alias("item"))
        .groupBy("url", "part")
        .agg(F.sort_array(F.collect_list("item")).alias(out))
    )


def _list(*fields: str, where: Column | None = None) -> Column:
    item = F.struct(*fields, "copies")
    return F.sort_array(F.collect_list(item if where is None else F.when(where, item)))


def _n_parts(items: str, part_items: int) -> Column:
    return F.ceil(F.size(items) / part_items).cast("int")


def _parts(items: str, n: Column, part_items: int) -> Column:
    """An array of n parts of a list; those behind its end are empty."""
    return F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.slice(items, (i * F.lit(part_items) + 1).cast("int"), F.lit(part_items)),
    )


def _bucket() -> Column:
    return F.pmod(F.xxhash64("url"), F.lit(_BUCKETS))


def _hot_buckets(*tables: DataFrame) -> list[int]:
    """The buckets of addresses that may hold a hot page, usually none.

    One pass over the addresses counts all rows, exactly; it moves one number for each bucket
    and task. A page of more rows than the limit is in one of the buckets found.
    """
    urls = tables[0].select("url")
    for more in tables[1:]:
        urls = urls.unionAll(more.select("url"))
    counts = urls.groupBy(_bucket().alias("bucket")).agg(F.count("*").alias("n"))
    big = F.when(F.col("n") > HOT_ROWS, F.struct("bucket", "n"))
    total, found = counts.agg(F.sum("n"), F.collect_list(big)).first()
    limit = max(HOT_ROWS, 4 * (total or 0) / _BUCKETS)
    return sorted(b.bucket for b in found if b.n > limit)


def _where_hot(rows: DataFrame, hot: list[int], wanted: bool) -> DataFrame:
    """The rows of hot buckets, or of the others."""
    if not hot:
        return rows
    return rows.where(_bucket().isin(hot) == F.lit(wanted))


def pages_with_both(
    pages: DataFrame, annotations: DataFrame, wiki_links: DataFrame, by_page: bool = False
) -> DataFrame:
    """Pages that have annotations and links, with the number of each.

    Annotations and links are counted together before they are shuffled, so pages meet
    one small table, once. With ``by_page`` all three are tables laid out by page
    (:func:`~pagelore.sources.writers.write_by_page`), and nothing is shuffled.
    """
    if by_page:
        triples = annotations.groupBy("url").agg(F.count("*").alias("n_triples"))
        links = wiki_links.groupBy("url").agg(F.count("*").alias("n_wikilinks"))
        return pages.join(triples, "url").join(links, "url")
    items = annotations.select("url", F.lit(1).alias("triple"), F.lit(0).alias("link")).unionAll(
        wiki_links.select("url", F.lit(0).alias("triple"), F.lit(1).alias("link"))
    )
    counts = (
        group_to_join(items, "url")
        .agg(F.sum("triple").alias("n_triples"), F.sum("link").alias("n_wikilinks"))
        .where((F.col("n_triples") > 0) & (F.col("n_wikilinks") > 0))
        .drop("key_hash")
    )
    return pages.join(counts, "url")


def pages_with_lists(
    pages: DataFrame, annotations: DataFrame, wiki_links: DataFrame, part_items: int
) -> DataFrame:
    """(url, content, part, triples, wikilinks): pages that have annotations and links, joined
    with both.

    A page with at most ``part_items`` different annotations and links is one row. Others go
    on over as many rows as the longer of the two lists needs; the shorter one is empty from
    where it ends. The content is in part 0 only. Every stored copy of a page has its rows.
    """
    tables = pages, annotations, wiki_links
    hot = _hot_buckets(*tables)
    lists = _whole_pages_with_lists(*(_where_hot(t, hot, False) for t in tables), part_items)
    if not hot:
        return lists
    return lists.unionAll(
        _ranked_pages_with_lists(*(_where_hot(t, hot, True) for t in tables), part_items)
    )


def _whole_pages_with_lists(
    pages: DataFrame, annotations: DataFrame, wiki_links: DataFrame, part_items: int
) -> DataFrame:
    """For pages that fit into a task. Annotations and links are shuffled together, by page, and
    stay there: counted, collected and joined with the pages."""
    here = F.col("url").isNotNull()
    items = (
        annotations.where(here).select("url", *_TRIPLE, F.lit(False).alias("is_link"))
        .unionByName(
            wiki_links.where(here).select("url", *_LINK, F.lit(True).alias("is_link")),
            allowMissingColumns=True,
        )
        .repartition("url")
    )
    lists = (
        _counted(items, ("is_link", *_TRIPLE, *_LINK))
        .groupBy("url")
        .agg(
            _list(*_TRIPLE, where=~F.col("is_link")).alias("triples"),
            _list(*_LINK, where=F.col("is_link")).alias("wikilinks"),
        )
        .where((F.size("triples") > 0) & (F.size("wikilinks") > 0))
    )
    n = F.greatest(*(_n_parts(items, part_items) for items in ("triples", "wikilinks")))
    both = F.arrays_zip(
        _parts("triples", n, part_items).alias("triples"),
        _parts("wikilinks", n, part_items).alias("wikilinks"),
    )
    return (
        pages.select("url", "content").join(lists, "url")
        .select("url", "content", F.posexplode(both).alias("part", "lists"))
        .select(
            "url", F.when(F.col("part") == 0, F.col("content")).alias("content"),
            F.col("part").cast("long").alias("part"), "lists.triples", "lists.wikilinks",
        )
    )


def _ranked_pages_with_lists(
    pages: DataFrame, annotations: DataFrame, wiki_links: DataFrame, part_items: int
) -> DataFrame:
    """The same for pages of any size."""
    triples = _ranked_pages(annotations, _TRIPLE, "triples", part_items)
    links = _ranked_pages(wiki_links, _LINK, "wikilinks", part_items)
    nothing = [F.lit(None).cast(t.schema[c].dataType).alias(c)
               for t, c in ((triples, "triples"), (links, "wikilinks"))]
    both = triples.select("url", "part", "triples", nothing[1]).unionAll(
        links.select("url", "part", nothing[0], "wikilinks")
    )
    lists = both.groupBy("url", "part").agg(
        *(F.coalesce(F.first(c, ignorenulls=True), F.array()).alias(c) for c in ("triples", "wikilinks"))
    )
    whole = pages_with_both(pages, annotations, wiki_links).select("url", "content")
    content = F.when(F.col("part") == 0, F.col("content"))
    return whole.join(lists, "url").select(
        "url", content.alias("content"), "part", "triples", "wikilinks"
    )
