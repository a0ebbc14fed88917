import pytest
from pyspark.sql import functions as F

from pagelore.operators import matching
from pagelore.operators.prefilter import key_filter, maybe_in
from tests.conftest import rows

WIKI = "https://en.wikipedia.org/wiki/"


def keys(spark, first, last, step=1):
    return spark.range(first, last, step, 8).select(F.concat(F.lit("k"), "id").alias("key"))


@pytest.mark.parametrize("n", [1, 100, 50_000])
def test_no_key_is_lost(spark, n):
    known = keys(spark, 0, n)
    kept = maybe_in(keys(spark, 0, 2 * n), "key", key_filter(known, "key"))
    assert kept.join(known, "key", "left_semi").count() == n
    assert kept.count() - n <= max(1, n * 0.03)


def test_a_full_filter_loses_nothing(spark):
    """Half of the keys that the smallest filter is made for would fill it."""
    known = keys(spark, 0, 40_000)
    small = key_filter(known, "key", most_bytes=4096)
    assert small.blocks == 1
    kept = maybe_in(keys(spark, 0, 80_000), "key", small)
    assert kept.join(known, "key", "left_semi").count() == 40_000


def test_nulls_copies_and_empty_tables(table):
    known = table("key", [("a",), (None,), ("a",), ("",)])
    some = table("key other", [("a", "1"), ("a", "1"), (None, "2"), ("", "3"), ("b", "4")])
    assert rows(maybe_in(some, "key", key_filter(known, "key"))) == [
        ("", "3"), ("a", "1"), ("a", "1"),
    ]
    nothing = known.where("false")
    assert maybe_in(some, "key", key_filter(nothing, "key")).count() == 0
    assert maybe_in(some.where("false"), "key", key_filter(known, "key")).count() == 0


def test_links_without_a_known_title_are_not_moved(spark, table, tmp_path):
    dictionary = table("title mention", [(f"Known_{i}", f"name {i}") for i in range(50)])
    title = F.when(F.col("id") % 100 == 0, F.concat(F.lit("Known_"), F.col("id") % 50))
    title = F.coalesce(title, F.concat(F.lit("Other_"), "id"))
    links = spark.range(0, 100_000, 1, 8).select(
        F.concat(F.lit("p"), F.col("id") % 1000).alias("url"), F.lit("x").alias("anchorText"),
        F.concat(F.lit(WIKI), title).alias("wikiLink"),
    )
    links.write.parquet(str(tmp_path / "links"))
    stored = spark.read.parquet(str(tmp_path / "links"))
    found = matching.page_mentions(stored, dictionary)
    found.collect()
    moved = _rows_moved(found, "url")
    titles = matching.page_wiki_titles(stored)
    titles.collect()
    assert _rows_moved(titles, "url") > 99_000
    assert moved < 5_000


def _rows_moved(df, column):
    """Rows of the largest shuffle that carries a column."""
    most, waiting = 0, [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            waiting.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage"):
            waiting.append(node.plan())
            continue
        if node.nodeName() == "Exchange" and f"{column}#" in node.output().toString():
            written = node.metrics().get("shuffleRecordsWritten")
            most = max(most, written.get().value())
        children = node.children()
        waiting.extend(children.apply(i) for i in range(children.size()))
    return most


def test_counted_names_give_the_same_mappings(table):
    name = "<http://schema.org/name>"
    pages = table("url content", [("p", "x"), ("p", "x"), ("q", "y")])
    annotations = table(
        "subject predicate obj url",
        [("_:a", name, '"Ann"', "p")] * 3 + [("_:a", name, '"ann!"', "p"), (None, name, '"Ann"', "q")],
    )
    links = table("url anchorText wikiLink", [("p", "", WIKI + "A"), ("q", "", WIKI + "A")])
    dictionary = table("title mention", [("A", "ann")])
    parts = (pages, annotations, links)
    expected = [("p", "_:a", "A")] * 8 + [("q", None, "A")]
    assert rows(matching.name_exact_match(dictionary)(*parts)) == expected
    counted = matching.name_exact_match(dictionary, counted=True)(*parts)
    assert rows(counted) == [("p", "_:a", "A", 4)] * 2 + [("q", None, "A", 1)]
