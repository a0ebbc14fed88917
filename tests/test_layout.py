"""Tables laid out by page, overwriting, counts of bad input, and functions of SQL."""

import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from checks import inputs, queries
from pagelore.functions import annotations, markup, text, urls
from pagelore.functions import sql as sql_functions
from pagelore.operators import grouping
from pagelore.operators.matching import name_exact_match
from pagelore.plans import jobs
from pagelore.plans.sizing import joined_by_page
from pagelore.sources import writers
from tests.conftest import rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def laid_out(spark, tmp_path):
    """(table, table by page) of pages, annotations and links."""
    shop = inputs.shop(spark, SF_DIR)
    parts = inputs.shop_pages(shop), inputs.shop_annotations(shop), inputs.shop_links(shop)
    found = []
    for part in parts:
        name = f"t_{uuid.uuid4().hex}"
        writers.write_by_page(part, name, 16, path=str(tmp_path / name))
        found.append((part, spark.table(name), name))
    yield found
    for _, _, name in found:
        spark.sql(f"DROP TABLE {name}")


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")


def test_joins_by_page_do_not_shuffle(laid_out, with_conf):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plain, by_page = [x[0] for x in laid_out], [x[1] for x in laid_out]
    joined = grouping.pages_with_both(*by_page, by_page=True)
    assert exchanges(joined) == 0
    assert rows(joined) == rows(grouping.pages_with_both(*plain))


def test_knowledge_base_over_tables_by_page(spark, laid_out, tmp_path, with_conf):
    """Same rows; annotations and pages stay where they are."""
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    dictionary = inputs.shop_dictionary(spark, SF_DIR)
    out, names = str(tmp_path / "kb"), [x[2] for x in laid_out]
    jobs.build_knowledge_base(spark, *names, out, name_exact_match(dictionary), tables=True)
    plain = jobs.knowledge_base(*(x[0] for x in laid_out), name_exact_match(dictionary))
    assert rows(spark.read.parquet(out)) == rows(plain)
    strategy, tables = name_exact_match(dictionary), [x[1] for x in laid_out]
    with joined_by_page(spark):
        fewer = exchanges(strategy(*tables))
    assert fewer <= exchanges(strategy(*(x[0] for x in laid_out))) - 2
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_tables_of_the_shop_share_one_join(spark):
    """The join is staged; each table then starts from its rows."""
    shop = inputs.shop(spark, SF_DIR)
    apart = inputs.shop_pages(shop), inputs.shop_annotations(shop), inputs.shop_links(shop)
    for staged, plain in zip(queries._shop(spark, SF_DIR), apart):
        assert "Join" not in staged._jdf.queryExecution().executedPlan().toString()
        assert rows(staged) == rows(plain)


def test_jobs_write_tables_by_page(spark, tmp_path):
    quads = tmp_path / "quads"
    line = '_:a <http://schema.org/Person/name> "Ann" <http://www.a.co.uk/> <ex:rdfa> .'
    spark.createDataFrame([(line,), (line.replace("www.a", "b"),), ("junk",)], "value string").write.text(str(quads))
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    try:
        report = jobs.quads_to_parquet(spark, str(quads), name, on_error="drop", buckets=4)
        assert report == {"rows": 2, "bad_lines": 1}
        described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        assert described["Num Buckets"] == "4" and "url" in described["Bucket Columns"]
        assert spark.table(name).count() == 2
        with pytest.raises(PySparkException):
            jobs.quads_to_parquet(spark, str(quads), name, buckets=4)
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_counts_of_bad_input(spark, tmp_path):
    lines = tmp_path / "links"
    spark.createDataFrame([("a\tb\tc",), ("a\tb",), ("",), ("d\te\tf\t",)], "value string").write.text(str(lines))
    assert jobs.wiki_links_to_parquet(spark, str(lines), str(tmp_path / "1"), on_bad="drop") == {
        "rows": 2, "bad_lines": 2,
    }
    quads = str(tmp_path / "quads")
    spark.createDataFrame([("junk",), ("",)], "value string").write.text(quads)
    assert jobs.quads_to_parquet(spark, quads, str(tmp_path / "2")) == {"rows": 2, "bad_lines": 2}
    feeds = [("http://a.com/", '<link rel="x">', "rss"), ("mailto:x", "<a href=/f title=t>", "rss")]
    spark.createDataFrame(feeds, "page string, tag string, type string").write.option("escape", '"').csv(
        str(tmp_path / "feeds")
    )
    assert jobs.transform_feeds(spark, str(tmp_path / "feeds"), str(tmp_path / "3")) == {
        "rows": 2, "no_hostname": 1, "no_rel": 1, "no_href": 1, "no_title": 1,
    }
    pages = spark.createDataFrame([("http://a.com/",), (None,), ("x",)], "page string")
    pages.write.parquet(str(tmp_path / "pages"))
    assert jobs.transform_urls(spark, str(tmp_path / "pages"), str(tmp_path / "4")) == {"rows": 3, "no_hostname": 2}


def test_overwrite_keeps_the_old_table_until_the_new_one_is_whole(spark, tmp_path):
    path = str(tmp_path / "table")
    writers.write_parquet(spark.range(5), path, overwrite=True)
    broken = spark.range(10).select(
        F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id")
    )
    with pytest.raises(PySparkException):
        writers.write_parquet(broken, path, overwrite=True)
    assert rows(spark.read.parquet(path)) == [(i,) for i in range(5)]
    assert [p.name for p in tmp_path.iterdir()] == ["table"]
    # A job may read what it replaces.
    writers.write_parquet(spark.read.parquet(path).select((F.col("id") + 100).alias("id")), path, overwrite=True)
    assert rows(spark.read.parquet(path)) == [(i,) for i in range(100, 105)]
    assert [p.name for p in tmp_path.iterdir()] == ["table"]


VALUES = [
    None, "", "http://u:p@A.com:80/x?y#z", "//cdn.example.net/x", "http:///p", "a@b//c?d#e", "mailto:x",
    '<link rel="a" data-rel=\'b\' href=/x title="t\\t">', "<a\nhref='q'>", '"Ann  Lee"@en', "  é--x_1  ",
    "<http://schema.org/Person/name>", "<HTTP://schema.org/name>", "<http://schema.org/a/b/name>",
    "https://en.wikipedia.org/wiki/A_b/wikipedia.org/wiki/C", "no\tprefix\r\n here", "wikipedia.org/wiki/",
]


def test_functions_of_sql_agree(spark, table):
    sql_functions.register(spark)
    sql_functions.register(spark)
    values = table("v", [(v,) for v in VALUES])
    pairs = {
        "page_hostname": urls.hostname(F.col("v")),
        "tag_rel": markup.tag_attr(F.col("v"), "rel"),
        "tag_href": markup.tag_attr(F.col("v"), "href"),
        "tag_title": markup.tag_attr(F.col("v"), "title"),
        "clean_name": annotations.clean_name(F.col("v")),
        "is_name_predicate": annotations.is_name_predicate(F.col("v")),
        "wiki_title": annotations.wiki_title(F.col("v")),
        "flat_text": text.flatten_whitespace(F.col("v")),
    }
    assert set(pairs) == {f[0] for f in sql_functions.FUNCTIONS}
    called = spark.sql("SELECT v, " + ", ".join(f"{n}(v) AS {n}" for n in pairs) + " FROM {t}", t=values)
    plan = called._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    expected = values.select("v", *(c.alias(n) for n, c in pairs.items()))
    assert rows(called) == rows(expected)
