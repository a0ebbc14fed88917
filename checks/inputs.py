"""Inputs in the shape the operators expect, derived from whole tables.

Each text below is SQL that Spark and DuckDB both read; table names stand in braces. The
``CASE`` on a key gives every row one of several shapes; no row is left out by its key.
The tables of the shop come from several unions in SQL; Spark makes them in one scan.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns in use. With a given schema Spark opens no file before the query runs.
TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "events": "event_id bigint, user_id bigint",
    "nation": "n_nationkey int, n_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderpriority string",
    "pages": "page_id bigint, url string, html string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "supplier": "s_suppkey bigint",
}

EDGE_URLS = """
SELECT event_id,
  CASE event_id % 10
    WHEN 0 THEN 'http://u' || cast(user_id as string) || '.example.com:8080/a'
    WHEN 1 THEN 'https://u' || cast(user_id as string) || ':pw@h.example.org/'
    WHEN 2 THEN 'http://u' || cast(user_id as string) || '@h.example.org/'
    WHEN 3 THEN '//cdn' || cast(user_id as string) || '.example.net/x'
    WHEN 4 THEN 'http:///p' || cast(user_id as string)
    WHEN 5 THEN 'http://Q' || cast(user_id as string) || '.example.com?x=1/2'
    WHEN 6 THEN 'mailto:u' || cast(user_id as string) || '@example.com'
    WHEN 7 THEN 'http://:80/' || cast(user_id as string)
    WHEN 8 THEN 'example.com/?u=http://b' || cast(user_id as string) || '.example.com/'
  END AS page
FROM {events}
"""

FEED_TAGS = """
SELECT
  'http://www.shop' || cast(p_size as string) || '.example.com/p/' || cast(p_partkey as string)
    AS page,
  CASE p_partkey % 5
    WHEN 0 THEN '<link rel="alternate" title="' || p_name || '" href="/f/'
      || cast(p_partkey as string) || '">'
    WHEN 1 THEN '<a rel=nofollow href=/f/' || cast(p_partkey as string) || ' title=x>'
    WHEN 2 THEN '<a data-rel="first" rel="second" href=''/f''>'
    WHEN 3 THEN '<link REL="x">'
    ELSE '<a rel="q"' || chr(10) || ' href="/n">'
  END AS tag,
  upper(p_type) AS type
FROM {part}
"""

QUAD_LINES = """
SELECT
  CASE c_custkey % 6
    WHEN 0 THEN '_:c' || cast(c_custkey as string) || ' <http://schema.org/Person/name> "'
      || c_name || ' <b>"@en <http://example.com/c/' || cast(c_custkey as string)
      || '> <ex:html-microdata> .'
    WHEN 1 THEN '<http://example.com/#' || cast(c_custkey as string)
      || '> <HTTP://schema.org/name> "' || c_name || '" <http://shop.example.co.uk/c/> <ex:rdfa> .'
    WHEN 2 THEN '_:c <http://schema.org/Person/jobTitle> "x"  <http://example.com/> <ex:rdfa> .'
    WHEN 3 THEN '_:c <http://schema.org/a/b/name> "x" <http://example.com/> <ex:rdfa> . '
    WHEN 4 THEN 'junk ' || c_name
    ELSE ''
  END AS value
FROM {customer}
"""

HOST_URLS = """
SELECT url FROM {pages}
UNION ALL
SELECT
  CASE s_suppkey % 12
    WHEN 0 THEN 'http://www.s' || cast(s_suppkey as string) || '.co.uk/x'
    WHEN 1 THEN 'https://a.b.s' || cast(s_suppkey as string) || '.com/'
    WHEN 2 THEN 'http://co.uk/'
    WHEN 3 THEN 'http://host' || cast(s_suppkey as string) || '/'
    WHEN 4 THEN 'http://a.s' || cast(s_suppkey as string) || '.invalidtld/'
    WHEN 5 THEN 'http://10.0.0.' || cast(s_suppkey as string) || '/'
    WHEN 6 THEN 'not a url ' || cast(s_suppkey as string)
    WHEN 7 THEN 'http://u:p@S' || cast(s_suppkey as string) || '.COM:80/'
    WHEN 8 THEN 'http://a_b.s' || cast(s_suppkey as string) || '.com/'
    WHEN 9 THEN 'http://a.b.s' || cast(s_suppkey as string) || '.ck/'
    WHEN 10 THEN 'http://s' || cast(s_suppkey as string) || '.www.ck'
    ELSE 'https://s' || cast(s_suppkey as string) || '.city.kobe.jp?x'
  END AS url
FROM {supplier}
"""

NAMES = """
SELECT '  ' || p_name || ' -- (' || p_brand || ')! ' || p_type AS name FROM {part}
UNION ALL
SELECT '"' || c_name || '_' || lower(c_mktsegment) || '"@en' AS name FROM {customer}
UNION ALL
SELECT url AS name FROM {pages}
"""

SPARSE_PAGES = """
SELECT page_id,
  CASE page_id % 7 WHEN 3 THEN NULL WHEN 5 THEN '' ELSE url END AS url,
  CASE page_id % 5 WHEN 2 THEN NULL WHEN 4 THEN '' ELSE html END AS content
FROM {pages}
"""

LINKED_PAGES = """
SELECT url,
  replace(
    replace(html, '<li><a href="/', '<li><a href="https://en.wikipedia.org/wiki/'),
    '<div class="ad">',
    '<div class="ad">https://www.twitter.com/hashtag/p' || cast(page_id as string) || '?s=1#f '
  ) AS content
FROM {pages}
"""

SHOP = """
SELECT o_orderkey AS k, c_custkey AS c, c_name, n_name, o_orderpriority, o_orderstatus,
  o_totalprice, c_mktsegment,
  'http://shop' || cast(c_custkey % 7 as string) || '.example.com/o/'
    || cast(o_orderkey as string) AS url
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
"""

# The page of an order that is still pending has another address than what is said of it.
SHOP_PAGES = f"""
SELECT CASE WHEN o_orderstatus = 'P' THEN 'http://pending.example.com/o/' || cast(k as string)
    ELSE url END AS url,
  '<p>Order ' || cast(k as string) || '</p>' AS content
FROM ({SHOP}) shop
"""

# Every order has one or more of: a link to its customer (twice if urgent), one to another
# article on the same customer, one to the order and one that leads elsewhere.
SHOP_LINKS = f"""
SELECT url, c_name AS "anchorText", 'https://en.wikipedia.org/wiki/Cust_' || cast(c as string)
  AS "wikiLink" FROM ({SHOP}) a WHERE o_orderpriority <> '5-LOW'
UNION ALL
SELECT url, 'again', 'https://en.wikipedia.org/wiki/Cust_' || cast(c as string)
  FROM ({SHOP}) b WHERE o_orderpriority = '1-URGENT'
UNION ALL
SELECT url, 'also', 'https://en.wikipedia.org/wiki/Acust_' || cast(c as string)
  FROM ({SHOP}) d WHERE c_mktsegment = 'BUILDING'
UNION ALL
SELECT url, 'order', 'http://m.wikipedia.org/wiki/Order_' || cast(k as string)
  FROM ({SHOP}) e WHERE o_totalprice > 250000
UNION ALL
SELECT url, 'none', 'https://example.org/none'
  FROM ({SHOP}) f WHERE c_mktsegment = 'MACHINERY'
"""

SHOP_ANNOTATIONS = f"""
SELECT url, '_:o' || cast(k as string) AS subject, '<http://schema.org/Order/customer>'
  AS predicate, '_:c' || cast(c as string) AS obj FROM ({SHOP}) a
UNION ALL
SELECT url, '_:c' || cast(c as string), '<http://schema.org/Person/name>', '"' || c_name || '"'
  FROM ({SHOP}) b
UNION ALL
SELECT url, '_:o' || cast(k as string), '<http://schema.org/name>',
  '"Order ' || cast(k as string) || '"' FROM ({SHOP}) d
UNION ALL
SELECT url, '_:c' || cast(c as string), '<http://schema.org/Person/nationality>',
  '"' || n_name || '"' FROM ({SHOP}) e
"""

SHOP_DICTIONARY = """
SELECT 'Cust_' || cast(c_custkey as string) AS title, c_name AS mention FROM {customer}
UNION ALL
SELECT 'Cust_' || cast(c_custkey as string), lower(c_name) || '!' FROM {customer}
UNION ALL
SELECT 'Acust_' || cast(c_custkey as string), c_name FROM {customer}
UNION ALL
SELECT 'Order_' || cast(o_orderkey as string), 'order-' || cast(o_orderkey as string)
FROM {orders}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run one of the texts above over the Parquet tables of a folder."""
    tables = {name: table(spark, sf_dir, name) for name in TABLES if f"{{{name}}}" in text}
    return spark.sql(text, **tables)


def _variants(rows: DataFrame, names: tuple[str, ...], *variants) -> DataFrame:
    """Several rows per address: each variant is a condition (or None) and column values.

    Rows are repeated by the number of their variant, so that Spark reads and makes only the
    columns that are used.
    """
    numbers = [
        F.lit(i) if condition is None else F.when(condition, F.lit(i))
        for i, (condition, *_) in enumerate(variants)
    ]
    spread = rows.withColumn("variant", F.explode(F.array_compact(F.array(*numbers))))
    columns = zip(*(values for _, *values in variants))
    return spread.select("url", *(_chosen(c).alias(name) for name, c in zip(names, columns)))


def _chosen(values: tuple[str | Column, ...]) -> Column:
    """The value of the row's variant."""
    chosen = _column(values[-1])
    for i, value in reversed([*enumerate(values[:-1])]):
        chosen = F.when(F.col("variant") == i, _column(value)).otherwise(chosen)
    return chosen


def _column(value: str | Column) -> Column:
    return F.lit(value) if isinstance(value, str) else value


def _text(before: str, column: str, after: str = "") -> Column:
    return F.concat(F.lit(before), F.col(column).cast("string"), F.lit(after))


def shop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, SHOP)


def shop_pages(shop: DataFrame) -> DataFrame:
    pending = F.col("o_orderstatus") == "P"
    url = F.when(pending, _text("http://pending.example.com/o/", "k")).otherwise(F.col("url"))
    return shop.select(url.alias("url"), _text("<p>Order ", "k", "</p>").alias("content"))


def shop_links(shop: DataFrame) -> DataFrame:
    customer = _text("https://en.wikipedia.org/wiki/Cust_", "c")
    return _variants(
        shop,
        ("anchorText", "wikiLink"),
        (F.col("o_orderpriority") != "5-LOW", F.col("c_name"), customer),
        (F.col("o_orderpriority") == "1-URGENT", "again", customer),
        (
            F.col("c_mktsegment") == "BUILDING",
            "also",
            _text("https://en.wikipedia.org/wiki/Acust_", "c"),
        ),
        (F.col("o_totalprice") > 250000, "order", _text("http://m.wikipedia.org/wiki/Order_", "k")),
        (F.col("c_mktsegment") == "MACHINERY", "none", "https://example.org/none"),
    )


def shop_annotations(shop: DataFrame) -> DataFrame:
    order, customer = _text("_:o", "k"), _text("_:c", "c")
    return _variants(
        shop,
        ("subject", "predicate", "obj"),
        (None, order, "<http://schema.org/Order/customer>", customer),
        (None, customer, "<http://schema.org/Person/name>", _text('"', "c_name", '"')),
        (None, order, "<http://schema.org/name>", _text('"Order ', "k", '"')),
        (None, customer, "<http://schema.org/Person/nationality>", _text('"', "n_name", '"')),
    )


def shop_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, SHOP_DICTIONARY)


def for_duckdb(text: str) -> str:
    return text.format(**{name: name for name in TABLES})
