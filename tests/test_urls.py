import pytest
from pyspark.sql import functions as F

from pagelore.functions.urls import hostname, url_host
from pagelore.operators.domains import (
    compiled_rules,
    parse_suffix_rules,
    suffix_rules,
    top_private_domain,
)
from tests.conftest import rows

HOSTNAMES = {
    "http://example.com:/foo.html": "example.com",
    "http://u1.example.com:8080/a": "u1.example.com",
    "https://user:pw@h.example.org/": "user",
    "http://user@h.example.org/": "h.example.org",
    "//cdn.example.net/x": "cdn.example.net",
    "http:///p": "p",
    "http://Q.example.com?x=1/2": "Q.example.com",
    "http://Q.example.com#x@y": "Q.example.com",
    "mailto:u@example.com": "",
    "http://:80/x": "",
    "example.com/?u=http://b.example.com/": "b.example.com",
    "": "",
    "http://": "",
    "ftp://files.example.com/a//b": "files.example.com",
    None: "",
}


def test_hostname(table):
    df = table("page", [(page,) for page in HOSTNAMES])
    found = {row.page: row.host for row in df.select("page", hostname(F.col("page")).alias("host")).collect()}
    assert found == HOSTNAMES


def test_hostname_has_no_separators(table):
    df = table("page", [(page,) for page in HOSTNAMES])
    assert df.where(hostname(F.col("page")).rlike("[/:?#@]")).count() == 0


URLS = [
    "http://www.bbc.co.uk/x", "https://a.b.example.com/", "http://co.uk/", "http://host/",
    "http://a.b.invalidtld/", "http://10.0.0.7/", "not a url", "", "http://u:p@S.COM:80/",
    "http://a_b.s.com/", "http://s.ck/", "http://a.s.ck/", "http://www.ck/", "http://a.www.ck/",
    "http://kobe.jp/", "http://x.kobe.jp/", "http://a.x.kobe.jp/", "http://city.kobe.jp/",
    "http://a.city.kobe.jp/", "http://user.github.io/", "http://github.io/", "http://-bad.com/",
    "http://bad-.com/", "http://a..b.com/", "http://example.com./", "http://host./",
    "http://exämple.de/", "http://EXÄMPLE.DE/", "http://a。b。co。uk/",
    "http://bücher.example.com:8080/p?q#f", "ftp://ftp.example.org/pub", "file://server/x",
    "file:///etc/x", "mailto:u@example.com", "http:/one", "http:two", "HTTP://UP.Example.COM/",
    "  http://padded.example.com  ", "url:http://wrapped.example.com/", "http://a@b@c.com/",
    "http://h.com:port/", "http://h.com:80:81/", "http://[::1]/x", "http://[::1]:80/x",
    "http://?q=1", "http://h.com?q=http://x.co.uk/", "http://h.com#http://x.co.uk/",
    "http://" + "a" * 63 + ".com/", "http://" + "a" * 64 + ".com/",
    "http://" + ".".join(["a" * 50] * 6) + ".com/", "gopher://g.example.com/", "//x.com/",
    "http://a.b.c.d.e.f.example.co.jp/", "http://1and1.com/", "http://a.9com/", "http://com/",
    "http://x.s3.dualstack.us-east-1.amazonaws.com/", "http://h.com\\x/", "http://xn--bcher-kva.de/",
]


def _by_library(spark, url):
    """The label as the JDK's URL and the domain-name class in Spark's own jars see it."""
    jvm = spark._jvm
    try:
        host = jvm.java.net.URL(url).getHost()
    except Exception:
        return ""
    names = jvm.com.google.common.net.InternetDomainName
    if not names.isValid(host):
        return host
    name = getattr(names, "from")(host)
    if name.isPublicSuffix():
        return name.toString()
    if not name.hasPublicSuffix():
        return host[host.rfind(".") + 1:]
    return name.topPrivateDomain().parts()[0]


def test_top_private_domain_agrees_with_a_library(spark, table):
    df = top_private_domain(table("url", [(url,) for url in URLS]), "url")
    found = {row.url: row.tpd for row in df.collect()}
    assert found == {url: _by_library(spark, url) for url in URLS}


def test_rules_agree_with_a_library(spark):
    """A host below each of many shipped rules, where the library knows that rule.

    The two lists are of different age, so some rules are known to one of them only.
    """
    plain = suffix_rules(spark).where(F.col("kinds") == 1).select(
        "suffix", F.concat(F.lit("http://a.b.c."), F.col("suffix"), F.lit("/")).alias("url")
    )
    tried = top_private_domain(plain, "url").where(F.xxhash64("suffix") % 30 == 0).collect()
    parse = getattr(spark._jvm.com.google.common.net.InternetDomainName, "from")
    known = [row for row in tried if parse(row.suffix).isPublicSuffix()]
    assert len(known) > 200
    assert {row.url: row.tpd for row in known} == {
        row.url: _by_library(spark, row.url) for row in known
    }


def test_null_url_has_no_label(table):
    assert rows(top_private_domain(table("url", [(None,)]), "url")) == [(None, "")]


def test_own_rules(spark, tmp_path):
    path = tmp_path / "rules.txt"
    path.write_text("// comment\n\nzz\n*.deep.zz  trailing words\n!open.deep.zz\n")
    rules = suffix_rules(spark, str(path))
    assert rows(rules) == [("deep.zz", 2, 2), ("open.deep.zz", 3, 4), ("zz", 1, 1)]
    urls = ["http://a.b.zz/", "http://a.b.c.deep.zz/", "http://x.open.deep.zz/", "http://a.com/"]
    df = top_private_domain(spark.createDataFrame([(u,) for u in urls], "url string"), "url", rules=rules)
    assert {row.url: row.tpd for row in df.collect()} == dict(zip(urls, ["b", "b", "open", "com"]))


def test_rules_of_any_number_give_the_same(spark, table, with_conf):
    """Many rules of one last label, joined without a broadcast, with hot hosts."""
    more = spark.range(20_000).select(
        F.concat(F.lit("x"), "id", F.lit(".s"), F.col("id") % 97, F.lit(".zz")).alias("suffix"),
        F.lit(3).alias("labels"), F.lit(1).alias("kinds"),
    ).unionByName(spark.createDataFrame([("zz", 1, 1)], "suffix string, labels int, kinds int"))
    urls = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, "http://a.b.x7.s7.zz/").otherwise(
            F.concat(F.lit("http://w.v"), "id", F.lit(".x"), "id", F.lit(".s"), F.col("id") % 97, F.lit(".zz/"))
        ).alias("url")
    )
    expected = rows(top_private_domain(urls, "url", rules=more))
    assert set(expected) == {("http://a.b.x7.s7.zz/", "b")} | {
        (f"http://w.v{i}.x{i}.s{i % 97}.zz/", f"v{i}") for i in range(0, 3000, 3)
    }
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    assert rows(top_private_domain(urls, "url", rules=more)) == expected
    by_last = {r.last: r for r in compiled_rules(more).collect()}
    assert by_last["zz"].depth == 3 and sum(map(len, by_last["zz"].buckets)) == 20_001
    assert max(map(len, by_last["zz"].buckets)) < 30


def test_top_private_domain_does_not_shuffle(table):
    """One join for all rule lengths, and the urls stay where they are."""
    plan = top_private_domain(table("url", [("http://a.com/",)]), "url")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "Exchange hashpartitioning" not in text
    assert text.count("BroadcastHashJoin") == 1


@pytest.mark.parametrize(
    "url, host",
    [("http://a.com", "a.com"), ("https://u@A.com:1/", "A.com"), ("x", ""), ("http://a b/", "a b")],
)
def test_url_host(table, url, host):
    assert table("url", [(url,)]).select(url_host(F.col("url"))).first()[0] == host


def test_rule_lines(table):
    lines = table("value", [("// x",), ("",), ("com",), ("*.ck",), ("!www.ck",), ("ck",), ("COM",)])
    assert rows(parse_suffix_rules(lines)) == [("ck", 1, 3), ("com", 1, 1), ("www.ck", 2, 4)]
