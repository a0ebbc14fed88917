import time

import pytest
from pyspark.sql import functions as F

from pagelore.functions import markup
from pagelore.operators import extraction
from pagelore.operators.enrichment import parse_feeds
from tests.conftest import rows

ATTRIBUTES = [
    # tag, rel, href, title
    ('<link rel="alternate" title="red ring" href="/f/1">', "alternate", "/f/1", "red ring"),
    ("<a rel=nofollow href=/f/1 title=x>", "nofollow href=/f/1 title=x>", "/f/1 title=x>", "x>"),
    ("<a data-rel=\"first\" rel=\"second\" href='/f'>", "second", "/f", ""),
    ('<link REL="x">', "", "", ""),
    ('<a rel="q"\n href="/n">', "", "", ""),
    ('<a title="two\nlines">', "", "", "two\nlines"),
    ("", "", "", ""),
    (None, "", "", ""),
]


def test_tag_attributes(table):
    feeds = table("page tag type", [("http://h.com/", a[0], "RSS") for a in ATTRIBUTES])
    parsed = parse_feeds(feeds)
    assert parsed.columns == ["page", "tag", "type", "hostname", "rel", "href", "title"]
    found = [(r.tag, r.rel, r.href, r.title) for r in parsed.collect()]
    assert found == ATTRIBUTES
    assert parsed.select("type", "hostname").distinct().collect() == [("rss", "h.com")]


def pages(table, *contents):
    return table("url content", [(f"http://p{i}/", text) for i, text in enumerate(contents)])


WIKI = '<a class="x" href="https://en.wikipedia.org/wiki/Red_Ring">Red\n Ring </a>'


def test_wiki_links(table):
    content = (
        f'{WIKI} <A HREF=//de.m.wikipedia.org/wiki/Ring title=t><b>Ring</b></A>'
        '<a href="https://example.org/wiki/No">no</a>'
        "<a href='http://fr.wikipedia.org/w/index.php?title=Anneau'>\tAnneau</a>"
        '<a data-href="https://en.wikipedia.org/wiki/Hidden">hidden</a>'
        '<a href="https://a-very-long-sub-domain.wikipedia.org/wiki/X">far</a>'
        '<a href="https://en.wikipedia.museum/wiki/X">long ending</a>'
        + WIKI
    )
    found = [(r.href, r.link) for r in extraction.wiki_page_links(pages(table, content)).collect()]
    red = ("red  ring", "https://en.wikipedia.org/wiki/Red_Ring")
    assert found == [
        red,
        ("<b>ring</b>", "//de.m.wikipedia.org/wiki/Ring title=t"),  # no quotes
        ("anneau", "http://fr.wikipedia.org/w/index.php?title=Anneau"),
        red,
    ]


def test_tweet_links(table):
    content = (
        "see https://twitter.com/hashtag/hello and HTTP://WWW.Twitter.com/a?b=1#c "
        "\"http://twitter.com/\" 'https://twitter.com/x' ftp://twitter.com/no "
        "https://twitter\ncom/y https://twitter.com/hashtag/hello"
    )
    found = [(r.page, r.url, r.query) for r in extraction.tweet_links(pages(table, content)).collect()]
    assert found == [
        ("http://p0/", "https://twitter.com/hashtag/hello", "hashtag/hello"),
        ("http://p0/", "HTTP://WWW.Twitter.com/a?b=1", "a?b=1"),
        ("http://p0/", "http://twitter.com/", ""),
        ("http://p0/", "https://twitter.com/x", "x"),
        ("http://p0/", "https://twitter com/y", "y"),
        ("http://p0/", "https://twitter.com/hashtag/hello", "hashtag/hello"),
    ]


PARAGRAPHS = {
    "<p>one</p><p class='x'>two <b>bold</b>": ["one", "two <b>bold</b>"],
    "<p>open<p>next<div>not this</div><P\n>last</P>tail": ["open", "next", "last"],
    "<script>var t='<p>no</p>';</script><p>a<script>'</p>'</script>b</p>":
        ["a<script>'</p>'</script>b"],
    "<!-- <p>no</p> --><p>a<!-- </p> -->b</p>": ["a<!-- </p> -->b"],
    "<title><p>no</title><style><p>no</style><textarea><p>no</textarea><p>yes": ["yes"],
    "<pre>x</pre><param><picture><p>  white \n\t space  </p>": ["white space"],
    "<p>list<ul><li>x<p>in item</li></ul>": ["list", "in item"],
    "<p>cell<table><tr><td><p>inner</td></tr></table>": ["cell", "inner"],
    "<p></p><p/>": ["", ""],
    "<p>never <script>closed <p>": ["never <script>closed <p>"],
    "no paragraphs": [],
    "<p>a < b <pq>c</pq></p>": ["a < b <pq>c</pq>"],
    "<p>mark\ufdd0ed \ufdd1text</p>": ["marked text"],
}


@pytest.mark.parametrize("content", PARAGRAPHS)
def test_paragraphs(table, content):
    found = extraction.page_paragraphs(pages(table, content)).orderBy("position")
    assert [r.paragraph for r in found.collect()] == PARAGRAPHS[content]


def test_link_paragraphs(table):
    content = (
        f"<p>The RED  ring is {WIKI}.</p><p>Another red\nring</p><p>nothing</p>"
        '<a href="https://en.wikipedia.org/wiki/Blank"> </a>'
    )
    found = rows(extraction.wiki_link_paragraphs(pages(table, content)))
    # The anchor text keeps both blanks of "Red\n Ring"; the paragraphs have one.
    blank = ("http://p0/", "", "https://en.wikipedia.org/wiki/Blank")
    assert found == sorted(
        blank + (paragraph,)
        for paragraph in (
            'The RED ring is <a class="x" href="https://en.wikipedia.org/wiki/Red_Ring">Red Ring'
            " </a>.",
            "Another red ring",
            "nothing",
        )
    )


def test_link_paragraphs_are_links_times_paragraphs(spark, table):
    link = '<a href="https://en.wikipedia.org/wiki/{0}">{0}</a>'
    df = pages(table, "<p>aa bb</p><p>bb</p>" + link.format("aa") + link.format("bb") * 2)
    found = [(r.href, r.paragraph) for r in extraction.wiki_link_paragraphs(df).collect()]
    assert sorted(found) == [("aa", "aa bb")] + [("bb", "aa bb")] * 2 + [("bb", "bb")] * 2
    pairs = extraction.wiki_page_links(df).join(extraction.page_paragraphs(df), "page")
    assert extraction.wiki_link_paragraphs(df).exceptAll(
        pairs.select("page", "href", "link", "paragraph")
    ).isEmpty()


def test_link_paragraphs_of_a_page_with_many_links(table):
    """10,000 links over 3,000 paragraphs, anchors within others included: the cost is that of
    the page and what is found, not of the pairs."""
    link = '<a href="https://en.wikipedia.org/wiki/A{0}">Name {0}!</a>'
    links = "".join(link.format(i) for i in range(10_000))
    texts = [f"about NAME {7 * i % 10_000}! and name {i}!" for i in range(3000)]
    df = pages(table, links + "".join(f"<p>{t}</p>" for t in texts) + '<a href="https://en.wikipedia.org/wiki/B">ame</a>')
    started = time.monotonic()
    found = [(r.href, r.link[-6:], r.paragraph) for r in extraction.wiki_link_paragraphs(df).collect()]
    assert time.monotonic() - started < 60
    expected = [("ame", "wiki/B", t) for t in texts]
    for i, t in enumerate(texts):
        for n in {7 * i % 10_000, i}:
            expected.append((f"name {n}!", f"https://en.wikipedia.org/wiki/A{n}"[-6:], t))
    assert sorted(found) == sorted(expected)


def test_pages_without_address_or_content_are_left_out(table):
    tweet = "http://twitter.com/x"
    df = table("url content", [("u", tweet), ("", tweet), (None, tweet), ("u", ""), ("u", None)])
    assert extraction.nonempty_pages(df).count() == 1
    assert extraction.tweet_links(df).count() == 1


def test_extraction_scans_each_page_once(spark, tmp_path, table):
    """No shuffle, and no pattern stands in the plan twice for the same text."""
    path = str(tmp_path / "pages")
    pages(table, "x").write.parquet(path)
    df = spark.read.parquet(path)
    for extract in (
        extraction.tweet_links, extraction.wiki_page_links, extraction.wiki_link_paragraphs,
        extraction.page_paragraphs,
    ):
        plan = extract(df)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert plan.count("regexp_extract_all(content") <= 1
        assert plan.count("split(replace(regexp_replace(") <= 1
        assert "IsNotNull(content)" in plan


def test_empty_array_gives_no_rows(spark, table):
    df = pages(table, "nothing here")
    assert df.select(F.size(markup.wiki_links(F.col("content")))).first()[0] == 0
    assert extraction.wiki_page_links(df).isEmpty()
    assert extraction.wiki_link_paragraphs(df).isEmpty()
