import gzip
import json

import pytest
from pyspark.errors import PySparkException

from pagelore import __main__ as command_line
from pagelore import schemas
from pagelore.operators.matching import name_exact_match
from pagelore.plans import jobs, sizing
from pagelore.streaming import ingest
from tests.conftest import rows

QUAD = '_:a <http://schema.org/Person/name> "Ann" <http://www.a.co.uk/> <ex:rdfa> .'
ANNOTATION = (
    "_:a", "<http://schema.org/Person/name>", '"Ann"', "http://www.a.co.uk/", "a", "<ex:rdfa>"
)
CONTENT = (
    '<p>About Ann: <a href="https://en.wikipedia.org/wiki/Ann">Ann</a></p>'
    "<p>https://twitter.com/ann</p>"
)
LINK = "https://en.wikipedia.org/wiki/Ann"


@pytest.fixture
def run(spark, monkeypatch):
    """Run a job from the command line in the session of the tests."""
    monkeypatch.setattr(command_line, "build_session", lambda name: spark)

    def call(*arguments):
        command_line.main([str(argument) for argument in arguments])

    return call


@pytest.fixture
def put(tmp_path):
    def write(name, *lines):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True, parents=True)
        opened = gzip.open(path, "wt") if name.endswith(".gz") else open(path, "w")
        with opened as file:
            file.write("".join(line + "\n" for line in lines))
        return str(path)

    return write


def page_line(url, content):
    return json.dumps({"url": url, "content": content})


def test_feeds(spark, run, put, tmp_path):
    put("feeds/1.csv.gz", 'http://a.com/,"<link rel=""x"" title=""t"">",RSS')
    put("feeds/2.csv.gz", "http://b.com/,<a href=/f>,Atom")
    run("feeds", tmp_path / "feeds/*.csv.gz", tmp_path / "out")
    df = spark.read.parquet(str(tmp_path / "out"))
    assert df.columns == schemas.FEEDS.names
    assert rows(df) == [
        ("http://a.com/", '<link rel="x" title="t">', "rss", "a.com", "x", "", "t"),
        ("http://b.com/", "<a href=/f>", "atom", "b.com", "", "/f>", ""),
    ]


def test_urls_and_anchors(spark, run, put, tmp_path):
    put("urls/1.csv.gz", "http://a.com/x", "mailto:x")
    run("urls-csv", tmp_path / "urls/*.csv.gz", tmp_path / "urls.parquet", "--files", 1000)
    run("urls", tmp_path / "urls.parquet", tmp_path / "parsed")
    expected = [("http://a.com/x", "a.com"), ("mailto:x", "")]
    assert rows(spark.read.parquet(str(tmp_path / "parsed"))) == expected
    run("anchors", tmp_path / "parsed", tmp_path / "again")
    assert rows(spark.read.parquet(str(tmp_path / "again"))) == expected


def test_compaction(spark, run, tmp_path):
    spark.range(100, numPartitions=10).write.parquet(str(tmp_path / "many"))
    run("compact", tmp_path / "many", tmp_path / "few", "--files", 2)
    run("compact", tmp_path / "many", tmp_path / "one")
    for name, files in (("few", 2), ("one", 1)):
        df = spark.read.parquet(str(tmp_path / name))
        assert (df.count(), len(df.inputFiles())) == (100, files)


def test_jobs_do_not_write_over_a_table(run, tmp_path, spark):
    spark.range(1).write.parquet(str(tmp_path / "in"))
    run("compact", tmp_path / "in", tmp_path / "out")
    with pytest.raises(PySparkException):
        run("compact", tmp_path / "in", tmp_path / "out")


def test_raw_pages(spark, run, put, tmp_path):
    path = put("pages.json", page_line("u", "c"), json.dumps({"url": "v", "content": "d", "n": 1}))
    run("raw-pages", path, tmp_path / "out")
    everything = spark.read.parquet(str(tmp_path / "out"))
    assert rows(everything.select("url", "content", "n")) == [("u", "c", None), ("v", "d", 1)]


def test_quads(spark, run, put, tmp_path):
    path = put("quads.gz", QUAD, "junk")
    run("quads", path, tmp_path / "out")
    df = spark.read.parquet(str(tmp_path / "out"))
    assert df.columns == schemas.ANNOTATIONS.names
    assert rows(df) == [ANNOTATION, ("match_error", "", "", "", "", "")]
    rules = put("rules.txt", "uk")
    run("quads", path, tmp_path / "own", "--on-error", "drop", "--rules-path", rules)
    assert [row.tpd for row in spark.read.parquet(str(tmp_path / "own")).collect()] == ["co"]


def test_page_jobs(spark, run, put, tmp_path):
    path = put("pages.json.gz", page_line("http://a/", CONTENT), "{broken", page_line("", CONTENT))
    run("wiki-paragraphs", path, tmp_path / "paragraphs", "--on-bad", "drop")
    paragraph = f'About Ann: <a href="{LINK}">Ann</a>'
    df = spark.read.parquet(str(tmp_path / "paragraphs"))
    assert df.columns == schemas.WIKI_PARAGRAPHS.names
    assert rows(df) == [
        ("http://a/", "ann", LINK, paragraph),
        ("http://a/", "ann", LINK, "https://twitter.com/ann"),
    ]
    run("tweet-links", path, tmp_path / "tweets", "--on-bad", "drop")
    df = spark.read.parquet(str(tmp_path / "tweets"))
    assert df.columns == schemas.TWEET_LINKS.names
    # The address runs up to white space, a quote or "#", so it takes markup with it.
    assert rows(df) == [("http://a/", "https://twitter.com/ann</p>", "ann</p>")]
    with pytest.raises(Exception, match="FAILFAST"):
        run("tweet-links", path, tmp_path / "none", "--on-bad", "fail")


def test_knowledge_base(spark, run, put, tmp_path):
    run("raw-pages", put("pages.json", page_line("http://www.a.co.uk/", "x")), tmp_path / "pages")
    friend = "_:b <http://schema.org/knows> _:a <http://www.a.co.uk/> <ex:rdfa> ."
    run("quads", put("quads.nq", QUAD, friend, QUAD.replace("_:a", "_:b"), "junk"), tmp_path / "quads")
    run("wiki-links", put("links.tsv", f"http://www.a.co.uk/\tAnn\t{LINK}"), tmp_path / "links")
    spark.createDataFrame([("Ann", "ann")], schemas.DICTIONARY).write.parquet(str(tmp_path / "d"))
    inputs = [tmp_path / name for name in ("pages", "quads", "links")]
    page = "http://www.a.co.uk/"
    expected = [
        (page, "Ann", page, "<http://schema.org/Person/name>", '"Ann"'),
        (page, "Ann", page, "<http://schema.org/Person/name>", '"Ann"'),
        (page, "Ann", page, "<http://schema.org/knows>", "Ann"),
    ]
    for _ in range(2):  # the second run replaces the first
        run("knowledge-base", *inputs, tmp_path / "kb", tmp_path / "d")
        df = spark.read.parquet(str(tmp_path / "kb"))
        assert df.columns == schemas.KNOWLEDGE_BASE.names
        assert rows(df) == expected
    strategy = name_exact_match(spark.read.parquet(str(tmp_path / "d")))
    jobs.build_knowledge_base(spark, *map(str, inputs), str(tmp_path / "kb2"), strategy)
    assert rows(spark.read.parquet(str(tmp_path / "kb2"))) == expected


def test_wiki_links(spark, run, put, tmp_path):
    path = put("links.tsv", "u\tt\tw", "bad")
    with pytest.raises(PySparkException, match="not three fields"):
        run("wiki-links", path, tmp_path / "none")
    run("wiki-links", path, tmp_path / "out", "--on-bad", "drop")
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [("u", "t", "w")]


def test_shuffles_are_sized_by_the_input(spark, put, tmp_path, monkeypatch):
    path = put("in/1", "x" * 999)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert sizing.shuffle_partitions(spark, path) == int(before)
    monkeypatch.setattr(sizing, "BYTES_PER_PARTITION", 10)
    with sizing.sized_shuffles(spark, path, str(tmp_path / "in")):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_every_job_has_a_command():
    parser = command_line.build_parser()
    assert len(command_line.JOBS) == 11
    assert parser.parse_args(["compact", "a", "b"]).files is None


@pytest.mark.parametrize(
    "stream, lines, more, expected",
    [
        (ingest.new_annotations, [QUAD], ["junk"], [ANNOTATION, ("match_error", *[""] * 5)]),
        (ingest.new_wiki_links, ["u\tt\tw"], ["v\tt\tw"], [("u", "t", "w"), ("v", "t", "w")]),
        (
            ingest.new_feeds, ["http://a.com/,<a rel=x,RSS"], ["http://b.com/,,"],
            [("http://a.com/", "<a rel=x", "rss", "a.com", "x", "", ""),
             ("http://b.com/", "", "", "b.com", "", "", "")],
        ),
        (
            ingest.new_tweet_links, [page_line("u", "http://twitter.com/a b")],
            [page_line("v", "http://twitter.com/c")],
            [("u", "http://twitter.com/a", "a"), ("v", "http://twitter.com/c", "c")],
        ),
        (
            ingest.new_wiki_paragraphs, [page_line("u", f'<p>ann<a href="{LINK}">Ann</a>')], [],
            [("u", "ann", LINK, f'ann<a href="{LINK}">Ann</a>')],
        ),
    ],
)
def test_new_files_only(spark, put, tmp_path, stream, lines, more, expected):
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    put("in/1", *lines)
    for batch in ((), more):
        if batch:
            put("in/2", *batch)
        query = ingest.append_new(stream(spark, str(tmp_path / "in")), target, checkpoint)
        assert query.awaitTermination(120)
    assert rows(spark.read.parquet(target)) == expected
