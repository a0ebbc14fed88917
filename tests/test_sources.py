import gzip
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pagelore.sources import readers, staging, writers
from tests.conftest import rows


def put(path, text):
    """Write a text file, gzipped when its name says so; returns the path as text."""
    (gzip.open if path.suffix == ".gz" else open)(path, "wt", encoding="utf-8").write(text)
    return str(path)


def test_feeds_csv(spark, tmp_path):
    put(tmp_path / "a.csv.gz", 'http://a.com/,"<link rel=""x"", href=""/f"">",RSS\nhttp://b.com/,,\n')
    put(tmp_path / "b.csv.gz", "http://c.com/,<a>,atom,surplus\n")
    df = readers.read_feeds_csv(spark, f"{tmp_path}/*.csv.gz")
    assert df.columns == ["page", "tag", "type"]
    assert rows(df) == [
        ("http://a.com/", '<link rel="x", href="/f">', "RSS"),
        ("http://b.com/", "", ""),
        ("http://c.com/", "<a>", "atom"),
    ]


def test_feeds_csv_with_backslash_escapes(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'http://a.com/,"<link rel=\\"x\\">",RSS\n')
    df = readers.read_feeds_csv(spark, path, escape="\\")
    assert rows(df) == [("http://a.com/", '<link rel="x">', "RSS")]


def test_urls_csv(spark, tmp_path):
    put(tmp_path / "a.csv.gz", 'http://a.com/\nhttp://b.com/?x=1,2\n"http://c.com/?x=1,2"\n\n')
    df = readers.read_urls_csv(spark, f"{tmp_path}/*.csv.gz")
    assert rows(df) == [("http://a.com/",), ("http://b.com/?x=1",), ("http://c.com/?x=1,2",)]


def test_lines(spark, tmp_path):
    path = put(tmp_path / "a.gz", "one\ntwo\r\nthree\rfour")
    assert rows(readers.read_lines(spark, path)) == [("four",), ("one",), ("three",), ("two",)]
    assert readers.read_lines(spark, path, min_partitions=8).rdd.getNumPartitions() == 8


def test_pages_json(spark, tmp_path):
    path = put(tmp_path / "a.json", json.dumps({"url": "u", "content": "c", "more": 1}) + "\n")
    assert readers.read_pages_json(spark, path, infer=False).columns == ["url", "content"]
    inferred = readers.read_pages_json(spark, path)
    assert dict(inferred.dtypes) == {"content": "string", "more": "bigint", "url": "string"}


PAGE_LINES = ['{"url": "u1", "content": "c1"}', '{"url": "u2"}', "{broken", '{"content": "c3"}']


def test_bad_page_lines_are_dropped(spark, tmp_path):
    path = put(tmp_path / "a.gz", "\n".join(PAGE_LINES))
    assert rows(readers.read_page_lines(spark, path, on_bad="drop")) == [("c1", "u1")]


@pytest.mark.parametrize("bad", PAGE_LINES[1:])
def test_bad_page_lines_fail(spark, tmp_path, bad):
    path = put(tmp_path / "a.gz", "\n".join([PAGE_LINES[0], bad]))
    with pytest.raises(Exception, match="FAILFAST|page line without"):
        readers.read_page_lines(spark, path, on_bad="fail").collect()


def test_good_page_lines_do_not_fail(spark, tmp_path):
    path = put(tmp_path / "a.gz", PAGE_LINES[0])
    assert rows(readers.read_page_lines(spark, path, on_bad="fail")) == [("c1", "u1")]


GOOD_LINKS = {
    "u\tt\tw": ("u", "t", "w"), "u\t\tw": ("u", "", "w"), "\tt\tw": ("", "t", "w"),
    "u\tt\tw\t\t": ("u", "t", "w"), "u \t t\tw ": ("u ", " t", "w "),
}
BAD_LINKS = ["u\tt", "u\tt\t", "u\tt\tw\tx", "", "\t\t"]


def test_wiki_links(spark, tmp_path):
    path = put(tmp_path / "a.tsv", "\n".join(GOOD_LINKS))
    df = readers.read_wiki_links_tsv(spark, path)
    assert df.columns == ["url", "anchorText", "wikiLink"]
    assert rows(df) == sorted(GOOD_LINKS.values())


@pytest.mark.parametrize("bad", BAD_LINKS)
def test_bad_wiki_links(spark, tmp_path, bad):
    path = put(tmp_path / "a.tsv", f"u\tt\tw\n{bad}\nu\tt\tw\n")
    with pytest.raises(PySparkException, match="not three fields"):
        readers.read_wiki_links_tsv(spark, path).collect()
    assert rows(readers.read_wiki_links_tsv(spark, path, on_bad="drop")) == [("u", "t", "w")] * 2


def test_bad_policy(spark, tmp_path):
    path = put(tmp_path / "a", "x")
    for read in (readers.read_wiki_links_tsv, readers.read_page_lines):
        with pytest.raises(ValueError):
            read(spark, path, on_bad="guess")


def test_write_fails_when_the_path_is_taken(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.write_parquet(spark.range(3), path)
    with pytest.raises(PySparkException):
        writers.write_parquet(spark.range(5), path)
    writers.write_parquet(spark.range(5), path, overwrite=True)
    assert spark.read.parquet(path).count() == 5
    assert all(".snappy." in file for file in spark.read.parquet(path).inputFiles())


def test_compaction(spark, tmp_path):
    many, few = str(tmp_path / "many"), str(tmp_path / "few")
    spark.range(1000, numPartitions=20).write.parquet(many)
    assert len(spark.read.parquet(many).inputFiles()) == 20
    compacted = writers.compact(spark.read.parquet(many), 3)
    assert "Exchange" not in compacted._jdf.queryExecution().executedPlan().toString()
    writers.write_parquet(compacted, few)
    assert len(spark.read.parquet(few).inputFiles()) <= 3
    assert rows(spark.read.parquet(few)) == rows(spark.range(1000))


def test_merging_keeps_the_tasks_of_the_parsing(spark, tmp_path):
    merged = writers.merge_small(spark.range(1000, numPartitions=40))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS" in plan and "Coalesce" not in plan
    writers.write_parquet(merged, str(tmp_path / "merged"))
    assert len(list((tmp_path / "merged").glob("*.parquet"))) == 1
    assert spark.read.parquet(str(tmp_path / "merged")).distinct().count() == 1000


def test_file_count_follows_the_input(spark, tmp_path, monkeypatch):
    path = tmp_path / "in"
    path.mkdir()
    for i in range(5):
        put(path / f"{i}.csv", "x" * 1000)
    assert writers.input_bytes(spark, str(path)) == 5000
    assert writers.input_bytes(spark, f"{path}/*.csv") == 5000
    assert writers.file_count(spark, str(path)) == 1
    monkeypatch.setattr(writers, "TARGET_FILE_BYTES", 900)
    assert writers.file_count(spark, str(path)) == 6


def test_cut_lineage(spark, with_conf):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    staged = staging.cut_lineage(df, "numbers")
    assert "Range" not in staged._jdf.queryExecution().executedPlan().toString()
    assert rows(staged) == rows(df)
    assert staged.inputFiles()[0].split("file:")[1].lstrip("/").startswith(
        spark.conf.get("spark.checkpoint.dir").lstrip("/")
    )


def test_without_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda _: None)
    df = spark.range(10)
    assert staging.cut_lineage(df, "numbers") is df
    assert staging.fresh_path(spark, "x") != staging.fresh_path(spark, "x")


def test_failing_cannot_be_pruned(spark, tmp_path):
    path = str(tmp_path / "bad.tsv")
    with open(path, "w") as f:
        f.write("u\tt\tw\nonly one\n")
    for run in (lambda df: df.count(), lambda df: df.select("url").collect()):
        with pytest.raises(Exception, match="not three fields"):
            run(readers.read_wiki_links_tsv(spark, path))
    path = str(tmp_path / "bad.json")
    with open(path, "w") as f:
        f.write('{"url": "u1", "content": "c1"}\n{"url": "u2"}\n')
    for run in (lambda df: df.count(), lambda df: df.select("url").collect()):
        with pytest.raises(Exception, match="without url or content"):
            run(readers.read_page_lines(spark, path))


def test_pages_of_any_length_are_read(spark, tmp_path):
    path = str(tmp_path / "long.json")
    with open(path, "w") as f:
        f.write('{"url": "u1", "content": "' + "x" * 25_000_000 + '", "more": 1}\n')
    for pages in (
        readers.read_page_lines(spark, path),
        readers.read_pages_json(spark, path),
        readers.read_pages_json(spark, path, infer=False),
    ):
        assert pages.selectExpr("length(content)").first()[0] == 25_000_000


def test_more_partitions_than_asked_for_stay(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(20).selectExpr("cast(id as string)").repartition(20).write.text(path)
    before = spark.read.text(path).rdd.getNumPartitions()
    assert readers.read_lines(spark, path, min_partitions=2).rdd.getNumPartitions() == before
