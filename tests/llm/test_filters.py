"""Filters at the scan: they only leave rows out that nothing needs, however full they are."""

import pytest

from pagelore.llm import exact_dedup, line_dedup, ngram_join

SCHEMA = "doc_id long, text string, source string"


def rows(df):
    return sorted(map(str, df.collect()))


def everything_passes(rows, key, known):
    return rows


def words(i, n=40):
    return " ".join(f"w{i}x{j}" for j in range(n))


def planted(spark):
    copies = [(i, words(i // 3), f"s{i % 5}") for i in range(60)]
    near = [(100 + i, f"{words(7)} tail{i}", "s1") for i in range(10)]
    odd = [(200, None, None), (201, "", "s1"), (None, words(1), "s2"), (202, words(1), None), (202, words(1), None)]
    alone = [(1000 + i, words(1000 + i), "s1") for i in range(300)]
    return spark.createDataFrame(copies + near + odd + alone, SCHEMA)


def test_exact_dedup_behind_a_full_filter(spark, monkeypatch):
    docs = planted(spark)
    before = rows(exact_dedup.exact_duplicates(docs))
    found = exact_dedup.recipes(docs)
    few = exact_dedup.shared_chunks(docs, found).select("digest").distinct().count()
    monkeypatch.setattr(exact_dedup, "maybe_in", everything_passes)
    assert rows(exact_dedup.exact_duplicates(docs)) == before
    assert few <= 30 < exact_dedup.shared_chunks(docs, found).select("digest").distinct().count()


@pytest.mark.parametrize("most_bytes", [1, 1 << 20])
def test_repeated_texts_are_never_left_out(spark, most_bytes):
    docs = planted(spark)
    chunks = exact_dedup.shared_chunks(docs, exact_dedup.recipes(docs), most_bytes=most_bytes)
    held = {bytes(r.chunk).decode() for r in chunks.collect()}
    assert {words(i) for i in range(20)} <= held


def test_ngram_join_behind_a_full_filter(spark, monkeypatch):
    docs = planted(spark)
    like = ngram_join.Similarity(5, 80)
    columns = ("doc_id", "text_hash", "n_shingles", "component_id", "stays")
    before = rows(ngram_join.similar_components(docs, like).select(*columns))
    monkeypatch.setattr(ngram_join, "maybe_in", everything_passes)
    assert rows(ngram_join.similar_components(docs, like).select(*columns)) == before


def test_line_counts_behind_a_full_filter(spark, monkeypatch):
    """Lines on exactly as many sites as the limit, one fewer and many more, each very often."""
    lines = [(i, f"two\nthree\nmany\nown {i}", f"s{i % 2}") for i in range(100)]
    lines += [(1000 + i, "three\nmany", "s9") for i in range(100)] + [(2000 + i, "many", f"t{i}") for i in range(50)]
    docs = spark.createDataFrame(lines + [(3000, "three", None), (3001, "two", "s1")], SCHEMA)
    before = rows(line_dedup.remove_boilerplate(docs))
    texts = {r.doc_id: r.text for r in line_dedup.remove_boilerplate(docs).collect()}
    assert texts[0] == "two\nthree\nmany\nown 0" and texts[1] == "two\nown 1"
    assert texts[1000] == "" and texts[3000] == "" and texts[3001] == "two"
    monkeypatch.setattr(line_dedup, "maybe_in", everything_passes)
    assert rows(line_dedup.remove_boilerplate(docs)) == before


def test_pairs_of_line_and_site_meet_once(spark):
    """The exact count groups (line, site) before a line's rows come together."""
    docs = spark.createDataFrame([(i, "three", f"s{i % 3}") for i in range(50)], SCHEMA)
    lines = line_dedup.line_sites(docs)
    plan = line_dedup.boilerplate(lines)._jdf.queryExecution().executedPlan().toString()
    first, *later = [part for part in plan.split("\n") if "Exchange hashpartitioning(" in part and "line" in part][::-1]
    assert "site" in first, plan
