import pytest
from pyspark.sql import functions as F

from checks import inputs
from pagelore.operators import grouping, matching, substitution
from pagelore.operators.per_page import per_page
from pagelore.plans.jobs import knowledge_base
from tests.conftest import ordered, rows

NAME = "<http://schema.org/Person/name>"
WIKI = "https://en.wikipedia.org/wiki/"


@pytest.fixture
def tables(table):
    pages = table("url content", [("p1", "one"), ("p2", "two"), ("p4", "no links"), ("p5", "five")])
    annotations = table(
        "subject predicate obj url",
        [
            ("_:a", NAME, '"Ann Lee"', "p1"),
            ("_:a", "<knows>", "_:b", "p1"),
            ("_:b", NAME, '"Bob!"', "p1"),
            ("_:b", "<knows>", "_:x", "p1"),
            ("_:x", NAME, '"Nobody"', "p1"),
            ("_:a", NAME, '"ann lee"', "p2"),
            ("_:n", NAME, None, "p2"),
            ("_:a", NAME, '"Ann Lee"', "p3"),
            ("_:a", NAME, '"Ann Lee"', "p4"),
            ("_:e", NAME, '"東京"', "p5"),
            ("match_error", "", "", ""),
        ],
    )
    links = table(
        "url anchorText wikiLink",
        [
            ("p1", "x", WIKI + "Ann_Lee"),
            ("p1", "again", WIKI + "Ann_Lee"),
            ("p1", "y", WIKI + "Bob"),
            ("p1", "z", "https://example.org/Nobody"),
            ("p2", "x", WIKI + "Lee_(Ann)"),
            ("p2", "x", WIKI + "Ann_Lee"),
            ("p3", "x", WIKI + "Ann_Lee"),
            ("p5", "x", WIKI + "Tokyo"),
        ],
    )
    dictionary = table(
        "title mention",
        [
            ("Ann_Lee", "Ann Lee"), ("Ann_Lee", "ann-lee"), ("Lee_(Ann)", "Ann Lee"),
            ("Bob", "bob"), ("Bob", None), ("Tokyo", "日本"),
        ],
    )
    return pages, annotations, links, dictionary


MATCHES = [
    ("p1", "_:a", "Ann_Lee"), ("p1", "_:b", "Bob"), ("p2", "_:a", "Ann_Lee"), ("p5", "_:e", "Tokyo"),
]


def test_titles_and_mentions(tables):
    pages, annotations, links, dictionary = tables
    assert rows(matching.page_wiki_titles(links)) == [
        ("p1", "Ann_Lee"), ("p1", "Bob"), ("p2", "Ann_Lee"), ("p2", "Lee_(Ann)"),
        ("p3", "Ann_Lee"), ("p5", "Tokyo"),
    ]
    assert rows(matching.page_mentions(links, dictionary)) == [
        ("p1", "ann lee", "Ann_Lee"), ("p1", "bob", "Bob"), ("p2", "ann lee", "Ann_Lee"),
        ("p3", "ann lee", "Ann_Lee"), ("p5", "", "Tokyo"),
    ]


def test_names_are_cleaned_once(spark, tables, tmp_path):
    """The plan cleans each name and mention once and reads only the columns it needs."""
    stored = []
    for name, df in zip(("pages", "annotations", "links", "dictionary"), tables):
        df.write.parquet(str(tmp_path / name))
        stored.append(spark.read.parquet(str(tmp_path / name)))
    *parts, dictionary = stored
    mappings = matching.name_exact_match(dictionary)(*parts)
    plan = mappings._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace(") == 2
    assert "IsNotNull(obj)" in plan and "IsNotNull(mention)" in plan
    assert "content" not in plan and "anchorText" not in plan


def test_name_exact_match(tables):
    *parts, dictionary = tables
    assert rows(matching.name_exact_match(dictionary)(*parts)) == MATCHES


def test_empty_names_can_be_ignored(tables):
    *parts, dictionary = tables
    strategy = matching.name_exact_match(dictionary, ignore_empty=True)
    assert rows(strategy(*parts)) == MATCHES[:3]


def test_literals_can_be_stripped(table):
    pages = table("url content", [("p", "")])
    names = table("subject predicate obj url", [("_:a", NAME, '"Ann"@en', "p")])
    links = table("url wikiLink", [("p", WIKI + "Ann")])
    dictionary = table("title mention", [("Ann", "Ann")])
    assert rows(matching.name_exact_match(dictionary)(pages, names, links)) == []
    stripped = matching.name_exact_match(dictionary, strip_literal=True)
    assert rows(stripped(pages, names, links)) == [("p", "_:a", "Ann")]


def test_copies_multiply(tables):
    """Two copies of a page and two of a name give four matches."""
    pages, annotations, links, dictionary = tables
    twice = pages.unionAll(pages), annotations.unionAll(annotations), links.unionAll(links)
    found = rows(matching.name_exact_match(dictionary)(*twice))
    assert found == sorted(MATCHES * 4)


def name_matcher(dictionary):
    """The name strategy for one page, written down a second time in plain Python."""

    def set_up():
        import re

        def clean(text):
            return re.sub(r"\W+", " ", text, flags=re.ASCII).strip().lower()

        class NamePage:
            def __init__(self, url, content):
                self.known = {}

            def add_link(self, link):
                if link and "wikipedia.org/wiki/" in link:
                    title = link.rsplit("wikipedia.org/wiki/", 1)[1]
                    for mention in map(clean, dictionary.get(title, ())):
                        self.known[mention] = min(title, self.known.get(mention, title))

            def add_triple(self, subject, predicate, obj):
                if re.fullmatch("<http://schema.org(/[^/]+)?/name>", predicate.lower()) and obj:
                    if clean(obj) in self.known:
                        yield subject, self.known[clean(obj)]

            def finish(self):
                return None

        return NamePage

    return set_up


@pytest.fixture
def by_page(tables):
    dictionary = {}
    for title, mention in tables[3].where("mention is not null").collect():
        dictionary.setdefault(title, []).append(mention)
    return name_matcher(dictionary)


def test_page_level_strategy_agrees(tables, by_page):
    *parts, dictionary = tables
    assert rows(per_page(by_page)(*parts)) == MATCHES
    twice = [part.unionAll(part) for part in parts]
    by_tables = matching.name_exact_match(dictionary)
    assert rows(per_page(by_page)(*twice)) == rows(by_tables(*twice))
    assert rows(per_page(by_page, content=False)(*twice)) == rows(by_tables(*twice))


@pytest.mark.parametrize("rows_a_batch", ["1", "2", "3"])
def test_page_level_strategy_in_small_batches(tables, by_page, with_conf, rows_a_batch):
    with_conf(spark__sql__execution__arrow__maxRecordsPerBatch=rows_a_batch)
    assert rows(per_page(by_page)(*tables[:3])) == MATCHES


def recorder():
    """A strategy that yields what a page is told, as text, when it ends."""

    def set_up():
        class Recorder:
            def __init__(self, url, content):
                self.told = [f"{content}"]

            def add_link(self, link):
                self.told.append(str(link)[-3:])

            def add_triple(self, subject, predicate, obj):
                self.told.append(f"{subject}{obj}")

            def finish(self):
                yield "page", " ".join(self.told)

        return Recorder

    return set_up


def told(*tables, **settings):
    return sorted((r.pageUrl, r.dbPediaUri) for r in per_page(recorder(), **settings)(*tables).collect())


def test_strategy_sees_whole_pages_in_order(tables, table):
    *parts, _ = tables
    links = parts[2].unionAll(table("url anchorText wikiLink", [(None, "x", "l"), ("p2", "x", None)]))
    assert told(parts[0], parts[1], links) == [
        ("p1", 'one Lee Lee Bob ody _:a"Ann Lee" _:a_:b _:b"Bob!" _:b_:x _:x"Nobody"'),
        ("p2", 'two one Lee nn) _:a"ann lee" _:nNone'),
        ("p5", 'five kyo _:e"東京"'),
    ]
    late = told(*parts, order=[F.col("link").isNotNull(), F.col("obj").isNotNull()])
    assert late[1] == ("p2", 'two _:nNone _:a"ann lee" Lee nn)')


def test_only_pages_with_links_and_annotations_count(table):
    """Also where the order puts annotations first."""
    pages = table("url content", [("both", "x"), ("links", "x"), ("triples", "x"), ("none", "x"), (None, "x")])
    links = table("url wikiLink", [("both", "l"), ("links", "l"), ("no page", "l"), (None, "l")])
    triples = table(
        "url subject predicate obj", [(u, "s", "p", "o") for u in ("both", "triples", "no page", None)]
    )
    for order in (None, [F.col("subject").isNull()]):
        assert [url for url, _ in told(pages, triples, links, order=order)] == ["both"]


def test_versions_and_copies_of_a_page(table):
    pages = table("url content", [("p", "a"), ("p", "b"), ("p", "a"), ("p", None), ("p", None)])
    links, triples = table("url wikiLink", [("p", "l")]), table("url subject predicate obj", [("p", "s", "p", "o")])
    assert told(pages, triples, links) == sorted([("p", "None l so")] * 2 + [("p", "a l so")] * 2 + [("p", "b l so")])
    assert told(pages, triples, links, content=False) == [("p", "None l so")] * 5


def test_hot_page_in_bounded_memory(spark):
    """A page with a third of all rows is seen item by item; set-up runs once per task."""
    import sys

    def set_up():
        made = []

        class Counted:
            def __init__(self, url, content):
                made.append(url)
                self.links = self.triples = 0

            def add_link(self, link):
                self.links += 1

            def add_triple(self, subject, predicate, obj):
                self.triples += 1

            def finish(self):
                import resource

                peak = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10
                yield f"{self.links} {self.triples}", f"{len(made)} {peak}"

        return Counted

    url = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 1000))
    base = spark.range(0, 900_000, numPartitions=8).select(url.alias("url"), "id")
    noise = F.sha2(F.col("id").cast("string"), 512)
    triples = base.select("url", noise.alias("subject"), F.lit("p").alias("predicate"), F.lit("o").alias("obj"))
    pages = base.select("url").distinct().withColumn("content", F.lit("x" * 1000))
    found = {r.pageUrl: r for r in per_page(set_up)(pages, triples, base.select("url", noise.alias("wikiLink"))).collect()}
    assert found["hot"].localEntityUri == "300000 300000"
    assert max(int(r.dbPediaUri.split()[0]) for r in found.values()) > 50
    # 600,000 items of 128 characters and their Python objects would take over 100 MB.
    peaks = [int(r.dbPediaUri.split()[1]) for r in found.values()]
    assert int(found["hot"].dbPediaUri.split()[1]) <= min(peaks) + 60, sys.version


def test_knowledge_base(tables):
    *parts, dictionary = tables
    df = knowledge_base(*parts, matching.name_exact_match(dictionary))
    assert df.columns == ["triplePageUrl", "subject", "url", "predicate", "obj"]
    assert rows(df) == sorted([
        ("p1", "Ann_Lee", "p1", NAME, '"Ann Lee"'),
        ("p1", "Ann_Lee", "p1", "<knows>", "Bob"),
        ("p1", "Bob", "p1", NAME, '"Bob!"'),
        ("p1", "Bob", "p1", "<knows>", "_:x"),
        ("p2", "Ann_Lee", "p2", NAME, '"ann lee"'),
        ("p5", "Tokyo", "p5", NAME, '"東京"'),
    ])


def test_knowledge_base_as_one_plan(tables, monkeypatch):
    """Without a shared folder nothing is staged; the result is the same."""
    from pagelore.sources import staging

    *parts, dictionary = tables
    strategy = matching.name_exact_match(dictionary)
    staged = rows(knowledge_base(*parts, strategy))
    monkeypatch.setattr(staging, "shared_folder", lambda _: None)
    assert rows(knowledge_base(*parts, strategy)) == staged


def test_substitution_keeps_copies_and_nulls(table):
    mappings = table(
        "pageUrl localEntityUri dbPediaUri",
        [("p", "_:a", "A"), ("p", "_:a", "A2"), ("p", "_:b", "B"), ("q", "_:c", "C")],
    )
    triples = table(
        "url subject predicate obj",
        [("p", "_:a", "<p>", "_:b"), ("p", "_:a", "<p>", None), ("p", "_:b", "<p>", "_:c"),
         ("p", "_:z", "<p>", "_:a"), ("q", "_:c", "<p>", "_:c"), ("q", "_:c", "<p>", "_:c")],
    )
    subjects = substitution.substitute_subjects(mappings, triples)
    assert subjects.count() == 7
    assert rows(substitution.substitute_objects(mappings, subjects)) == ordered([
        ("p", "A", "p", "<p>", "B"), ("p", "A2", "p", "<p>", "B"),
        ("p", "A", "p", "<p>", None), ("p", "A2", "p", "<p>", None),
        ("p", "B", "p", "<p>", "_:c"), ("q", "C", "q", "<p>", "C"), ("q", "C", "q", "<p>", "C"),
    ])


def test_counted_copies_give_the_same_rows(spark, tables, table, monkeypatch):
    pages, annotations, links, dictionary = tables
    twice = pages.unionAll(pages), annotations.unionAll(annotations), links
    strategy = matching.name_exact_match(dictionary)
    mappings = strategy(*twice)
    triples = twice[1].select("url", "subject", "predicate", "obj")
    plain = substitution.substitute_objects(
        mappings, substitution.substitute_subjects(mappings, triples)
    )
    assert rows(knowledge_base(*twice, strategy)) == rows(plain)
    assert plain.count() == 6 * 4 * 2 + 3 * 4 * 2  # one object is a matched entity, too
    monkeypatch.setattr(substitution, "_BLOCK", 3)
    for copies in (1, 2, 3, 4, 6, 7, 10):
        one = table("a", [("x",)]).withColumn("copies", F.lit(copies).cast("bigint"))
        assert rows(substitution.repeat_copies(one)) == [("x",)] * copies


def test_lists_are_whole_and_bounded(spark, table):
    annotations = spark.range(1000).select(
        F.when(F.col("id") < 600, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 50)).alias("url"),
        F.concat(F.lit("s"), F.col("id") % 300).alias("subject"),
        F.lit("<p>").alias("predicate"),
        F.when(F.col("id") % 7 > 0, "o").alias("obj"),
    )
    for part_items in (1, 7, 20, 10_000):
        lists = grouping.triples_by_page(annotations, part_items).collect()
        pages = {}
        for r in sorted(lists, key=lambda r: (r.url, r.part)):
            pages.setdefault(r.url, []).append((r.part, r.triples))
        assert len(pages) == 51
        for parts in pages.values():
            assert [part for part, _ in parts] == list(range(len(parts)))
            assert all(len(items) == part_items for _, items in parts[:-1])
            keys = [tuple(v or "" for v in i[:3]) for _, items in parts for i in items]
            assert keys == sorted(set(keys))
        again = sorted(
            (r.url, i.subject, i.predicate, str(i.obj)) for r in lists for i in r.triples for _ in range(i.copies)
        )
        assert again == sorted((r.url, r.subject, r.predicate, str(r.obj)) for r in annotations.collect())


def test_links_of_pages_without_address_stay_together(table):
    links = table("url wikiLink", [(None, "a"), (None, "a"), (None, "b"), ("u", "a"), ("u", None)])
    lists = grouping.wikilinks_by_page(links, 10)
    found = {(r.url, r.part): [(str(i.wikiLink), i.copies) for i in r.wikilinks] for r in lists.collect()}
    assert found == {(None, 0): [("a", 2), ("b", 1)], ("u", 0): [("None", 1), ("a", 1)]}


def test_pages_with_lists(tables):
    pages, annotations, links, _ = tables
    whole = {r.url: r for r in grouping.pages_with_lists(pages, annotations, links, 100).collect()}
    assert set(whole) == {"p1", "p2", "p5"}
    assert whole["p1"].content == "one" and whole["p1"].part == 0 and len(whole["p1"].triples) == 5
    assert [(i.wikiLink, i.copies) for i in whole["p1"].wikilinks] == [
        (WIKI + "Ann_Lee", 2), (WIKI + "Bob", 1), ("https://example.org/Nobody", 1),
    ]
    small = grouping.pages_with_lists(pages.unionAll(pages), annotations, links, 2).collect()
    found = sorted((r.part, str(r.content), len(r.triples), len(r.wikilinks)) for r in small if r.url == "p1")
    assert found == [(0, "one", 2, 2)] * 2 + [(1, "None", 2, 1)] * 2 + [(2, "None", 1, 0)] * 2
    assert grouping.pages_with_lists(pages, annotations, links.where("false"), 2).count() == 0


def _many_pages(spark, hot_rows):
    """Pages of few items, and two of many: one of different items, one of copies."""
    rows = spark.range(900 + 2 * hot_rows).select(
        F.when(F.col("id") < 900, F.concat(F.lit("u"), F.col("id") % 60))
        .when(F.col("id") < 900 + hot_rows, "hot").otherwise("copies").alias("url"),
        F.when(F.col("id") < 900 + hot_rows, F.concat(F.lit("s"), F.col("id") % 500)).otherwise("s").alias("item"),
    )
    annotations = rows.select("url", F.col("item").alias("subject"), F.lit("<p>").alias("predicate"),
                              F.when(F.col("url") != "u7", F.col("item")).alias("obj"))
    links = rows.where("url != 'u9'").select("url", F.col("item").alias("wikiLink"))
    pages = rows.select("url").distinct().where("url != 'u3'").unionAll(spark.sql("SELECT 'u5' UNION ALL SELECT NULL"))
    return (pages.withColumn("content", F.concat(F.lit("on "), "url")),
            annotations.unionAll(spark.sql("SELECT NULL, 'a', 'b', NULL")),
            links.unionAll(spark.sql("SELECT NULL, 'a'")))


def test_hot_pages_are_ranked_with_the_same_lists(spark, monkeypatch):
    pages, annotations, links = _many_pages(spark, 300)
    results = []
    for most, found in ((10_000, 0), (200, 2), (0, 62)):
        monkeypatch.setattr(grouping, "HOT_ROWS", most)
        assert len(grouping._hot_buckets(annotations.where("url IS NOT NULL"))) == found
        results.append((rows(grouping.triples_by_page(annotations, 7)),
                        rows(grouping.wikilinks_by_page(links, 7)),
                        rows(grouping.pages_with_lists(pages, annotations, links, 7))))
    assert results[0] == results[1] == results[2]
    assert len({r[0] for r in results[0][2]}) == 60  # neither u3 nor u9, nor without address


def test_lists_take_one_shuffle(spark, with_conf):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    pages, annotations, links = (t.localCheckpoint() for t in _many_pages(spark, 300))

    def shuffles(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")

    assert shuffles(grouping.triples_by_page(annotations, 7)) == 1
    assert shuffles(grouping.wikilinks_by_page(links, 7)) == 1
    assert shuffles(grouping.pages_with_lists(pages, annotations, links, 7)) == 2


def test_variants_read_only_what_is_used(spark):
    """Counting the annotations of a page makes none of their texts."""
    shop = inputs.shop(spark, "/root/testdata/sf0.001")
    for rows_of in (inputs.shop_annotations, inputs.shop_links):
        plan = rows_of(shop).groupBy("url").count()._jdf.queryExecution().executedPlan().toString()
        assert "c_name" not in plan and "n_name" not in plan


def test_ranks_over_runs(spark, with_conf):
    """A page that lies in many runs, and pages at their borders."""
    items = spark.range(5000).select(
        F.when(F.col("id") < 3000, "m").otherwise(F.concat(F.lit("u"), F.col("id") % 17)).alias("url"),
        F.format_string("%05d", "id").alias("item"),
    )
    for runs in ("1", "7", "40"):
        with_conf(spark__sql__shuffle__partitions=runs)
        pages = {}
        for r in grouping.ranked(items, "item").collect():
            pages.setdefault(r.url, []).append((r["rank"], r["item"]))
        for found in pages.values():
            ordered_items = sorted(found)
            assert [rank for rank, _ in ordered_items] == list(range(len(found)))
            assert [i for _, i in ordered_items] == sorted(i for _, i in found)


def test_pages_with_both(tables):
    pages, annotations, links, _ = tables
    assert rows(grouping.pages_with_both(pages, annotations, links)) == [
        ("p1", "one", 5, 4), ("p2", "two", 2, 2), ("p5", "five", 1, 1),
    ]


def skewed(plan):
    return plan._jdf.queryExecution().executedPlan().toString().count("skew=true")


@pytest.fixture
def hot(spark, tmp_path, with_conf):
    """Tables in which one page holds a third of everything, and small skew limits."""
    with_conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__files__maxPartitionBytes="200KB",
        spark__sql__files__openCostInBytes="1KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="32KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    url = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), "id")).alias("url")
    noise = F.sha2(F.col("id").cast("string"), 256)
    base = spark.range(0, 60000, numPartitions=8)
    made = {
        "pages": base.select(url, noise.alias("content")),
        "annotations": base.select(
            F.concat(F.lit("_:"), noise).alias("subject"), F.lit(NAME).alias("predicate"),
            F.when(F.col("id") % 3 == 0, "name").otherwise(F.col("id").cast("string")).alias("obj"),
            url,
        ),
        "links": base.select(url, F.concat(F.lit(WIKI), "id").alias("wikiLink")),
        "dictionary": base.select(
            F.col("id").cast("string").alias("title"),
            F.when(F.col("id") % 3 == 0, "name").otherwise(F.col("id").cast("string")).alias("mention"),
        ),
    }
    for name, df in made.items():
        df.write.parquet(str(tmp_path / name))
    return {name: spark.read.parquet(str(tmp_path / name)) for name in made}


def test_hot_names_are_split(hot):
    names = hot["annotations"].select("url", "subject", F.col("obj").alias("mention"))
    joined = matching.match_names(names, matching.page_mentions(hot["links"], hot["dictionary"]))
    assert len(joined.collect()) == 60000
    assert skewed(joined) == 1


def test_hot_pages_are_split(hot):
    joined = grouping.pages_with_both(hot["pages"], hot["annotations"], hot["links"])
    assert len(joined.collect()) == 60000
    assert skewed(joined) == 1


def test_hot_subjects_and_objects_are_split(hot):
    mappings = hot["annotations"].where("obj = 'name'").limit(1).unionAll(
        hot["annotations"].where("url != 'hot'")
    ).select(
        F.col("url").alias("pageUrl"), F.col("obj").alias("localEntityUri"),
        F.upper("obj").alias("dbPediaUri"),
    )
    subjects = substitution.substitute_subjects(
        mappings, hot["annotations"].select("url", F.col("obj").alias("subject"), "predicate",
                                            F.col("subject").alias("obj"))
    )
    assert len(subjects.collect()) == 60000
    assert skewed(subjects) == 1
    objects = substitution.substitute_objects(
        mappings, hot["annotations"].withColumn("triplePageUrl", F.col("url"))
    )
    assert sum(row.obj == "NAME" for row in objects.collect()) == 20000
    assert skewed(objects) == 1
