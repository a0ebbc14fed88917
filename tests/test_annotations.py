import pytest
from pyspark.sql import functions as F

from pagelore.functions.annotations import clean_name, is_name_predicate, wiki_title
from pagelore.operators.quads import annotations_from_quads, parse_quads
from tests.conftest import rows

QUADS = {
    '_:c <http://schema.org/Person/name> "A <b>"@en <http://example.com/c/1> <ex:html> .':
        ("_:c", "<http://schema.org/Person/name>", '"A <b>"@en', "http://example.com/c/1", "<ex:html>"),
    '<http://e.com/#1>\t<p>  "x"  <http://e.com/> <ex:rdfa>\t.':
        ("<http://e.com/#1>", "<p>", '"x" ', "http://e.com/", "<ex:rdfa>"),
    '_:c <p> "two <http://no/> <ex:a> . more" <http://e.com/> <ex:rdfa> .':
        ("_:c", "<p>", '"two <http://no/> <ex:a> . more"', "http://e.com/", "<ex:rdfa>"),
}
NOT_QUADS = [
    '_:c <p> "x" <http://e.com/> <ex:rdfa> . ',
    '_:c <p> "x" <http://e.com/> <ex:rdfa>',
    ' _:c <p> "x" <http://e.com/> <ex:rdfa> .',
    "junk", "", None,
    "a\nb\nc\nd\ne",
]


def test_quads(table):
    df = parse_quads(table("value", [(q,) for q in QUADS]))
    assert [tuple(r) for r in df.collect()] == list(QUADS.values())


def test_bad_quads_are_marked_or_dropped(table):
    lines = table("value", [(q,) for q in NOT_QUADS])
    assert rows(parse_quads(lines)) == [("match_error", "", "", "", "")] * len(NOT_QUADS)
    assert rows(parse_quads(lines, on_error="drop")) == []
    with pytest.raises(ValueError):
        parse_quads(lines, on_error="ignore")


def test_one_pass_agrees_with_one_pattern_per_field(table):
    pattern = r"\A(\S+)\s+(\S+)\s+(.+)\s+<([^>]+)>\s+(<[^>]+>)\s+\.\z"
    lines = table("value", [(q,) for q in (*QUADS, *NOT_QUADS[:-2])])
    fields = [F.regexp_extract("value", pattern, i) for i in range(1, 6)]
    expected = lines.where(F.col("value").rlike(pattern)).select(*fields)
    assert rows(parse_quads(lines, on_error="drop")) == rows(expected)


def test_annotations(table):
    line = '_:c <p> "x" <http://www.shop.co.uk/c> <ex:rdfa> .'
    df = annotations_from_quads(table("value", [(line,), ("junk",)]))
    assert df.columns == ["subject", "predicate", "obj", "url", "tpd", "extractor"]
    assert rows(df) == [
        ("_:c", "<p>", '"x"', "http://www.shop.co.uk/c", "shop", "<ex:rdfa>"),
        ("match_error", "", "", "", "", ""),
    ]


@pytest.mark.parametrize(
    "name, cleaned",
    [
        ('"Red  Ring!"', "red ring"), ('"Foo"@en', "foo en"), ("a_b-c", "a_b c"),
        ("Zürich", "z rich"), ("東京", ""), ("", ""), (None, None),
    ],
)
def test_clean_name(table, name, cleaned):
    assert table("n", [(name,)]).select(clean_name(F.col("n"))).first()[0] == cleaned


@pytest.mark.parametrize(
    "name, cleaned",
    [
        ('"Foo"@en', "foo"), ('"3"^^<http://www.w3.org/2001/XMLSchema#int>', "3"),
        ('"two\nlines"', "two lines"), ("<http://e.com/>", "http e com"),
    ],
)
def test_clean_name_of_a_literal(table, name, cleaned):
    df = table("n", [(name,)]).select(clean_name(F.col("n"), strip_literal=True))
    assert df.first()[0] == cleaned


@pytest.mark.parametrize(
    "predicate, is_name",
    [
        ("<http://schema.org/name>", True), ("<HTTP://schema.org/Person/NAME>", True),
        ("<http://schemaXorg/name>", True), ("<http://schema.org/a/b/name>", False),
        ("<http://schema.org/Person/jobTitle>", False), ("x<http://schema.org/name>", False),
        (None, None),
    ],
)
def test_name_predicate(table, predicate, is_name):
    assert table("p", [(predicate,)]).select(is_name_predicate(F.col("p"))).first()[0] is is_name


@pytest.mark.parametrize(
    "link, title",
    [
        ("https://en.wikipedia.org/wiki/Red_Ring", "Red_Ring"),
        ("wikipedia.org/wiki/a?u=https://en.wikipedia.org/wiki/B", "B"),
        ("https://en.wikipedia.org/wiki/", ""), ("https://example.org/", None), (None, None),
    ],
)
def test_wiki_title(table, link, title):
    assert table("l", [(link,)]).select(wiki_title(F.col("l"))).first()[0] == title
