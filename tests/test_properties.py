"""Random inputs against plain Python."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagelore.functions.annotations import clean_name
from pagelore.functions.markup import tag_attr
from pagelore.functions.urls import hostname
from pagelore.operators.extraction import page_paragraphs, tweet_links
from pagelore.operators.quads import parse_quads

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def pieces(*parts, size=8):
    """Texts put together from a few telling parts."""
    text = st.lists(st.sampled_from(parts), max_size=size).map("".join)
    return st.lists(text, min_size=30, max_size=80)


def evaluate(table, texts, column):
    df = table("x", [(text,) for text in texts]).select("x", column.alias("y"))
    found = {row.x: row.y for row in df.collect()}
    assert set(found) == set(texts)
    return found


@few
@given(pieces("http://", "https:", "//", "/", ":", "@", "?", "#", "a", "B.c", "é", " "))
def test_hostname(table, texts):
    def expected(page):
        match = re.search("//([^/:]+)", page)
        return re.split("[?#]", match[1])[0].rsplit("@", 1)[-1] if match else ""

    assert evaluate(table, texts, hostname(F.col("x"))) == {t: expected(t) for t in texts}


@few
@given(pieces("<a ", "rel", "=", '"', "'", ">", "x", "rel=", 'rel="y"', " ", "\n"))
def test_tag_attribute(table, texts):
    def expected(tag):
        match = re.fullmatch(r""".*rel=["']?([^'"]*)["']?.*""", tag)
        return match[1] if match else ""

    assert evaluate(table, texts, tag_attr(F.col("x"), "rel")) == {t: expected(t) for t in texts}


@few
@given(pieces("a", "_", "Ü", "9", " ", "-", "\t", '"@en', "İx"))
def test_clean_name(table, texts):
    def expected(name):
        return re.sub(r"\W+", " ", name, flags=re.ASCII).strip().lower()

    assert evaluate(table, texts, clean_name(F.col("x"))) == {t: expected(t) for t in texts}


@few
@given(pieces("_:a", " ", "<p>", "\t", '"x"', "<http://u/>", "<e>", " .", " <http://u/> <e> .", size=9))
def test_quads(table, texts):
    pattern = r"(\S+)\s+(\S+)\s+(.+)\s+<([^>]+)>\s+(<[^>]+>)\s+\."
    matches = [re.fullmatch(pattern, text) for text in texts]
    df = parse_quads(table("value", [(text,) for text in texts]))
    assert [tuple(row) for row in df.collect()] == [
        match.groups() if match else ("match_error", "", "", "", "") for match in matches
    ]


@few
@given(pieces("http://", "https://www.", "twitter.com/", "a", "#", '"', " ", "/", "?x"))
def test_tweets(table, texts):
    df = tweet_links(table("url content", [("u", text) for text in texts]))
    expected = [
        (match[0], match[2])
        for text in texts
        for match in re.finditer(r"""https?://(www\.)?twitter.com/([^\s"'#]*)""", text)
    ]
    assert [(row.url, row.query) for row in df.collect()] == expected


@few
@given(
    pieces("<p>", "</p>", "<P class=x>", "<div>", "</div>", "<b>", "x", " ", "\n", "<!--", "-->",
           "<script>", "</script>", "<pre>", "<px>", size=12)
)
def test_paragraphs(table, texts):
    """Against a small reader that walks through the text tag by tag."""
    token = re.compile(
        r"(?is)(<!--.*?(?:-->|\Z)|<script>.*?(?:</script>|\Z))|<(/?)(p|div|pre)(?: [^>]*)?>"
    )

    def expected(text):
        found, current, start = [], False, 0
        for match in token.finditer(text):
            if match[1]:
                continue
            if current:
                found.append(text[start:match.start()])
            current, start = match[3].lower() == "p" and not match[2], match.end()
        if current:
            found.append(text[start:])
        return [re.sub(r"\s+", " ", piece).strip() for piece in found]

    df = page_paragraphs(table("url content", [(f"u{i}", text) for i, text in enumerate(texts)]))
    got = {}
    for row in df.orderBy("page", "position").collect():
        got.setdefault(row.page, []).append(row.paragraph)
    assert got == {f"u{i}": expected(t) for i, t in enumerate(texts) if expected(t)}
