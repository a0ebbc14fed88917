"""Expressions that pull attributes, links and paragraphs out of page markup."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelore.fixed_values import (
    PARAGRAPH_ENDERS,
    RAW_TEXT_ELEMENTS,
    TAG_ATTRIBUTE,
    TWEET_LINK,
    WIKI_LINK,
)
from pagelore.functions.text import flatten_whitespace, trim_controls

# More elements than any array has.
_TO_THE_END = 2**30

# Two code points that Unicode reserves for internal use; they mark tag borders below.
_OPEN, _CLOSE = "\ufdd0", "\ufdd1"


_ATTRIBUTES = r"(?:[\s/][^>]*)?"

# After a "<". Group 1: markup to be left alone. Group 3: a tag that starts or ends a
# paragraph. One "<" in front of everything lets the matcher skip all other characters.
_REGION = (
    r"(?is)<(?:"
    r"(!--.*?(?:-->|\z)"
    rf"|({'|'.join(RAW_TEXT_ELEMENTS)}){_ATTRIBUTES}>.*?(?:</\2{_ATTRIBUTES}>|\z))"
    rf"|(/?(?:{'|'.join(('p', *PARAGRAPH_ENDERS))}){_ATTRIBUTES}>))"
)


def tag_attr(tag: Column, name: str) -> Column:
    """Value of an attribute inside a tag, '' when it is not there."""
    value = F.regexp_extract(tag, TAG_ATTRIBUTE.format(name=name), 1)
    return F.coalesce(value, F.lit(""))


def wiki_links(content: Column) -> Column:
    """Markup of every encyclopedia link in a page, as an array of whole ``<a>`` elements.

    The big page text is scanned once; :func:`wiki_link_target` and
    :func:`wiki_link_anchor` then look at the short pieces only.
    """
    return F.regexp_extract_all(content, F.lit(WIKI_LINK), F.lit(0))


def wiki_link_target(element: Column) -> Column:
    return flatten_whitespace(F.regexp_extract(element, WIKI_LINK, 1))


def wiki_link_anchor(element: Column) -> Column:
    anchor = F.regexp_extract(element, WIKI_LINK, 2)
    return F.lower(trim_controls(flatten_whitespace(anchor)))


def tweet_links(content: Column) -> Column:
    """Every tweet or profile address in a page, as an array of whole addresses."""
    return F.regexp_extract_all(content, F.lit(TWEET_LINK), F.lit(0))


def tweet_url(address: Column) -> Column:
    return trim_controls(flatten_whitespace(address))


def tweet_query(address: Column) -> Column:
    return trim_controls(F.regexp_extract(address, TWEET_LINK, 2))


def paragraphs(content: Column) -> Column:
    """Inner markup of every paragraph of a page, in document order.

    One regular-expression pass puts markers round the tags that start or end a paragraph
    and leaves comments and script-like elements whole; the rest are plain text searches.
    A paragraph ends at its end tag, at the next block-level tag or with the page. Runs of
    white space become one space, as an HTML reader shows them.
    """
    clean = F.replace(F.replace(content, F.lit(_OPEN)), F.lit(_CLOSE))
    marked = F.regexp_replace(clean, _REGION, f"<$1{_OPEN}$3{_CLOSE}")
    tags = F.replace(marked, F.lit(_OPEN + _CLOSE))
    pieces = F.split(tags, rf"(?i)<{_OPEN}p{_ATTRIBUTES}>{_CLOSE}")
    return F.transform(
        F.slice(pieces, 2, _TO_THE_END),
        lambda piece: F.trim(
            F.regexp_replace(
                F.substring_index(piece, "<" + _OPEN, 1), r"[ \t\n\f\r]{2,}|[\t\n\f\r]", " "
            )
        ),
    )
