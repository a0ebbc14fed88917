"""Expressions over semantic annotations and encyclopedia links."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelore.fixed_values import NAME_PREDICATE, NON_WORD, QUAD, WIKI_PREFIX

QUAD_FIELDS = ("subject", "predicate", "obj", "url", "extractor")


def quad_fields(line: Column) -> Column:
    """The five fields of one quad line as a nested array; empty when the line is no quad.

    One regular-expression pass per line: the line is rewritten with a line break between
    fields and then split. A line has no line break of its own, so nothing else can match.
    The result is an array of at most one array so that it can be exploded.
    """
    between = "\n".join(f"${i}" for i in range(1, len(QUAD_FIELDS) + 1))
    fields = F.split(F.regexp_replace(line, QUAD, between), "\n")
    return F.filter(
        F.array(fields),
        lambda found: (F.size(found) == len(QUAD_FIELDS)) & ~F.contains(line, F.lit("\n")),
    )


def is_name_predicate(predicate: Column) -> Column:
    """Whether a predicate names its subject. Most predicates fail the cheap test of the end."""
    lowered = F.lower(predicate)
    return lowered.endswith("/name>") & lowered.rlike(NAME_PREDICATE)


def clean_name(name: Column, strip_literal: bool = False) -> Column:
    """Runs of non-word characters become one space, then trim and lower-case.

    ``strip_literal`` first takes the text out of a quoted literal, so that a language tag
    or datatype does not become part of the name.
    """
    if strip_literal:
        name = F.regexp_replace(name, r'(?s)\A"(.*)"(?:@[A-Za-z0-9-]+|\^\^\S+)?\z', "$1")
    return F.lower(F.trim(F.regexp_replace(name, NON_WORD, " ")))


def wiki_title(link: Column) -> Column:
    """What follows the last article prefix of a link; null when the prefix is absent."""
    return F.when(F.contains(link, F.lit(WIKI_PREFIX)),
                  F.substring_index(link, WIKI_PREFIX, -1))
