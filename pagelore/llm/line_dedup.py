"""Line dedup: lines that stand on many sites are boilerplate.

Built of DataFrame functions only. The sites of each line are counted by HyperLogLog sketches
that merge inside the aggregation; lines whose estimate lies near the limit are counted exactly.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelore.llm.storage import stage, temporaries
from pagelore.operators.grouping import group_to_join
from pagelore.operators.prefilter import key_filter, maybe_in

#: A line on so many sites is boilerplate.
SITES = 3
#: A line of more words is a passage, which may have a limit of its own.
PASSAGE_WORDS = 50
SKETCH_BITS = 12
#: Estimates within this share of the limit are checked: nine standard errors of the sketch.
MARGIN = 9 * 1.04 / 2 ** (SKETCH_BITS / 2)


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line, F.lit(" \t\r")))


def _is_blank(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r")) == ""


def _is_passage(line: Column) -> Column:
    # Words and the spaces between them take twice as many characters at least.
    trimmed = F.trim(line, F.lit(" \t\r"))
    words = F.size(F.split(trimmed, r"\s+"))
    return F.when(F.length(trimmed) > 2 * PASSAGE_WORDS, words > PASSAGE_WORDS).otherwise(F.lit(False))


def line_sites(docs: DataFrame, passages: bool = False) -> DataFrame:
    """(doc_id, text_hash, site, line): the different lines of each document, as hashes.

    White space around a line does not count; blank lines are left alone. With ``passages``,
    is_passage says whether a line has more than PASSAGE_WORDS words.
    """
    text = F.col("text").cast("string")
    filled = F.filter(_lines(text), lambda x: ~_is_blank(x))
    named = ["doc_id", "text_hash", "site"]
    of_line = lambda x: F.struct(_line_hash(x).alias("line"), _is_passage(x).alias("is_passage"))
    found = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("site"),
        F.explode(F.array_distinct(F.transform(filled, of_line if passages else _line_hash))).alias("line"),
    )
    return found.select(*named, "line.line", "line.is_passage") if passages else found


def boilerplate(lines: DataFrame, sites: int = SITES, passage_sites: int | None = None) -> DataFrame:
    """(line, first): lines on at least ``sites`` sites and the document that has each first.

    With ``passage_sites``, that is the limit of the lines marked is_passage. The first document
    is the one with the smallest id, null before all; equal ids go by the hash of the text. Lines
    far from the limit are decided by their sketch, the others by an exact count. For that, the
    scan leaves out the lines that are far from it, and equal pairs of line and site become one
    before the pairs of a line meet: about as many as the limit, however often the line stands.
    """
    holder = F.struct("doc_id", "text_hash")
    is_passage = F.lit(False) if passage_sites is None else F.max("is_passage")
    limit = F.when(is_passage, passage_sites or sites).otherwise(sites)
    estimated = lines.groupBy("line").agg(
        F.hll_sketch_agg("site", SKETCH_BITS).alias("sketch"), F.min(holder).alias("first"),
        limit.alias("limit"),
    )
    estimated = estimated.select(
        "line", "first", "limit", F.hll_sketch_estimate("sketch").alias("spread")
    ).where(F.col("spread") >= F.greatest(F.lit(1.5), F.col("limit") * (1 - MARGIN) - 0.5))
    estimated = stage(estimated, "line-spread")
    is_near = F.col("spread") <= F.col("limit") * (1 + MARGIN) + 0.5
    near = estimated.where(is_near).select(F.col("line").alias("near_line"), "first", "limit")
    held = maybe_in(lines.select("line", "site"), "line", key_filter(near, "near_line")).distinct()
    counted = held.join(near, F.col("line") == F.col("near_line")).groupBy("line").agg(
        F.count("*").alias("n"), F.first("first").alias("first"), F.first("limit").alias("limit"),
    )
    exact = counted.where(F.col("n") >= F.col("limit")).select("line", "first")
    return estimated.where(~is_near).select("line", "first").unionByName(exact)


def _gone_lines(docs: DataFrame, sites: int, passage_sites: int | None) -> DataFrame:
    """(gone_id, gone_hash, gone_lines): hashes of the lines that each document loses."""
    lines = stage(line_sites(docs, passage_sites is not None), "lines")
    known = stage(boilerplate(lines, sites, passage_sites), "boilerplate")
    known = known.select(F.col("line").alias("known_line"), "first")
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    extra = lines.join(known, F.col("line") == F.col("known_line")).where(~is_first)
    gone = group_to_join(extra, "doc_id", "text_hash").agg(F.collect_set("line").alias("gone_lines"))
    return gone.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"), "gone_lines")


def remove_boilerplate(docs: DataFrame, sites: int = SITES, passage_sites: int | None = None) -> DataFrame:
    """All rows and columns with ``text`` cleaned, and n_lines and n_removed added.

    A line on ``sites`` different sources or more stays in the document that has it first and
    goes from all others, wherever it stands there; with ``passage_sites``, lines of more than
    PASSAGE_WORDS words do so from that many sources on. What repeats within one source only
    stays. Null sources are one site. n_lines counts
    the lines that are not blank. Null and empty texts stay as they are; a text can become
    empty but its row stays. Rows equal in id and text are one document. Columns named n_lines
    or n_removed are replaced.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    with temporaries(docs.sparkSession):
        gone = stage(_gone_lines(docs, sites, passage_sites), "gone-lines", keep=True)
    text = F.col("text").cast("string")
    rows = docs.select(F.struct(*names).alias("row"), F.xxhash64(text).alias("row_hash"))
    joined = rows.join(
        gone,
        (F.col("row_hash") == F.col("gone_hash")) & F.col("row.doc_id").cast("long").eqNullSafe(F.col("gone_id")),
        "left",
    )
    row_text = F.col("row.text").cast("string")
    is_gone = lambda x: ~_is_blank(x) & F.array_contains("gone_lines", _line_hash(x))
    kept = F.array_join(F.filter(_lines(row_text), lambda x: ~is_gone(x)), "\n")
    removed = F.size(F.filter(_lines(row_text), is_gone))
    filled = F.size(F.filter(_lines(row_text), lambda x: ~_is_blank(x)))
    changed = F.col("gone_lines").isNotNull()
    columns = [
        F.when(changed, kept).otherwise(row_text).alias(c) if c == "text" else F.col("row")[c].alias(c)
        for c in names
    ]
    return joined.select(
        *columns, F.when(row_text.isNull(), 0).otherwise(filled).alias("n_lines"),
        F.when(changed, removed).otherwise(0).alias("n_removed"),
    )


#: SQL for doc_id, n_lines, n_removed and text of :func:`remove_boilerplate` on ``documents``.
SQL = f"""
WITH lines AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM documents
), marked AS (
  SELECT doc_id, coalesce(source, '') AS site, text, trim(line, ' ' || chr(9) || chr(13)) AS line
  FROM lines
), known AS (
  SELECT line, min({{'doc_id': doc_id, 'text': text}}) AS first FROM marked WHERE line <> ''
  GROUP BY line HAVING count(DISTINCT site) >= {SITES}
), parts AS (
  SELECT doc_id, text, generate_subscripts(string_split(text, chr(10)), 1) AS i,
         unnest(string_split(text, chr(10))) AS line
  FROM documents
), judged AS (
  SELECT p.doc_id, p.i, p.line, trim(p.line, ' ' || chr(9) || chr(13)) <> '' AS filled,
         k.line IS NOT NULL AND k.first.doc_id <> p.doc_id AS gone
  FROM parts p LEFT JOIN known k ON k.line = trim(p.line, ' ' || chr(9) || chr(13))
)
SELECT doc_id, count(*) FILTER (filled) AS n_lines, count(*) FILTER (gone) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text
FROM judged GROUP BY doc_id
"""
