"""Annotation quads: one text line becomes one typed row. Map-only."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelore import schemas
from pagelore.fixed_values import QUAD_ERROR_SUBJECT
from pagelore.functions.annotations import QUAD_FIELDS, quad_fields
from pagelore.operators.domains import top_private_domain


def parse_quads(lines: DataFrame, line_col: str = "value", on_error: str = "keep") -> DataFrame:
    """Split quad lines into subject, predicate, obj, url and extractor.

    Lines of another form become one marker row each (``on_error="keep"``) or are left
    out (``"drop"``).
    """
    if on_error not in ("keep", "drop"):
        raise ValueError(f"on_error must be keep or drop, not {on_error!r}")
    # Exploding keeps a check of the result from running the pattern a second time.
    parsed = lines.select(F.explode_outer(quad_fields(F.col(line_col))).alias("fields"))
    if on_error == "drop":
        parsed = parsed.where(F.col("fields").isNotNull())
    marker = F.array(F.lit(QUAD_ERROR_SUBJECT), *[F.lit("")] * (len(QUAD_FIELDS) - 1))
    fields = parsed.select(F.coalesce("fields", marker).alias("fields"))
    return fields.select(*(F.col("fields")[i].alias(n) for i, n in enumerate(QUAD_FIELDS)))


def annotations_from_quads(
    lines: DataFrame,
    line_col: str = "value",
    on_error: str = "keep",
    rules: DataFrame | None = None,
) -> DataFrame:
    """Parsed quads with the private-domain label of the page they come from."""
    quads = parse_quads(lines, line_col, on_error)
    return top_private_domain(quads, "url", "tpd", rules).select(schemas.ANNOTATIONS.names)
