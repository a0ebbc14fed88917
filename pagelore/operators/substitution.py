"""Rewriting annotations with the matched entities. Bag semantics throughout.

Mappings may come with a column ``copies`` (:func:`count_copies`). Equal rows then travel
through both joins as one row with a number, and :func:`repeat_copies` spells them out.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelore import schemas

# Rows that one array of repetitions makes; more copies take several arrays.
_BLOCK = 100_000


def count_copies(mappings: DataFrame) -> DataFrame:
    """Merge equal mappings and count them; most of the merging happens before the shuffle.
    Mappings that are counted already are added up."""
    copies = F.sum("copies") if _copies(mappings) else F.count("*")
    return mappings.groupBy(schemas.MAPPINGS.names).agg(copies.alias("copies"))


def repeat_copies(df: DataFrame) -> DataFrame:
    """As many rows as ``copies`` says."""
    others = [name for name in df.columns if name != "copies"]
    last = F.floor((F.col("copies") - 1) / _BLOCK)
    blocks = df.select(
        *others, "copies", F.explode(F.sequence(F.lit(0), last)).alias("block")
    )
    left = F.least(F.lit(_BLOCK), F.col("copies") - F.col("block") * _BLOCK)
    return blocks.select(*others, F.explode(F.sequence(F.lit(1), left))).drop("col")


def substitute_obj(obj: str, entity: str) -> Column:
    """The matched entity where there is one, else the object as it was."""
    return F.coalesce(F.col(entity), F.col(obj))


def substitute_subjects(mappings: DataFrame, annotations: DataFrame) -> DataFrame:
    """Annotations whose subject was matched, with the matched entity as subject."""
    triples = annotations.select("url", F.col("subject").alias("local"), "predicate", "obj")
    same = (F.col("pageUrl") == F.col("url")) & (F.col("localEntityUri") == F.col("local"))
    return mappings.join(triples, same).select(
        F.col("pageUrl").alias("triplePageUrl"),
        F.col("dbPediaUri").alias("subject"),
        "url",
        "predicate",
        "obj",
        *_copies(mappings),
    )


def substitute_objects(mappings: DataFrame, substituted: DataFrame) -> DataFrame:
    """Put matched entities in the place of objects; unmatched objects stay."""
    same = (F.col("pageUrl") == F.col("triplePageUrl")) & (F.col("localEntityUri") == F.col("obj"))
    counted = _copies(mappings) and _copies(substituted)
    copies = F.col("copies") * F.coalesce(F.col("object_copies"), F.lit(1))
    entities = mappings.withColumnRenamed("copies", "object_copies")
    return (
        substituted.join(entities, same, "left")
        .withColumn("obj", substitute_obj("obj", "dbPediaUri"))
        .select(*schemas.KNOWLEDGE_BASE.names, *([copies.alias("copies")] if counted else []))
    )


def _copies(df: DataFrame) -> list[str]:
    return [name for name in df.columns if name == "copies"]
