"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. Its result is written as
Parquet and read again as the next one's documents. All but the last return the columns of
``documents``; mixing repeats a document's row for each copy that it takes.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelore.llm import line_dedup, mixing, ngram_join, toxicity
from pagelore.llm.queries import packed_pieces
from pagelore.llm.storage import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from the labels not held out, rejects go.

    A model without any weight, as without usable labels, rejects nothing.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels, usable=~toxicity.held_out(F.col("doc_id")))
    if model.knows_nothing:
        return docs.select(*COLUMNS)
    scored = toxicity.with_score(docs, model, keep=list(COLUMNS), name="toxic_score")
    return scored.where(F.col("toxic_score") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sites, and those of over 50 words that stand on two, stay in
    one document only; no document goes."""
    cleaned = line_dedup.remove_boilerplate(docs.select(*COLUMNS), passage_sites=2)
    length = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", length.cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8, the one with the smallest id stays."""
    like = ngram_join.Similarity(k=5, percent=80)
    return ngram_join.without_near_duplicates(docs.select(*COLUMNS), like)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks for, up to three times."""
    mixed = mixing.mix(docs.select(*COLUMNS)).where("copies > 0")
    copies = F.sequence(F.lit(1), F.col("copies"))
    return mixed.select(*COLUMNS, F.explode(copies).alias("copy")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and the place in it."""
    return packed_pieces(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: The classifier, the similarity join and the packing cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    result = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        result = stage(function(spark, result, sf_dir), name.replace(" ", "-"), keep=True)
    return result
