"""One query for each operator, over whole tables, and SQL where it can say the same."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelore.llm import (
    exact_dedup,
    fim,
    langid,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    secrets,
    spelling,
    token_counts,
    token_store,
    toxicity,
    vector_dedup,
)
from pagelore.llm.storage import stage
from pagelore.llm.tokens import default_tokenizer


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = toxicity.held_out(F.col("doc_id"))
    model = toxicity.fit(docs, labels.select("doc_id", "toxic"), usable=~held_out)
    scored = toxicity.with_score(docs.select("doc_id", "text"), model, keep=["doc_id"])
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def packed_pieces(docs: DataFrame) -> DataFrame:
    """Pieces and their places; of the ids only the checksum stays."""
    pieces = packing.encode_pieces(docs, default_tokenizer())
    digests = pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32")
    )
    return packing.pack(stage(digests, "pieces", keep=True))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(_table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))
    of = lambda kind: F.filter("secrets", lambda s: s["kind"] == kind)
    base = F.filter("secrets", lambda s: s["kind"].isin(*secrets.BASE))
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    return found.select(
        "doc_id", *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in secrets.BASE),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.document_token_counts(_table(spark, sf_dir, "documents"), default_tokenizer()).select(
        "doc_id", "n_tokens", "ordinal", "start"
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.remove_boilerplate(_table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"),
        F.col("n_removed").cast("long").alias("n_removed"), "text",
    )


def op7_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed_sizes(_table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("copies")).cast("long").alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = token_store.token_store_round_trip(_table(spark, sf_dir, "documents"), default_tokenizer())
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").cast("long").alias("ids_crc32"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    like = ngram_join.Similarity(k=3, percent=90)
    found = ngram_join.similar_components(_table(spark, sf_dir, "documents"), like)
    return found.select("doc_id", "n_shingles", "component_id")


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs, usable=~held_out)
    found = langid.with_language(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_occurrences(_table(spark, sf_dir, "documents"), noise=97)
    found = spelling.spelling_variants(spelling.vocabulary(words))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.fill_in_middle(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    restored = fim.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_secret_scan": op4_secret_scan,
    "op5_token_counts": op5_token_counts,
    "op6_line_dedup": op6_line_dedup,
    "op7_vector_dedup": op7_vector_dedup,
    "op8_source_mixing": op8_source_mixing,
    "op9_token_store": op9_token_store,
    "op10_ngram_join": op10_ngram_join,
    "op11_language_id": op11_language_id,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_fill_in_middle": op13_fill_in_middle,
}

SQL = {
    "op2_exact_dedup": exact_dedup.SQL,
    "op6_line_dedup": line_dedup.SQL,
    "op13_fill_in_middle": fim.SQL,
}
