"""The registered queries of the training-data operators, each over its whole table, and their SQL."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loretable.llm import fill_in_middle, filter_audit, warc
from loretable.llm.common import id_remainder, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loretable.llm import toxicity

    docs, held_out = table(spark, sf_dir, "documents"), id_remainder(3) == 1
    model = toxicity.fit(docs.where(~held_out), table(spark, sf_dir, "labels"), "toxic")
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loretable.llm.embedding_dedup import near_embeddings

    return near_embeddings(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loretable.llm.language_model import score_documents

    held_out = id_remainder(7) == 2
    scored = score_documents(table(spark, sf_dir, "documents"), ~held_out, order=2)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document enters with a quick estimate, is revised to its exact count, and gets a second
    version; that batch is sent twice, as after a lost answer. Then the estimates of a third version go
    for all documents that have a word, so what is left of it are the documents without any."""
    from loretable.llm import token_counts
    from loretable.llm.common import shared_dir

    docs = table(spark, sf_dir, "documents")
    ledger = token_counts.TokenLedger(spark, f"{shared_dir(spark)}/ledger-{uuid4().hex}")
    estimates = token_counts.estimated_counts(docs, "word_bpe_49k")
    ledger.apply("estimates", estimates.unionByName(estimates.withColumn("version", F.lit("words"))))
    exact = token_counts.count_tokens(docs, op="revise")
    ledger.apply("exact", exact)
    ledger.apply("exact", exact)
    ledger.apply("counted", token_counts.deleted(docs.where(F.coalesce(F.trim("text"), F.lit("")) != ""), ["words"]))
    return ledger.totals()


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(table(spark, sf_dir, "pages"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loretable.llm.packing import best_fit_packing

    return best_fit_packing(table(spark, sf_dir, "documents"), capacity=4096, end_id=1)


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loretable.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, tau=4)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loretable.llm.bpe_tree import round_trip

    return round_trip(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loretable.llm import quality

    docs, held_out = table(spark, sf_dir, "documents"), id_remainder(5) == 0
    model = quality.fit(docs.where(~held_out), table(spark, sf_dir, "labels"), "quality")
    scored = quality.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loretable.llm.exact_dedup import exact_groups

    return exact_groups(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = fill_in_middle.restored(fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"), seed=1))
    return outputs.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(spark, f"{sf_dir.rstrip('/')}/documents.parquet", table(spark, sf_dir, "labels"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loretable.llm.hnsw import nearest_vectors

    embeddings = table(spark, sf_dir, "embeddings")
    return nearest_vectors(embeddings, embeddings.where("vec_id % 20 = 0"), k=20)


OP10_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
  FROM documents
), g AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_language_model": op3_language_model,
    "op4_token_counts": op4_token_counts,
    "op6_warc_derivatives": op6_warc_derivatives,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_quality": op9_quality,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_filter_audit": op12_filter_audit,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}
ORACLE_SQL = {
    "op6_warc_derivatives": warc.ORACLE_SQL,
    "op10_exact_dedup": OP10_SQL,
    "op11_fill_in_middle": fill_in_middle.ORACLE_SQL,
    "op12_filter_audit": filter_audit.ORACLE_SQL,
}
