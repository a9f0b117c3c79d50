"""A corpus-cleaning pipeline: each stage takes and returns documents, the last one packed pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loretable.llm import quality, toxicity
from loretable.llm.common import materialize, table
from loretable.llm.exact_dedup import exact_dedup
from loretable.llm.packing import best_fit_packing
from loretable.llm.simhash import similar_dedup

#: No SQL: two stages are trained models, and two link or pack by search.
ORACLE_SQL = None


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with toxic passages go; the model is fitted on the labelled ones among docs.

    Null and empty texts stay; without labels of both kinds all stay. Rows are decided one by one, with
    all their columns, whatever these are called.
    """
    return toxicity.not_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of low quality go; the network is trained on the labelled ones among docs.

    Null texts are judged as empty ones; without labels of both kinds all stay.
    """
    return quality.good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts stays (equal without blanks): the longest, then the smallest id.

    Null and empty texts are one group. Rows are decided by id and text, so null and repeated ids lose
    no other text; a row that stands there twice stays once.
    """
    return exact_dedup(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of near copies stays (word five-shingles at least 0.8 alike): the smallest id.

    Texts of less than five words are alike if they have the same words; ids as in the stage before.
    """
    return similar_dedup(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents that are left, packed into sequences; null and empty texts are one id each."""
    return best_fit_packing(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("simhash near-dedup", simhash_stage),
    ("best-fit packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs, "stage")
    return docs
