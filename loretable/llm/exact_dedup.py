"""Exact deduplication by 128-bit content hash with byte comparison inside groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loretable.llm.common import documents_of, materialize, member_test, spread_join, without

#: Deleted before texts are compared: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = "[\\x20\\x09-\\x0D]+"


def normalized(text: Column) -> Column:
    return F.regexp_replace(text, BLANKS, "")


def exact_groups(docs: DataFrame, content_hash=lambda text: F.unhex(F.md5(text))) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without blanks (null counts as empty). Of equal texts the row
    with the most code points in its original text stays, then the smallest doc_id. Rows are grouped
    by the 128-bit hash of the normalised text, and only hash, length and id are shuffled, combined
    before. Texts of groups with several rows (and only they) are compared byte by byte: the least and
    the greatest text of each hash are taken, combined before the shuffle too, so a group of very many
    copies sends one text a task. Where they differ (a hash collision) rows are grouped again by the
    text itself. Rows of large groups meet their group's row in several tasks. A row repeated with the
    same doc_id counts as often as it stands there, and every repetition is returned; null doc_ids sort
    last. An empty table gives an empty result. A very long text is hashed and compared as a whole by one task.

    content_hash: column function for the 128-bit hash of the normalised text.
    """
    texts = documents_of(docs)
    norm = normalized(F.col("text"))
    made = texts.select("doc_id", F.length("text").alias("n"), norm.alias("norm"))
    rows = materialize(made.select("doc_id", "n", content_hash("norm").alias("h"), F.sha2("norm", 256).alias("sha")), "hashes")

    # (most code points, smallest id) as one orderable struct: the smallest of it stays
    order = F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    several = rows.groupBy("h").agg(F.min(order).alias("best"), F.count("*").alias("size")).where("size > 1")
    several = materialize(several.select("h", F.col("best.id").alias("keep"), "size"), "several")
    maybe = member_test(several, "h")

    # Texts are read again only where the id is one of a row in such a group (or taken for one).
    asked = member_test(rows.where(maybe(F.col("h"))), "doc_id")
    members = texts.where(asked(F.col("doc_id"))).select(norm.alias("norm"), F.length("text").alias("n"), "doc_id").withColumn("h", content_hash("norm"))
    mixed = materialize(members.where(maybe(F.col("h"))).groupBy("h").agg(F.min("norm").alias("a"), F.max("norm").alias("z")).where("a <> z").select("h"), "mixed")

    single = rows.where(~maybe(F.col("h"))).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha")
    grouped = spread_join(rows.where(maybe(F.col("h"))), several, "h", "size")
    if mixed.head(1):
        apart = members.join(mixed, "h", "left_semi").groupBy("h", "norm").agg(F.min(order).alias("own"), F.count("*").alias("own_size"))
        apart = materialize(apart.select("h", F.sha2("norm", 256).alias("sha"), F.col("own.id").alias("own_keep"), "own_size", F.lit(True).alias("apart")), "collided")
        grouped = grouped.join(apart, ["h", "sha"], "left").withColumn("keep", F.when(F.col("apart"), F.col("own_keep")).otherwise(F.col("keep"))).withColumn("size", F.coalesce("own_size", "size"))
    found = grouped.select("doc_id", F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"), F.coalesce("size", F.lit(1)).cast("long").alias("group_size"), "sha")
    out = single.unionByName(found).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns: one row of each group of equal texts.

    Rows are decided by doc_id and text, so null and repeated doc_ids lose no text.
    """
    groups = exact_groups(docs).select("doc_id", F.col("text_sha256").alias("key"), "kept")
    return without(docs, groups, lambda text: F.sha2(normalized(text), 256))
