"""Appearances of characters (the finest facts) and the profiles made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loretable.functions.text import or_null, strip
from loretable.operators.indexes import ARRAY_ITEMS

TOP = 20
TOKEN_MARKS = "[、，,]"


def appearances(kb: DataFrame, aliases: DataFrame) -> DataFrame:
    """One row per named character entry of a chunk, its name resolved one hop through aliases(alias,
    canonical, alias_source). An alias that stands there several times resolves to its least canonical."""
    e = F.col("e")
    rows = kb.select("chunk_id", F.col("chapter_hint"), "char_start", "char_end", F.posexplode("canon.characters").alias("pos", "e"))
    rows = rows.select("chunk_id", "pos", "chapter_hint", "char_start", "char_end", strip(F.coalesce(e["name"], F.lit(""))).alias("raw_name"), or_null(e["action"]).alias("action"), or_null(e["emotion"]).alias("emotion")).where("raw_name <> ''")
    one = aliases.groupBy("alias").agg(F.min(F.struct("canonical", "alias_source")).alias("x")).select("alias", "x.canonical", "x.alias_source")
    return rows.join(one, rows["raw_name"] == one["alias"], "left").select(
        F.coalesce("canonical", "raw_name").alias("canonical_name"), "raw_name", "chunk_id", "pos", "chapter_hint", "char_start", "char_end", "action", "emotion", F.coalesce("alias_source", F.lit("identity")).alias("alias_source")
    )


def source_counts(facts: DataFrame) -> DataFrame:
    return facts.groupBy("alias_source").agg(F.count("*").alias("count"))


def top_values(facts: DataFrame, column: str, most: int = TOP, tokens: bool = False) -> DataFrame:
    """(canonical_name, value, n, rank): the most frequent values, ties by first sight. Counts are made
    before ranks, so what is ranked is the distinct values only."""
    rows = facts.where(F.col(column).isNotNull())
    if tokens:
        rows = rows.select("canonical_name", "chunk_id", "pos", F.posexplode(F.transform(F.split(column, TOKEN_MARKS), strip)).alias("part", "value")).where("value <> ''")
    else:
        rows = rows.select("canonical_name", "chunk_id", "pos", F.lit(0).alias("part"), F.col(column).alias("value"))
    n = rows.groupBy("canonical_name", "value").agg(F.count("*").alias("n"), F.min(F.struct("chunk_id", "pos", "part")).alias("first_at"))
    w = Window.partitionBy("canonical_name").orderBy(F.desc("n"), "first_at")
    return n.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most).select("canonical_name", "value", "n", "rank")


def in_chunks(facts: DataFrame) -> DataFrame:
    """(canonical_name, chunk_id, n). Rows are dealt by chunk, so what else is grouped or joined by chunk finds them in
    place, and several uses in one job share one shuffle."""
    return facts.select("canonical_name", "chunk_id").repartition("chunk_id").groupBy("canonical_name", "chunk_id").agg(F.count("*").alias("n"))


def profile_counts(facts: DataFrame) -> DataFrame:
    """(canonical_name, mention_count, chunk_count, first_chunk, last_chunk) in two steps: by chunk, then by name."""
    return in_chunks(facts).groupBy("canonical_name").agg(F.sum("n").alias("mention_count"), F.count("*").alias("chunk_count"), F.min("chunk_id").alias("first_chunk"), F.max("chunk_id").alias("last_chunk"))


def observed_aliases(facts: DataFrame) -> DataFrame:
    return facts.where("raw_name <> canonical_name").select("canonical_name", F.col("raw_name").alias("alias")).distinct()


def profiles(facts: DataFrame, most: int = TOP, with_chunks: bool = True) -> DataFrame:
    """A character's aliases, counts, first chunks (at most ARRAY_ITEMS) and top values as arrays. The whole
    chunk list, which grows with the corpus, is in the long table of facts; with_chunks=False gives none."""
    out = profile_counts(facts)
    arrays = {
        "aliases": observed_aliases(facts).groupBy("canonical_name").agg(F.array_sort(F.collect_list("alias")).alias("aliases")),
        "top_actions": _ranked_array(top_values(facts, "action", most), "top_actions"),
        "top_emotions": _ranked_array(top_values(facts, "emotion", most, tokens=True), "top_emotions"),
    }
    if with_chunks:
        place = F.row_number().over(Window.partitionBy("canonical_name").orderBy("chunk_id"))
        first = facts.select("canonical_name", "chunk_id").distinct().withColumn("place", place).where(F.col("place") <= ARRAY_ITEMS)
        arrays["chunk_ids"] = first.groupBy("canonical_name").agg(F.array_sort(F.collect_list("chunk_id")).alias("chunk_ids"))
    for name, df in arrays.items():
        out = out.join(df, "canonical_name", "left").withColumn(name, F.coalesce(name, F.array().cast("array<string>")))
    return out


def _ranked_array(ranked: DataFrame, name: str) -> DataFrame:
    return ranked.groupBy("canonical_name").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "value"))), lambda x: x["value"]).alias(name))


def top_profiles(counts: DataFrame, observed: DataFrame | None = None, most: int = 10) -> DataFrame:
    """The most mentioned profiles, with their observed aliases (canonical_name, alias) as one text if given."""
    top = counts.orderBy(F.desc("mention_count"), "canonical_name").limit(most)
    if observed is None:
        return top
    named = observed.join(top.select("canonical_name"), "canonical_name").groupBy("canonical_name").agg(F.array_join(F.array_sort(F.collect_set("alias")), ", ").alias("aliases"))
    return top.join(named, "canonical_name", "left").withColumn("aliases", F.coalesce("aliases", F.lit("")))


def encoding_check(names: DataFrame, column: str = "canonical_name") -> DataFrame:
    """One row: names, names of ASCII only, and whether some are not (a sign that the text survived)."""
    ascii_only = F.col(column).rlike(r"\A[\x00-\x7F]*\z")
    return names.agg(F.count(column).alias("names"), F.count_if(ascii_only).alias("ascii_names")).withColumn("looks_right", F.col("ascii_names") < F.col("names"))
