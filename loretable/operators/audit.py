"""Audits: review findings, preferences between drafts, character packages, grounding of extractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loretable.functions.text import is_blank, strip

PLACEHOLDERS = ("NULL", "TODO")
LINE_CHARS, LINES, SUMMARY_CHARS, UNKNOWN = 30, 3, (100, 200), "未知"


def checked_findings(findings: DataFrame, labels: list[str]) -> DataFrame:
    """findings with problem: a label that is none of the allowed ones, or no evidence (null: fine)."""
    return findings.withColumn("problem", F.when(~F.coalesce(F.col("label").isin(*labels), F.lit(False)), "unknown label").when(is_blank("evidence"), "no evidence"))


def finding_tallies(findings: DataFrame) -> DataFrame:
    return findings.groupBy("label", "severity").agg(F.count("*").alias("count"))


def preferences(reviews: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(winner, loser, tags) per review(candidate_a, candidate_b, winner, tags_a, tags_b), and wins, losses
    and win rate per candidate; ties (another or no winner) count as compared only."""
    a_wins, b_wins = F.col("winner") == F.col("candidate_a"), F.col("winner") == F.col("candidate_b")
    pairs = reviews.where(a_wins | b_wins).select(
        "winner", F.when(a_wins, F.col("candidate_b")).otherwise(F.col("candidate_a")).alias("loser"),
        F.when(a_wins, F.col("tags_a")).otherwise(F.col("tags_b")).alias("winner_tags"), F.when(a_wins, F.col("tags_b")).otherwise(F.col("tags_a")).alias("loser_tags"),
    )
    side = lambda me, won, lost: F.struct(F.col(me).alias("candidate"), F.coalesce(won, F.lit(False)).alias("won"), F.coalesce(lost, F.lit(False)).alias("lost"))
    sides = reviews.select(F.inline(F.array(side("candidate_a", a_wins, b_wins), side("candidate_b", b_wins, a_wins))))
    per = sides.groupBy("candidate").agg(F.count("*").alias("compared"), F.count_if("won").alias("wins"), F.count_if("lost").alias("losses"))
    return pairs, per.withColumn("win_rate", F.col("wins") / F.col("compared"))


def package_audit(fields: DataFrame, evidence: DataFrame, chunks: DataFrame, key_fields: tuple[str, ...] = ()) -> DataFrame:
    """(character, field, problem) for flat packages(character, field, value) with evidence(character,
    field, chunk_id): placeholders, filled fields without evidence, key fields with less than two, evidence
    chunks that do not exist, and packages without a name."""
    value = strip(F.coalesce("value", F.lit("")))
    rows = fields.withColumn("v", value).withColumn("empty", (value == "") | F.upper(value).isin(*PLACEHOLDERS))
    there = evidence.join(chunks.select("chunk_id").distinct().withColumn("exists", F.lit(True)), "chunk_id", "left")
    counts = there.where("exists").groupBy("character", "field").agg(F.count_distinct("chunk_id").alias("n"))
    joined = rows.join(counts, ["character", "field"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    problem = (
        F.when(F.col("empty") & (F.col("v") != ""), "placeholder").when(F.col("empty") & (F.col("field") == "name"), "no name").when(~F.col("empty") & (F.col("n") == 0), "no evidence")
        .when(~F.col("empty") & F.col("field").isin(*key_fields) & (F.col("n") < 2), "one evidence")
    )
    found = joined.select("character", "field", problem.alias("problem")).where("problem is not null")
    return found.unionByName(there.where("exists is null").select("character", "field", F.lit("evidence chunk missing").alias("problem")))


def grounding(canon: DataFrame, style: DataFrame, chunks: DataFrame) -> DataFrame:
    """(chunk_id, kind, item, grounded, notice): names, places and dialogue lines, and whether they stand
    verbatim in their chunk's text; lines also by length and number, summaries by length."""
    texts = chunks.select("chunk_id", F.coalesce("text", F.lit("")).alias("_text"))
    item = lambda k, c, notice=F.lit(None).cast("string"): F.struct(F.lit(k).alias("kind"), strip(c).alias("item"), notice.alias("notice"))
    none = F.array().cast("array<struct<kind:string,item:string,notice:string>>")
    length = F.length(F.coalesce("summary", F.lit("")))
    band = F.when(length < SUMMARY_CHARS[0], "short").when(length > SUMMARY_CHARS[1], "long")
    of_canon = F.concat(
        F.coalesce(F.transform("characters", lambda x: item("character", x["name"])), none),
        F.coalesce(F.transform("locations", lambda x: item("location", x)), none), F.array(item("summary", F.coalesce("summary", F.lit("")), band)),
    )
    of_style = F.transform("key_dialogues", lambda x, i: item("dialogue", x["line"], F.when(F.length(x["line"]) > LINE_CHARS, "long").when(i >= LINES, "too many")))
    rows = canon.select("chunk_id", F.inline(of_canon)).unionByName(style.select("chunk_id", F.inline(of_style))).where("kind = 'summary' or item <> ''")
    joined = rows.join(texts, "chunk_id", "left")
    return joined.select("chunk_id", "kind", "item", F.when(F.col("kind") != "summary", F.coalesce(F.col("_text").contains(F.col("item")), F.lit(False))).alias("grounded"), "notice")


def grounding_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("kind").agg(F.count("*").alias("items"), F.count_if("grounded").alias("grounded"), F.count("notice").alias("notices"))


def unknown_emotions(facts: DataFrame, by: str = "chapter_hint") -> DataFrame:
    """(by, appearances, unknown): how many emotions are missing or marked unknown."""
    return facts.groupBy(by).agg(F.count("*").alias("appearances"), F.count_if(F.col("emotion").isNull() | (F.col("emotion") == UNKNOWN)).alias("unknown"))
