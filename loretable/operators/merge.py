"""The knowledge base: both extractions of each chunk side by side, with its place in the source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

META = ("source_file", "chapter_hint", "char_start", "char_end")
CANON_FIELDS = ("summary", "characters", "events", "locations", "time_markers", "relationships")
STYLE_FIELDS = ("narration_tone", "dialogue_density", "prose_features", "key_dialogues", "style_tags")


def master(canon: DataFrame, style: DataFrame) -> DataFrame:
    """Full outer join on chunk_id; meta from canon where it is there, else from style; texts missing in
    both are empty, places null. Both sides are hashed on one key, which later steps can use again."""

    def side(df: DataFrame, fields: tuple[str, ...], name: str) -> DataFrame:
        meta = [(F.col(m) if m in df.columns else F.lit(None)).cast("bigint" if m.startswith("char") else "string").alias(f"{name}_{m}") for m in META]
        return df.select("chunk_id", *meta, F.struct(*[f for f in fields if f in df.columns]).alias(name))

    both = side(canon, CANON_FIELDS, "canon").join(side(style, STYLE_FIELDS, "style"), "chunk_id", "full_outer")

    def picked(m: str) -> Column:
        c = F.when(F.col("canon").isNotNull(), F.col(f"canon_{m}")).otherwise(F.col(f"style_{m}"))
        return (c if m.startswith("char_") else F.coalesce(c, F.lit(""))).alias(m)

    return both.select("chunk_id", *map(picked, META), "canon", "style")


def header(kb: DataFrame) -> DataFrame:
    return kb.agg(F.count("*").alias("total_chunks"), F.count("canon").alias("canon_chunks"), F.count("style").alias("style_chunks"))


def chunk_markdown(kb: DataFrame) -> DataFrame:
    """(chunk_id, markdown): summary, persons, relations, places, times and style of each chunk."""
    text = lambda c: F.coalesce(c, F.lit(""))
    some = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0

    def block(title: str, items: Column, line) -> Column:
        return F.when(some(items), F.concat(F.lit(f"**{title}**：\n"), F.array_join(F.transform(items, line), "\n")))

    style = F.concat_ws(
        " | ", F.when(text("style.narration_tone") != "", F.concat(F.lit("语气："), "style.narration_tone")),
        F.when(text("style.dialogue_density") != "", F.concat(F.lit("对话密度："), "style.dialogue_density")),
        F.when(some("style.style_tags"), F.concat(F.lit("标签："), F.array_join("style.style_tags", " / "))),
    )
    body = F.concat_ws(
        "\n",
        F.concat(F.lit("## ["), "chunk_id", F.lit("] "), text("chapter_hint")),
        F.concat(F.lit("**位置**：字符 "), text(F.col("char_start").cast("string")), F.lit("–"), text(F.col("char_end").cast("string"))),
        F.when(text("canon.summary") != "", F.concat(F.lit("**摘要**："), "canon.summary")),
        block("人物行为", F.col("canon.characters"), lambda p: F.concat(F.lit("- "), text(p["name"]), F.lit("："), text(p["action"]), F.lit("（"), text(p["emotion"]), F.lit("）"))),
        block("关系互动", F.col("canon.relationships"), lambda p: F.concat(F.lit("- "), text(p["person_a"]), F.lit(" × "), text(p["person_b"]), F.lit("："), text(p["interaction"]))),
        F.when(some("canon.locations"), F.concat(F.lit("**地点**："), F.array_join("canon.locations", ", "))),
        F.when(some("canon.time_markers"), F.concat(F.lit("**时间**："), F.array_join("canon.time_markers", ", "))),
        F.when(style != "", F.concat(F.lit("**风格**："), style)),
        F.lit(""),
    )
    return kb.select("chunk_id", body.alias("markdown"))
