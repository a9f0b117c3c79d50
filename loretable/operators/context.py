"""Generation contexts: what is known of a person, assembled for a batch of writing tasks, and prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loretable.functions.text import is_blank, joined_or, strip
from loretable.operators.lookup import NONE

MODES = ("continue_writing", "rewrite")
# The wording of prompts is a parameter; these are plain defaults of our own.
WORDING = {
    "continue_writing": ("# Continue the story", "Write on from here. Keep persons, relations and places consistent with what is listed."),
    "rewrite": ("# Rewrite the passage", "Say the passage below anew. What is listed here prevails over the passage."),
    "source": "## Passage", "missing_source": "(no passage given)", "person": "## Person", "unmatched": "  no person found",
    "appearances": "## Appearances", "relations": "## Relation candidates (co-occurrence, no facts)", "places": "## Place candidates (co-occurrence, no facts)",
    "style": "## Style", "style_note": "placeholder: no automatic style source", "closing": "Candidates are hints only.",
}


def validate(tasks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good tasks (query, mode, source_text; text kept for rewriting only) and rejected ones with a reason."""
    reason = F.when(~F.coalesce(F.col("mode").isin(*MODES), F.lit(False)), "unknown mode").when((F.col("mode") == "rewrite") & is_blank("source_text"), "rewrite needs a source text")
    rows = tasks.withColumn("reason", reason)
    good = rows.where("reason is null").drop("reason").withColumn("source_text", F.when(F.col("mode") == "rewrite", F.col("source_text")).otherwise(""))
    return good, rows.where("reason is not null")


def resolution_note() -> Column:
    q, c = F.concat(F.lit("["), "query", F.lit("]")), F.concat(F.lit("["), "canonical_name", F.lit("]"))
    return (
        F.when(F.col("match_type") == "canonical", F.concat(q, F.lit(" is a canonical name")))
        .when(F.col("match_type") == "observed_alias", F.concat(q, F.lit(" is an observed alias of "), c))
        .when(F.col("match_type") == "query_alias", F.concat(q, F.lit(" is a query-time alias of "), c))
        .otherwise("no person matched in any layer")
    )


def contexts(tasks: DataFrame, results: DataFrame, style_note: str = WORDING["style_note"]) -> DataFrame:
    """(query, mode, context): one nested record per task; person results come once per query."""
    joined = tasks.join(results.dropDuplicates(["query"]), "query", "left")
    matched = F.coalesce("matched", F.lit(False))
    person = F.struct(
        matched.alias("matched"), "canonical_name", "match_type", F.coalesce("aliases", F.array().cast("array<string>")).alias("observed_aliases"),
        F.when(F.col("match_type") == "query_alias", F.col("query")).alias("query_alias_input"), F.coalesce("mention_count", F.lit(0)).alias("mention_count"), "first_chunk", "last_chunk",
    )
    lists = [F.coalesce(n, F.array().cast(results.schema[n].dataType)).alias(n) for n in ("appearance_samples", "relationship_candidates", "location_candidates")]
    style = F.struct(F.lit("placeholder").alias("status"), F.lit(style_note).alias("note"), F.lit("").alias("manual_style_hint"))
    return joined.select("query", "mode", F.struct("mode", "query", person.alias("resolved_character"), resolution_note().alias("query_resolution"), *lists, style.alias("style_guidance"), "source_text").alias("context"))


def prompts(built: DataFrame, wording: dict = WORDING, prefix: str = "") -> DataFrame:
    """(query, mode, prompt): contexts as text, with a stripped prefix and a blank line in front if there is one."""
    c = F.col("context")
    p = c["resolved_character"]
    item = lambda a, f: F.when(F.size(a) > 0, F.array_join(F.transform(a, f), "\n")).otherwise(f"  {NONE}")
    text = lambda x: F.coalesce(F.nullif(x.cast("string"), F.lit("")), F.lit(NONE))
    person = F.when(
        p["matched"],
        F.concat_ws("\n", F.concat(F.lit("  name: "), text(p["canonical_name"])), F.concat(F.lit("  matched by: "), text(p["match_type"])), F.concat(F.lit("  aliases: "), joined_or(p["observed_aliases"], "、", NONE)),
                    F.concat(F.lit("  resolution: "), c["query_resolution"]), F.concat(F.lit("  mentions: "), text(p["mention_count"])), F.concat(F.lit("  first chunk: "), text(p["first_chunk"])), F.concat(F.lit("  last chunk: "), text(p["last_chunk"]))),
    ).otherwise(wording["unmatched"])
    head = F.when(c["mode"] == "rewrite", F.lit("\n".join(wording["rewrite"]))).otherwise("\n".join(wording["continue_writing"]))
    source = F.when(c["mode"] == "rewrite", F.concat(F.lit(f"{wording['source']}\n"), F.when(is_blank(c["source_text"]), wording["missing_source"]).otherwise(strip(c["source_text"]))))
    body = F.concat_ws(
        "\n\n", head, source, F.concat(F.lit(f"{wording['person']}\n"), person),
        F.concat(F.lit(f"{wording['appearances']}\n"), item(c["appearance_samples"], lambda s: F.concat(F.lit("  - "), text(s["chunk_id"]), F.lit(" | "), text(s["raw_name"]), F.lit(" | "), text(s["action"]), F.lit(" | "), text(s["emotion"])))),
        F.concat(F.lit(f"{wording['relations']}\n"), item(c["relationship_candidates"], lambda s: F.concat(F.lit("  - "), text(s["related_person"]), F.lit(" | "), text(s["overlap_chunk_count"]), F.lit(" | "), text(s["interaction_sample"])))),
        F.concat(F.lit(f"{wording['places']}\n"), item(c["location_candidates"], lambda s: F.concat(F.lit("  - "), text(s["location"]), F.lit(" | "), text(s["overlap_chunk_count"])))),
        F.concat(F.lit(f"{wording['style']}\n  "), c["style_guidance"]["note"]), F.lit(wording["closing"]),
    )
    front = prefix.strip()
    return built.select("query", "mode", (F.concat(F.lit(f"{front}\n\n"), body) if front else body).alias("prompt"))
