"""Batch look-ups: names to persons, candidates of relation and place, samples, lists, keyword search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loretable.functions.text import distinct_in_order, joined_or, strip
from loretable.operators.characters import in_chunks

HIT_CHARS, PREVIEW = 200, 5
ORDER_NOTE = "Resolution order is canonical -> observed_alias -> query_alias."
SEPARATE_NOTE = "observed_aliases come from the profiles and stay separate from query-only aliases."
QUERY_NOTE = "query_alias_input is query-time only and is not promoted into observed aliases."
NO_MATCH_NOTE = "No person match found in canonical, observed_alias, or query_alias layers."
NONE = "（无）"


def resolve(queries: DataFrame, counts: DataFrame, observed: DataFrame, query_aliases: DataFrame) -> DataFrame:
    """(query, matched, canonical_name, match_type): canonical name, else the observed alias of the profile
    that is mentioned most, else a query alias whose canonical name has a profile."""
    known = counts.select("canonical_name", "mention_count")
    first = observed.join(known, "canonical_name").groupBy("alias").agg(F.max_by("canonical_name", F.struct("mention_count", "canonical_name")).alias("canonical_name"))
    later = query_aliases.join(known, query_aliases["canonical"] == known["canonical_name"]).groupBy("alias").agg(F.min("canonical_name").alias("canonical_name"))
    layer = lambda df, key, rank, kind: df.select(F.col(key).alias("name"), F.struct(F.lit(rank).alias("rank"), F.col("canonical_name").alias("canonical_name"), F.lit(kind).alias("match_type")).alias("x"))
    names = layer(known, "canonical_name", 0, "canonical").unionByName(layer(first, "alias", 1, "observed_alias")).unionByName(layer(later, "alias", 2, "query_alias"))
    best = names.groupBy("name").agg(F.min("x").alias("x"))
    asked = queries.select("query", strip("query").alias("name"))
    return asked.join(best, "name", "left").select("query", F.col("x").isNotNull().alias("matched"), "x.canonical_name", "x.match_type")


def relationship_candidates(relations: DataFrame, most: int | None = 3) -> DataFrame:
    """(person, related_person, overlap_chunk_count, interaction_sample, sample_chunk_id, rank) from
    relation entries (person_a, person_b, chunk_id, pos, interaction), for all persons at once."""
    one = relations.select(F.least("person_a", "person_b").alias("a"), F.greatest("person_a", "person_b").alias("b"), "chunk_id", "pos", "interaction")
    by_chunk = one.groupBy("a", "b", "chunk_id").agg(F.min(F.when(F.col("interaction") != "", F.struct("pos", "interaction"))).alias("first"))
    pairs = by_chunk.groupBy("a", "b").agg(F.count("*").alias("overlap_chunk_count"), F.min(F.when(F.col("first").isNotNull(), F.struct("chunk_id", "first"))).alias("s"), F.min("chunk_id").alias("sample_chunk_id"))
    # a pair is counted once, and then stands for both of its persons
    way = lambda a, b: F.struct(F.col(a).alias("person"), F.col(b).alias("related_person"))
    rows = pairs.select(F.inline(F.array_distinct(F.array(way("a", "b"), way("b", "a")))), "overlap_chunk_count", F.col("s.first.interaction").alias("interaction_sample"), "sample_chunk_id")
    return _top(rows, "person", "related_person", most)


def location_candidates(facts: DataFrame, places: DataFrame, most: int | None = 3) -> DataFrame:
    """(canonical_name, location, overlap_chunk_count, sample_chunk_id, rank): chunks shared by a person
    and a place. Both sides are made distinct before they meet on the chunk."""
    met = in_chunks(facts).join(places.select("location", "chunk_id").repartition("chunk_id").distinct(), "chunk_id")
    pairs = met.groupBy("canonical_name", "location").agg(F.count("*").alias("overlap_chunk_count"), F.min("chunk_id").alias("sample_chunk_id"))
    return _top(pairs, "canonical_name", "location", most)


def _top(rows: DataFrame, key: str, name: str, most: int | None) -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.desc("overlap_chunk_count"), name)
    ranked = rows.withColumn("rank", F.row_number().over(w))
    return ranked if most is None else ranked.where(F.col("rank") <= most)


def loose_relations(relations: DataFrame, queries: DataFrame) -> DataFrame:
    """Relation entries of pairs in which a queried name stands only inside a longer one, as if it were
    that name's own: (query, related_person, chunk_id, pos, interaction). The longer names are found by
    the containment join of the aliases, not by comparing all queries with all pairs."""
    from loretable.operators.aliases import containment

    asked = queries.select(F.col("query").alias("name"))
    people = relations.select(F.explode(F.array("person_a", "person_b")).alias("name"))
    inside = containment(asked.unionByName(people).distinct().withColumn("count", F.lit(1)))
    longer = inside.join(asked.distinct(), F.col("alias") == F.col("name"), "left_semi").select(F.col("alias").alias("query"), F.col("canonical_candidate").alias("longer"))
    entry = ["person_a", "person_b", "chunk_id", "pos", "interaction"]
    hits = [relations.join(longer, F.col(side) == F.col("longer")).select("query", *entry) for side in ("person_a", "person_b")]
    rows = hits[0].unionByName(hits[1]).dropDuplicates(["query", "chunk_id", "pos"])
    return rows.where("person_a <> query and person_b <> query").select("query", F.col("person_a").alias("related_person"), "chunk_id", "pos", "interaction")


def samples(facts: DataFrame, most: int) -> DataFrame:
    """The first appearances of each person in fact order."""
    w = Window.partitionBy("canonical_name").orderBy("chunk_id", "pos")
    rows = facts.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)
    return rows.select("canonical_name", "place", "raw_name", "chunk_id", "chapter_hint", "action", "emotion", "alias_source")


def _arrays(rows: DataFrame, key: str, order: str, fields: list[str], name: str) -> DataFrame:
    return rows.groupBy(F.col(key).alias("canonical_name")).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, *fields))), lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias(name))


def person_results(resolved: DataFrame, profiles: DataFrame, related: DataFrame, places: DataFrame, shown: DataFrame) -> DataFrame:
    """Resolved queries with profile, candidates and samples as arrays of at most a few items each."""
    out = resolved.join(profiles.drop("chunk_ids"), "canonical_name", "left")
    parts = {
        "relationship_candidates": _arrays(related, "person", "rank", ["related_person", "overlap_chunk_count", "interaction_sample", "sample_chunk_id"], "relationship_candidates"),
        "location_candidates": _arrays(places, "canonical_name", "rank", ["location", "overlap_chunk_count", "sample_chunk_id"], "location_candidates"),
        "appearance_samples": _arrays(shown, "canonical_name", "place", ["raw_name", "chunk_id", "chapter_hint", "action", "emotion", "alias_source"], "appearance_samples"),
    }
    for name, df in parts.items():
        out = out.join(df, "canonical_name", "left").withColumn(name, F.coalesce(name, F.array().cast(df.schema[name].dataType)))
    return out


def json_results(results: DataFrame) -> DataFrame:
    """(query, json): the machine contract, with and without a match."""
    by_query = F.col("match_type") == "query_alias"
    notes = F.when(F.col("matched"), F.filter(F.array(F.lit(ORDER_NOTE), F.lit(SEPARATE_NOTE), F.when(by_query, QUERY_NOTE)), lambda x: x.isNotNull())).otherwise(F.array(F.lit(NO_MATCH_NOTE)))
    body = F.struct(
        "query", F.lit("person").alias("query_type"), "matched", F.col("canonical_name").alias("resolved_canonical_name"), "match_type",
        F.coalesce("aliases", F.array().cast("array<string>")).alias("observed_aliases"), F.when(by_query, F.col("query")).alias("query_alias_input"), "appearance_samples", notes.alias("notes"),
    )
    return results.select("query", F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))


def entity_list(indexed: DataFrame, key: str, preview: int = PREVIEW) -> DataFrame:
    """(rank, entity, count, chunk_preview) of an index with arrays, by falling count."""
    w = Window.orderBy(F.desc("count"), "first_at", key)
    more = F.when(F.size("chunks") > preview, F.format_string(" 等 %d 个", F.size("chunks"))).otherwise("")
    return indexed.select(F.row_number().over(w).alias("rank"), F.col(key).alias("entity"), "count", F.concat(F.array_join(F.slice("chunks", 1, preview), ", "), more).alias("chunk_preview"))


def entity_page(posts: DataFrame, key: str, most: int, preview: int = PREVIEW) -> DataFrame:
    """The same for the most frequent entities only: one sort of the counts, and previews of those."""
    per = posts.groupBy(key).agg(F.sum("n").alias("count"), F.count("*").alias("chunks"), F.min(F.struct("chunk_id", "first_pos")).alias("first_at"))
    top = per.orderBy(F.desc("count"), "first_at").limit(most)
    w = Window.partitionBy(key).orderBy("chunk_id")
    first = posts.join(top.select(key), key).withColumn("place", F.row_number().over(w)).where(F.col("place") <= preview).groupBy(key).agg(F.array_join(F.array_sort(F.collect_list("chunk_id")), ", ").alias("shown"))
    more = F.when(F.col("chunks") > preview, F.format_string(" 等 %d 个", "chunks")).otherwise("")
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("count"), "first_at")))
    return ranked.join(first, key).select("rank", F.col(key).alias("entity"), "count", F.concat("shown", more).alias("chunk_preview"))


SEARCHED = {"chunk_id": "chunk_id", "chapter_hint": "chapter_hint", "summary": "canon.summary", "characters": "canon.characters", "events": "canon.events", "locations": "canon.locations", "time_markers": "canon.time_markers", "relationships": "canon.relationships"}


def search(kb: DataFrame, keyword: str, field: str | None = None) -> DataFrame:
    """(chunk_id, chapter_hint, char_start, char_end, field, hit): texts that hold the keyword, and the items of lists that do."""
    fields = {field: SEARCHED[field]} if field else SEARCHED

    def hit(path: str) -> Column:
        kind = kb.select(F.col(path).alias("x")).schema["x"].dataType
        if kind.typeName() == "string":
            return F.when(F.col(path).contains(keyword), F.col(path))
        items = F.col(path)
        if kind.elementType.typeName() == "struct":
            items = F.flatten(F.transform(items, lambda s: F.array(*[s[n] for n in kind.elementType.names])))
        found = F.filter(items, lambda x: x.contains(keyword))
        return F.when(F.size(found) > 0, F.array_join(found, ", "))

    hits = F.filter(F.array(*[F.struct(F.lit(n).alias("field"), hit(p).alias("hit")) for n, p in fields.items()]), lambda h: h["hit"].isNotNull())
    rows = kb.select("chunk_id", "chapter_hint", "char_start", "char_end", F.inline(hits))
    return rows.withColumn("hit", F.when(F.length("hit") > HIT_CHARS, F.concat(F.substring("hit", 1, HIT_CHARS), F.lit("..."))).otherwise(F.col("hit")))


def evidence(rows: DataFrame, chunks: DataFrame, column: str = "chunk_id") -> DataFrame:
    """rows with evidence: the chunk id, tagged with its section type unless that is a story scene."""
    types = chunks.select(F.col("chunk_id").alias("_id"), "section_type")
    tagged = F.col("section_type").isNotNull() & ~F.col("section_type").isin("", "story_scene")
    shown = F.when(F.coalesce(strip(F.col(column)), F.lit("")) == "", NONE).when(tagged, F.concat(F.col(column), F.lit(" ["), "section_type", F.lit("]"))).otherwise(F.col(column))
    return rows.join(types, strip(F.col(column)) == F.col("_id"), "left").withColumn("evidence", shown).drop("_id", "section_type")


def normalized_ids(ids: Column) -> Column:
    return distinct_in_order(ids)


def person_card(results: DataFrame) -> DataFrame:
    """(query, card): a result to be read by people."""
    item = lambda c, f: F.array_join(F.transform(c, f), "\n")
    ranked = lambda title, c: F.concat(F.lit(f"{title}:\n"), F.when(F.size(c) > 0, item(F.slice(c, 1, 5), lambda x: F.concat(F.lit("  - "), x))).otherwise(f"  {NONE}"))
    line = lambda name, c: F.concat(F.lit(f"{name}: "), F.coalesce(c.cast("string"), F.lit(NONE)))
    found = F.concat_ws(
        "\n", line("查询词", F.col("query")), line("canonical", F.col("canonical_name")), line("match_type", F.col("match_type")),
        F.concat(F.lit("observed aliases: "), joined_or(F.col("aliases"), "、", NONE)), F.when(F.col("match_type") == "query_alias", line("query_alias_input", F.col("query"))),
        line("mention_count", F.col("mention_count")), line("first_chunk", F.col("first_chunk")), line("last_chunk", F.col("last_chunk")),
        ranked("actions", F.col("top_actions")), ranked("emotions", F.col("top_emotions")),
        ranked("relations", F.transform("relationship_candidates", lambda r: F.concat(r["related_person"], F.lit(" | "), r["overlap_chunk_count"].cast("string")))),
        ranked("places", F.transform("location_candidates", lambda r: F.concat(r["location"], F.lit(" | "), r["overlap_chunk_count"].cast("string")))),
    )
    return results.select("query", F.when(F.col("matched"), found).otherwise(F.concat(line("查询词", F.col("query")), F.lit(f"\n{NO_MATCH_NOTE}"))).alias("card"))
