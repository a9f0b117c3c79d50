"""Graph-ready triples, timelines, and risk levels of chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loretable.functions.tables import kept
from loretable.functions.text import strip
from loretable.operators.characters import in_chunks
from loretable.operators.ranks import TASK_ROWS, placed

def triples(facts: DataFrame, places: DataFrame, relations: DataFrame, evidence: int = 5, salts: int = 16) -> DataFrame:
    """(subject, predicate, object, n, first_chunk, evidence): persons in chunks, at places, with persons.

    A person's rows in a chunk are a triple at once. The others are counted by chunk, then by parts of the
    chunks (so that no triple with very many chunks is one task's work), each part with its first chunks,
    and the parts' few rows are put together.
    """
    e = lambda c: F.array_sort(F.collect_list(c))
    spo = ["subject", "predicate", "object"]
    named = in_chunks(facts)
    in_chunk = named.select(F.col("canonical_name").alias("subject"), F.lit("appears_in").alias("predicate"), F.col("chunk_id").alias("object"), "n", F.col("chunk_id").alias("first_chunk"), F.array("chunk_id").alias("evidence"))
    at = named.select("canonical_name", "chunk_id").join(places.select("location", "chunk_id").repartition("chunk_id").distinct(), "chunk_id")
    at_place = at.select(F.col("canonical_name").alias("subject"), F.lit("appears_at").alias("predicate"), F.col("location").alias("object"), "chunk_id", F.lit(1).cast("long").alias("n"))
    met = relations.groupBy(F.col("person_a").alias("subject"), F.lit("interacts_with").alias("predicate"), F.col("person_b").alias("object"), "chunk_id").agg(F.count("*").alias("n"))
    rows = at_place.unionByName(met).withColumn("part", F.pmod(F.xxhash64("chunk_id"), F.lit(salts)))
    place = F.row_number().over(Window.partitionBy(*spo, "part").orderBy("chunk_id"))
    parts = rows.withColumn("place", place).groupBy(*spo, "part").agg(F.sum("n").alias("n"), e(F.when(F.col("place") <= evidence, F.col("chunk_id"))).alias("evidence"))
    whole = parts.groupBy(*spo).agg(F.sum("n").alias("n"), F.slice(F.array_sort(F.flatten(F.collect_list("evidence"))), 1, evidence).alias("evidence"))
    return in_chunk.unionByName(whole.select(*spo, "n", F.col("evidence")[0].alias("first_chunk"), "evidence"))


def write_triples(rows: DataFrame, path: str) -> None:
    rows.withColumn("evidence", F.array_join("evidence", " ")).write.option("header", True).csv(path)


def markdown_rows(rows: DataFrame) -> DataFrame:
    """One column line: triples as rows of a markdown table."""
    cell = lambda c: F.replace(F.col(c).cast("string"), F.lit("|"), F.lit("\\|"))
    return rows.select(F.concat(F.lit("| "), F.concat_ws(" | ", *[cell(c) for c in ("subject", "predicate", "object", "n", "first_chunk")]), F.lit(" |")).alias("line"))


def timeline(records: DataFrame, source: str = "source_file", task_rows: int = TASK_ROWS) -> DataFrame:
    """(source, place, chunk_id, kind, text): time markers and events in chunk order per source."""
    item = lambda k, c: F.struct(F.lit(k).alias("kind"), strip(c).alias("text"))
    none = F.array().cast("array<struct<kind:string,text:string>>")
    both = F.concat(F.coalesce(F.transform("time_markers", lambda t: item("time", t)), none), F.coalesce(F.transform("events", lambda e: item("event", e["event"])), none))
    rows = records.select(F.coalesce(F.col(source), F.lit("")).alias("source"), "chunk_id", F.posexplode(both).alias("pos", "x")).select("source", "chunk_id", "pos", "x.kind", "x.text").where("text <> ''")
    return placed(rows, ["source"], ["chunk_id", "pos"], task_rows=task_rows).select("source", F.col("place").cast("int").alias("place"), "chunk_id", "kind", "text")


# Thresholds of our own: a chunk scores a point for each sign.
SIGNS = {"middle": (0.3, 0.7), "time_markers": 3, "characters": 6, "events": 4, "known_relations": 3}


def risk_levels(records: DataFrame, source: str = "source_file", signs: dict = SIGNS, levels: tuple[int, int] = (2, 4), task_rows: int = TASK_ROWS) -> DataFrame:
    """(chunk_id, source, points, level): L1 to L3 by place in the source, density of times, persons and
    events, and reuse of relations known from earlier chunks of the source."""
    n = lambda c: F.coalesce(F.size(c), F.lit(0))
    known = F.transform("relationships", lambda r: F.struct(F.least(r["person_a"], r["person_b"]).alias("a"), F.greatest(r["person_a"], r["person_b"]).alias("b")))
    base = kept(records.select("chunk_id", F.coalesce(F.col(source), F.lit("")).alias("source"), n("time_markers").alias("times"), n("characters").alias("persons"), n("events").alias("events_n"), F.array_distinct(known).alias("pairs")))
    pairs = base.select("source", "chunk_id", F.inline("pairs")).distinct()
    first = pairs.groupBy("source", "a", "b").agg(F.min("chunk_id").alias("first"))
    reused = pairs.join(first, ["source", "a", "b"]).where("chunk_id > first").groupBy("chunk_id").agg(F.count("*").alias("reused"))
    share = F.when(F.col("total") > 1, (F.col("place") - 1) / (F.col("total") - 1)).otherwise(0.0)
    rows = placed(base.drop("pairs"), ["source"], ["chunk_id"], total="total", task_rows=task_rows).withColumn("share", share).join(reused, "chunk_id", "left")
    point = lambda c: F.when(c, 1).otherwise(0)
    points = point(F.col("share").between(*signs["middle"])) + point(F.col("times") >= signs["time_markers"]) + point(F.col("persons") >= signs["characters"]) + point(F.col("events_n") >= signs["events"]) + point(F.col("reused") >= signs["known_relations"])
    level = F.when(F.col("points") >= levels[1], "L3").when(F.col("points") >= levels[0], "L2").otherwise("L1")
    return rows.withColumn("points", points).select("chunk_id", "source", "points", level.alias("level"))
