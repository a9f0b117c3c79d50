"""Inverted indexes of extracted records: who, where, what and with whom, by chunk.

The primary product is a long table (entity, chunk, n): it is made by one aggregation with map-side
combining, so an entity in half of all chunks is no hot group. Whole arrays are made from it for export.
Order is always that of (chunk, place in the chunk), never that of arrival.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loretable.functions.text import strip

#: Items of a profile's array; longer lists are read from the long tables.
ARRAY_ITEMS = 1000
KINDS = {
    "characters": (("name",), ("action", "emotion")),
    "locations": (("location",), ()),
    "events": (("event",), ("cause", "result")),
    "relationships": (("person_a", "person_b"), ("interaction",)),
}


def mentions(records: DataFrame, kind: str) -> DataFrame:
    """(chunk_id, pos, key columns, value columns): one row per entry with a key that is not blank.

    Pairs of persons are ordered; a pair of one person with itself is kept.
    """
    keys, values = KINDS[kind]
    rows = records.select("chunk_id", F.posexplode(kind).alias("pos", "e"))
    if kind == "locations":
        return rows.select("chunk_id", "pos", strip("e").alias("location")).where("location <> ''")
    field = lambda f: F.coalesce(strip(F.col(f"e.{f}")), F.lit(""))
    rows = rows.select("chunk_id", "pos", *[field(f).alias(f) for f in keys + values]).where(" and ".join(f"{k} <> ''" for k in keys))
    if kind == "relationships":
        rows = rows.withColumns({"person_a": F.least("person_a", "person_b"), "person_b": F.greatest("person_a", "person_b")})
    return rows


def postings(entries: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, chunk_id, n, first_pos): how often each entity stands in each chunk."""
    return entries.groupBy(*keys, "chunk_id").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))


def counts(posts: DataFrame, keys: tuple[str, ...], preview: int = 5) -> DataFrame:
    """(keys, count, chunk_count, first_chunk, last_chunk): bounded state per entity."""
    return posts.groupBy(*keys).agg(F.sum("n").alias("count"), F.count("*").alias("chunk_count"), F.min("chunk_id").alias("first_chunk"), F.max("chunk_id").alias("last_chunk"), F.min(F.struct("chunk_id", "first_pos")).alias("first_at"))


def values_in_order(entries: DataFrame, keys: tuple[str, ...], value: str) -> DataFrame:
    """(keys, value, n, first_at): distinct values that are not blank."""
    return entries.where(F.col(value) != "").groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(F.struct("chunk_id", "pos")).alias("first_at"))


def index(records: DataFrame, kind: str, most: int | None = None, of: tuple[str, ...] | None = None) -> DataFrame:
    """An entity's count, number of chunks, first and last chunk, and its chunks and distinct values as arrays
    in the order of first sight, for export.

    One pass over the records: entries are spread into (entity, list, value), counted with their first
    place by one aggregation. Arrays are whole: values are dealt by ranges of (entity, list, place), each range
    sorts its own, and an entity's row only puts its ranges' values together, so a list that holds most of
    the table is sorted by many tasks. most: arrays hold the first so many items each, for a preview (ranks
    are limited before they are shuffled), and complete says whether all are there. The long tables of the
    same are postings and values_in_order. of: the values whose arrays are wanted (none named: all).
    """
    keys, values = KINDS[kind][0], KINDS[kind][1] if of is None else of
    lists = ("chunk", *values)
    item = lambda name, c: F.struct(F.lit(name).alias("list"), F.col(c).alias("value"))
    spread = mentions(records, kind).select(*keys, "chunk_id", "pos", F.inline(F.array(item("chunk", "chunk_id"), *[item(v, v) for v in values]))).where("value <> ''")
    counted = spread.groupBy(*keys, "list", "value").agg(F.count("*").alias("n"), F.min(F.struct("chunk_id", "pos")).alias("first_at"))
    only = lambda name, c: F.when(F.col("list") == name, c)
    per = counted.groupBy(*keys).agg(
        F.sum(only("chunk", F.col("n"))).alias("count"), F.count(only("chunk", F.col("n"))).alias("chunk_count"), F.min(only("chunk", F.col("value"))).alias("first_chunk"), F.max(only("chunk", F.col("value"))).alias("last_chunk"),
        F.min(only("chunk", F.col("first_at"))).alias("first_at"), *[F.count(only(v, F.col("n"))).alias(f"{v}_count") for v in values],
    )
    if most is None:
        ranged = counted.repartitionByRange(*keys, "list", "first_at", "value").withColumn("range", F.spark_partition_id())
        sorted_ = F.transform(F.array_sort(F.collect_list(F.struct("first_at", "value"))), lambda x: x["value"])
        parts = ranged.groupBy(*keys, "list", "range").agg(sorted_.alias("part"))
        arrays = [F.flatten(F.transform(F.array_sort(F.collect_list(only(v, F.struct("range", "part")))), lambda x: x["part"])).alias(f"{v}s") for v in lists]
        return per.join(parts.groupBy(*keys).agg(*arrays), [*keys]).drop(*[f"{v}_count" for v in values])
    place = F.row_number().over(Window.partitionBy(*keys, "list").orderBy("first_at", "value"))
    first = counted.withColumn("place", place).where(F.col("place") <= most)
    arrays = [F.transform(F.array_sort(F.collect_list(only(v, F.struct("place", "value")))), lambda x: x["value"]).alias(f"{v}s") for v in lists]
    whole = reduce(and_, [F.col(f"{v}_count") <= most for v in lists])
    return per.join(first.groupBy(*keys).agg(*arrays), [*keys]).withColumn("complete", whole).drop(*[f"{v}_count" for v in values])


def ranked(indexed: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """By falling count, ties by first sight, for display."""
    return indexed.orderBy(F.desc("count"), "first_at", *keys)


def style_histogram(styles: DataFrame) -> DataFrame:
    """(dimension, value, count): tags (repeats count), tones, densities and the number of records, in one pass."""
    item = lambda d, v: F.struct(F.lit(d).alias("dimension"), v.alias("value"))
    one = F.array(item("narration_tone", strip(F.coalesce("narration_tone", F.lit("")))), item("dialogue_density", strip(F.coalesce("dialogue_density", F.lit("")))), item("total", F.lit("records")))
    tags = F.transform(F.coalesce("style_tags", F.array().cast("array<string>")), lambda t: item("style_tag", strip(t)))
    return styles.select(F.inline(F.concat(one, tags))).where("value <> ''").groupBy("dimension", "value").agg(F.count("*").alias("count"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
