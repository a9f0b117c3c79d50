"""Adapters: the driver's tables in the shapes of records, chunks, logs and reviews, and the same as SQL."""

from __future__ import annotations

from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loretable.functions.tables import staged

_held: ContextVar[dict | None] = ContextVar("held", default=None)


@contextmanager
def one_query():
    """Within one query the records are made once, however often it asks for them; nothing is held beyond it."""
    token = _held.set({})
    try:
        yield
    finally:
        _held.reset(token)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_chunk(key) -> F.Column:
    return F.concat(F.lit("o"), F.lpad(F.col(key).cast("string") if isinstance(key, str) else key.cast("string"), 9, "0"))


def canon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order is a chunk; its lines are characters, events, places, times and relations, in line order."""
    held = _held.get()
    if held is None:
        return _canon(spark, sf_dir)
    if sf_dir not in held:
        held[sf_dir] = _canon(spark, sf_dir)
    return held[sf_dir]


def _canon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each join and the grouping is a step of its own, so that lines lie on disk shuffled once at a time, not three times."""
    t = lambda n: table(spark, sf_dir, n)
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    name = F.when(F.col("l_linenumber") % 2 == 1, F.element_at(F.split("p_name", " "), 2)).otherwise(F.col("p_name"))
    emotion = F.concat("l_returnflag", F.lit("、"), "l_linestatus")
    item = F.struct(*order, name.alias("name"), "p_type", emotion.alias("emotion"), "n_name", F.year("l_shipdate").cast("string").alias("y"), "s_name", "p_brand")
    lines = t("lineitem").select("l_orderkey", *order).join(t("part").select("p_partkey", "p_name", "p_type", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")
    lines, with_parts = staged(lines, "parts")
    suppliers = t("supplier").select("s_suppkey", "s_name", "s_nationkey").join(t("nation").select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
    lines, with_suppliers = staged(lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).drop("s_suppkey", "s_nationkey", "n_nationkey"), "suppliers", with_parts)
    per = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("x"))
    heads = t("orders").join(t("customer").select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_orderpriority", "o_orderstatus", "c_name")
    heads, with_heads = staged(heads, "heads")
    rows = per.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
    each = lambda f: F.transform("x", f)
    records = rows.select(
        order_chunk("o_orderkey").alias("chunk_id"), F.col("o_orderpriority").alias("source_file"), F.col("o_orderstatus").alias("chapter_hint"),
        (F.col("o_orderkey") * 1000).alias("char_start"), (F.col("o_orderkey") * 1000 + F.size("x")).alias("char_end"), F.concat_ws(" ", "o_orderstatus", "o_orderpriority").alias("summary"),
        each(lambda e: F.struct(e["name"].alias("name"), e["p_type"].alias("action"), e["emotion"].alias("emotion"))).alias("characters"),
        each(lambda e: F.struct(e["p_type"].alias("event"), F.col("o_orderpriority").alias("cause"), e["l_returnflag"].alias("result"))).alias("events"),
        each(lambda e: e["n_name"]).alias("locations"), each(lambda e: e["y"]).alias("time_markers"),
        each(lambda e: F.struct(e["s_name"].alias("person_a"), F.col("c_name").alias("person_b"), e["p_brand"].alias("interaction"))).alias("relationships"),
    )
    return staged(records, "records", with_suppliers, with_heads)[0]


#: SQL of the same, one row per line: chunk_id, pos and the fields of all lists.
FACTS = """facts AS (
  SELECT 'o' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS chunk_id,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) - 1 AS pos,
         CASE WHEN l_linenumber % 2 = 1 THEN split_part(p_name, ' ', 2) ELSE p_name END AS name,
         p_type AS action, l_returnflag || '、' || l_linestatus AS emotion, n_name AS location, CAST(year(l_shipdate) AS VARCHAR) AS marker,
         p_type AS event, o_orderpriority AS cause, l_returnflag AS result, least(s_name, c_name) AS person_a, greatest(s_name, c_name) AS person_b,
         s_name, c_name, p_brand AS interaction, o_orderpriority AS source_file, o_orderstatus AS chapter_hint, o_orderkey * 1000 AS char_start
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""


def styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document is a style record; every sixteenth order number is its chunk."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    rows = table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    chunk = order_chunk(F.col("doc_id") * 16)
    density = F.when(F.col("quality") == 1, "高").when(F.col("quality") == 0, "低").otherwise("中")
    tags = F.array(F.when(F.col("toxic") == 1, "热血").when(F.col("toxic") == 0, "温情").otherwise("日常感"), F.when(F.col("n_chars") > 2000, "慢节奏").otherwise("快节奏"))
    line = F.struct(F.col("source").alias("speaker"), F.substring("text", 1, 40).alias("line"), chunk.alias("chunk_id"))
    return rows.select(chunk.alias("chunk_id"), F.col("source").alias("source_file"), F.col("lang").alias("narration_tone"), density.alias("dialogue_density"), F.array("source").alias("prose_features"), F.array(line).alias("key_dialogues"), tags.alias("style_tags"))


STYLES = """styles AS (
  SELECT 'o' || lpad(CAST(d.doc_id * 16 AS VARCHAR), 9, '0') AS chunk_id, source AS source_file, lang AS tone,
         CASE WHEN quality = 1 THEN '高' WHEN quality = 0 THEN '低' ELSE '中' END AS density,
         CASE WHEN toxic = 1 THEN '热血' WHEN toxic = 0 THEN '温情' ELSE '日常感' END AS tag1, CASE WHEN n_chars > 2000 THEN '慢节奏' ELSE '快节奏' END AS tag2
  FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id)"""


def doc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document is a chunk."""
    return table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("chunk_id"), F.col("source").alias("source_name"), "lang", "text", "doc_id")


DOCS = "docs AS (SELECT 'd' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS chunk_id, source AS source_name, lang, text, doc_id FROM documents)"


def raw_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("source_name"), F.concat("source", F.lit(".txt")).alias("source_file"), F.lit("utf-8-sig").alias("encoding"), "text")


def state_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events are log rows of documents' chunks; their type is the status."""
    status = F.when(F.col("event_type") == "purchase", "success").when(F.col("event_type") == "signup", "structural_chunk").otherwise("failed")
    return table(spark, sf_dir, "events").select(F.concat(F.lit("d"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("chunk_id"), status.alias("status"), "ts")


LOG = "log AS (SELECT 'd' || lpad(CAST(event_id AS VARCHAR), 9, '0') AS chunk_id, CASE WHEN event_type = 'purchase' THEN 'success' WHEN event_type = 'signup' THEN 'structural_chunk' ELSE 'failed' END AS status FROM events)"


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events are answers for a user's chunk, in order of their ids: fenced, cut, or with wrong keys, by type."""
    from pyspark.sql import Window

    good = F.concat(F.lit('{"chunk_id": "x", "summary": "'), F.col("event_type"), F.lit('", "characters": [{"name": "n'), F.col("user_id").cast("string"), F.lit('", "action": "a", "emotion": ""},], "events": [], "locations": ["'), F.col("event_type"), F.lit('"], "time_markers": [], "relationships": []}'))
    raw = F.when(F.col("event_type") == "click", F.concat(F.lit("```json\n"), good, F.lit("\n```"))).when(F.col("event_type") == "view", F.substring(good, 1, 40)).when(F.col("event_type") == "purchase", F.concat(F.lit("Here: "), good, F.lit(" done"))).otherwise(F.replace(good, F.lit('"summary"'), F.lit('"summmary"')))
    attempt = F.row_number().over(Window.partitionBy("user_id", F.floor(F.col("event_id") / 50)).orderBy("event_id"))
    chunk = F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("_"), F.floor(F.col("event_id") / 50).cast("string"))
    return table(spark, sf_dir, "events").select(chunk.alias("chunk_id"), attempt.cast("int").alias("attempt"), raw.alias("raw"))


#: Valid: clicks and purchases; cut: views; the others have a wrong key.
ANSWERS = """answers AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) || '_' || CAST(event_id // 50 AS VARCHAR) AS chunk_id, row_number() OVER (PARTITION BY user_id, event_id // 50 ORDER BY event_id) AS attempt,
         event_type IN ('click', 'purchase') AS valid, event_type = 'view' AS cut, event_type AS kind, user_id FROM events)"""
