"""Registered queries of the knowledge-base operators over the driver's tables, and their SQL."""

from __future__ import annotations

from functools import wraps
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loretable.functions.tables import scratch
from loretable.operators import aliases as al
from loretable.operators import audit, chunking, context, gates, graph, indexes, lookup, merge, recall, responses, search_index, sections, versions
from loretable.operators import characters as ch
from loretable.plans import testtables as tt
from loretable.schemas import CANON
from loretable.sources import io

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with tt.one_query():
                return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql.strip()
        return run

    return register


def _entries(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return indexes.mentions(tt.canon(spark, sf_dir), kind)


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with their counts: of facts, of parts with their brands, and (rarer) first words of small parts' names."""
    posts = indexes.postings(_entries(spark, sf_dir, "characters"), ("name",))
    counts = posts.groupBy("name").agg(F.sum("n").alias("n"))
    brand = tt.table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_name", "p_brand").alias("name"), F.lit(1).alias("n")).groupBy("name").agg(F.sum("n").alias("n"))
    word = tt.table(spark, sf_dir, "part").where("p_size <= 5").groupBy(F.split("p_name", " ")[0].alias("name")).agg(F.count("*").alias("n"))
    return counts.unionByName(brand).unionByName(word).select("name", F.col("n").alias("count"))


NAMES = """names AS (
  SELECT name, count(*) AS cnt FROM facts GROUP BY name UNION ALL SELECT p_name || ' ' || p_brand, count(*) FROM part GROUP BY p_name || ' ' || p_brand
  UNION ALL SELECT split_part(p_name, ' ', 1), count(*) FROM part WHERE p_size <= 5 GROUP BY split_part(p_name, ' ', 1))"""
PAIRS = f"""{NAMES}, pairs AS (
  SELECT a.name AS alias, c.name AS canonical_candidate, a.cnt AS alias_count, c.cnt AS canonical_count, a.cnt / c.cnt AS ratio
  FROM names a JOIN names c ON contains(c.name, a.name) AND a.name <> c.name WHERE length(a.name) >= 2 AND c.cnt > 0)"""
RULES = f"""{PAIRS}, failed AS (
  SELECT *, (CASE WHEN length(canonical_candidate) < 3 THEN 1 ELSE 0 END) + (CASE WHEN canonical_count < 10 THEN 1 ELSE 0 END) + (CASE WHEN ratio >= 0.4 THEN 1 ELSE 0 END) AS fails FROM pairs
), ruled AS (
  SELECT *, CASE WHEN ratio >= 0.5 THEN 'freq_close_skip' WHEN fails = 0 THEN 'substring_auto' WHEN fails = 1 AND canonical_count >= 5 THEN 'substring_review' ELSE 'substring_weak' END AS rule FROM failed)"""
SHOWN = "printf('%.2f', round_even(CAST(ratio AS DECIMAL(38, 18)), 2))"
FAILS = f"""array_to_string(list_filter([CASE WHEN length(canonical_candidate) < 3 THEN 'canonical太短(' || CAST(length(canonical_candidate) AS VARCHAR) || '字)' END,
  CASE WHEN canonical_count < 10 THEN 'canonical低频(' || CAST(canonical_count AS VARCHAR) || '次)' END, CASE WHEN ratio >= 0.4 THEN '频率差不足(ratio=' || {SHOWN} || ')' END], lambda x: x IS NOT NULL), '; ')"""
REASON = f"""CASE rule WHEN 'freq_close_skip' THEN '频率接近（ratio=' || {SHOWN} || '），可能是独立角色' WHEN 'substring_auto' THEN '子串简称，频率差显著(ratio=' || {SHOWN} || ')，canonical出现' || CAST(canonical_count AS VARCHAR) || '次'
  WHEN 'substring_review' THEN '需人工确认：' || {FAILS} ELSE '弱候选，不建议合并：' || {FAILS} END"""


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.classified(al.containment(_names(spark, sf_dir)))


def _confirmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last words of part names stand for the least name that ends with them."""
    parts = tt.table(spark, sf_dir, "part").select(F.element_at(F.split("p_name", " "), 2).alias("alias"), F.col("p_name").alias("canonical"))
    return parts.groupBy("alias").agg(F.min("canonical").alias("canonical"))


def _auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = tt.table(spark, sf_dir, "part").select(F.element_at(F.split("p_name", " "), 2).alias("alias"), F.col("p_name").alias("canonical"))
    return parts.groupBy("alias").agg(F.max("canonical").alias("canonical"))


def _blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirmed pairs whose last word has an e are blocked."""
    return al.unordered(_confirmed(spark, sf_dir).where("contains(alias, 'e')").select(F.col("alias").alias("a"), F.col("canonical").alias("b")))


def _aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.fact_aliases(_confirmed(spark, sf_dir), _auto(spark, sf_dir), _blocked(spark, sf_dir))


LAYERS = """ends AS (SELECT split_part(p_name, ' ', 2) AS alias, min(p_name) AS least, max(p_name) AS most FROM part GROUP BY split_part(p_name, ' ', 2)
), layers AS (SELECT alias, CASE WHEN contains(alias, 'e') THEN most ELSE least END AS canonical, CASE WHEN contains(alias, 'e') THEN 'auto' ELSE 'confirmed' END AS alias_source FROM ends
  WHERE NOT (contains(alias, 'e') AND most = least))"""
APPEAR = f"""{LAYERS}, appear AS (
  SELECT coalesce(canonical, name) AS canonical_name, name AS raw_name, chunk_id, pos, chapter_hint, char_start, action, emotion, coalesce(alias_source, 'identity') AS alias_source
  FROM facts LEFT JOIN layers ON name = alias)"""


def _appearances(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tt.canon(spark, sf_dir)
    kb = c.select("chunk_id", "source_file", "chapter_hint", "char_start", "char_end", F.struct("characters").alias("canon"))
    return ch.appearances(kb, _aliases(spark, sf_dir))


def _kb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.master(tt.canon(spark, sf_dir), tt.styles(spark, sf_dir))


# ---- indexes


@query(f"WITH {tt.FACTS} SELECT name, chunk_id, count(*) AS n, min(pos) AS first_pos FROM facts GROUP BY name, chunk_id")
def m2_character_postings(spark, sf_dir):
    return indexes.postings(_entries(spark, sf_dir, "characters"), ("name",))


def _array_sql(key: str, value: str, name: str, most: int | None = None) -> str:
    """The values of each key in the order of first sight, or the first ones and how many there are."""
    if most is None:
        return f"SELECT {key}, string_agg(v, '|' ORDER BY c, p) AS {name} FROM (SELECT {key}, {value} AS v, min(chunk_id) AS c, arg_min(pos, chunk_id || lpad(CAST(pos AS VARCHAR), 9, '0')) AS p FROM facts WHERE {value} <> '' GROUP BY {key}, {value}) x GROUP BY {key}"
    return f"""SELECT {key}, string_agg(v, '|' ORDER BY place) FILTER (place <= {most}) AS {name}, count(*) AS {name}_n FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY c, p, v) AS place FROM (
  SELECT {key}, {value} AS v, min(chunk_id) AS c, arg_min(pos, chunk_id || lpad(CAST(pos AS VARCHAR), 9, '0')) AS p FROM facts WHERE {value} <> '' GROUP BY {key}, {value}) x) y GROUP BY {key}"""


@query(f"""
WITH {tt.FACTS}, base AS (SELECT name, count(*) AS count, count(DISTINCT chunk_id) AS chunk_count, min(chunk_id) AS first_chunk, max(chunk_id) AS last_chunk FROM facts GROUP BY name)
SELECT base.name, count, chunk_count, first_chunk, last_chunk, actions, emotions
FROM base JOIN ({_array_sql('name', 'action', 'actions')}) a ON base.name = a.name JOIN ({_array_sql('name', 'emotion', 'emotions')}) e ON base.name = e.name""")
def m2_character_index(spark, sf_dir):
    i = indexes.index(tt.canon(spark, sf_dir), "characters")
    return i.select("name", "count", "chunk_count", "first_chunk", "last_chunk", F.array_join("actions", "|").alias("actions"), F.array_join("emotions", "|").alias("emotions"))


@query(f"WITH {tt.FACTS} SELECT location, count(*) AS count, count(DISTINCT chunk_id) AS chunk_count, min(chunk_id) AS first_chunk, max(chunk_id) AS last_chunk FROM facts GROUP BY location")
def m3_location_index(spark, sf_dir):
    return indexes.counts(indexes.postings(_entries(spark, sf_dir, "locations"), ("location",)), ("location",)).drop("first_at")


@query(f"""
WITH {tt.FACTS}, base AS (SELECT event, count(*) AS count, count(DISTINCT chunk_id) AS chunk_count FROM facts GROUP BY event)
SELECT base.event, count, chunk_count, causes, results FROM base JOIN ({_array_sql('event', 'cause', 'causes')}) a ON base.event = a.event JOIN ({_array_sql('event', 'result', 'results')}) e ON base.event = e.event""")
def m4_event_index(spark, sf_dir):
    i = indexes.index(tt.canon(spark, sf_dir), "events")
    return i.select("event", "count", "chunk_count", F.array_join("causes", "|").alias("causes"), F.array_join("results", "|").alias("results"))


@query(f"WITH {tt.FACTS} SELECT person_a, person_b, count(*) AS count, string_agg(DISTINCT chunk_id, '|' ORDER BY chunk_id) AS chunks FROM facts GROUP BY person_a, person_b")
def m5_relationship_index(spark, sf_dir):
    return indexes.index(tt.canon(spark, sf_dir), "relationships", of=()).select("person_a", "person_b", "count", F.array_join("chunks", "|").alias("chunks"))


@query(f"WITH {tt.FACTS} SELECT event, 'cause' AS list, cause AS value, count(*) AS n FROM facts WHERE cause <> '' GROUP BY event, cause UNION ALL SELECT event, 'result', result, count(*) FROM facts WHERE result <> '' GROUP BY event, result")
def m4_event_values(spark, sf_dir):
    """All values of events, however many: the long table that the arrays are cut from."""
    entries = _entries(spark, sf_dir, "events")
    long = lambda v: indexes.values_in_order(entries, ("event",), v).select("event", F.lit(v).alias("list"), F.col(v).alias("value"), "n")
    return long("cause").unionByName(long("result"))


@query(f"WITH {tt.FACTS} SELECT person_a, person_b, chunk_id, count(*) AS n, min(pos) AS first_pos FROM facts GROUP BY person_a, person_b, chunk_id")
def m5_relationship_postings(spark, sf_dir):
    """All chunks of pairs, however many."""
    return indexes.postings(_entries(spark, sf_dir, "relationships"), ("person_a", "person_b"))


@query(f"""
WITH {tt.STYLES}, items AS (SELECT 'narration_tone' AS dimension, tone AS value FROM styles UNION ALL SELECT 'dialogue_density', density FROM styles
  UNION ALL SELECT 'style_tag', tag1 FROM styles UNION ALL SELECT 'style_tag', tag2 FROM styles UNION ALL SELECT 'total', 'records' FROM styles)
SELECT dimension, value, count(*) AS count FROM items WHERE value <> '' GROUP BY dimension, value""")
def m6_style_histogram(spark, sf_dir):
    return indexes.style_histogram(tt.styles(spark, sf_dir))


MERGED = f"""{tt.FACTS}, canon AS (SELECT chunk_id, max(source_file) AS source_file, max(chapter_hint) AS chapter_hint, max(char_start) AS char_start, max(char_start) + count(*) AS char_end, count(*) AS n FROM facts GROUP BY chunk_id),
{tt.STYLES}"""


@query(f"""
WITH {MERGED} SELECT coalesce(c.chunk_id, s.chunk_id) AS chunk_id, coalesce(CASE WHEN c.chunk_id IS NOT NULL THEN c.source_file ELSE s.source_file END, '') AS source_file, coalesce(c.chapter_hint, '') AS chapter_hint,
  c.char_start, c.char_end, c.n AS characters, s.tone, s.tag1 || '/' || s.tag2 AS tags FROM canon c FULL OUTER JOIN styles s ON c.chunk_id = s.chunk_id""")
def m1_master_merge(spark, sf_dir):
    kb = _kb(spark, sf_dir)
    return kb.select("chunk_id", "source_file", "chapter_hint", "char_start", "char_end", F.when(F.col("canon").isNotNull(), F.size("canon.characters")).cast("bigint").alias("characters"), F.col("style.narration_tone").alias("tone"), F.when(F.col("style").isNotNull(), F.array_join("style.style_tags", "/")).alias("tags"))


@query(f"WITH {MERGED} SELECT count(*) AS total_chunks, count(c.chunk_id) AS canon_chunks, count(s.chunk_id) AS style_chunks FROM canon c FULL OUTER JOIN styles s ON c.chunk_id = s.chunk_id")
def m7_kb_header(spark, sf_dir):
    return merge.header(_kb(spark, sf_dir))


@query(f"""
WITH {MERGED}, listed AS (SELECT chunk_id,
    chr(10) || '**人物行为**：' || chr(10) || string_agg('- ' || name || '：' || action || '（' || emotion || '）', chr(10) ORDER BY pos) || chr(10) || '**关系互动**：' || chr(10)
    || string_agg('- ' || s_name || ' × ' || c_name || '：' || interaction, chr(10) ORDER BY pos) || chr(10) || '**地点**：' || string_agg(location, ', ' ORDER BY pos) || chr(10) || '**时间**：' || string_agg(marker, ', ' ORDER BY pos) AS body FROM facts GROUP BY chunk_id)
SELECT coalesce(c.chunk_id, s.chunk_id) AS chunk_id,
  '## [' || coalesce(c.chunk_id, s.chunk_id) || '] ' || coalesce(c.chapter_hint, '') || chr(10) || '**位置**：字符 ' || coalesce(CAST(c.char_start AS VARCHAR), '') || '–' || coalesce(CAST(c.char_end AS VARCHAR), '')
  || CASE WHEN c.chunk_id IS NOT NULL THEN chr(10) || '**摘要**：' || c.chapter_hint || ' ' || c.source_file || l.body ELSE '' END
  || CASE WHEN s.chunk_id IS NOT NULL THEN chr(10) || '**风格**：语气：' || s.tone || ' | 对话密度：' || s.density || ' | 标签：' || s.tag1 || ' / ' || s.tag2 ELSE '' END || chr(10) AS markdown
FROM canon c FULL OUTER JOIN styles s ON c.chunk_id = s.chunk_id LEFT JOIN listed l ON l.chunk_id = c.chunk_id""")
def m8_chunk_markdown(spark, sf_dir):
    return merge.chunk_markdown(_kb(spark, sf_dir))


# ---- lists


def _page_sql(key: str) -> str:
    return f"""
WITH {tt.FACTS}, posts AS (SELECT {key} AS entity, chunk_id, count(*) AS n, min(pos) AS p FROM facts GROUP BY {key}, chunk_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY chunk_id) AS place FROM posts),
per AS (SELECT entity, CAST(sum(n) AS BIGINT) AS count, count(*) AS chunks, min(chunk_id || lpad(CAST(p AS VARCHAR), 9, '0')) AS seen_at, string_agg(CASE WHEN place <= 5 THEN chunk_id END, ', ' ORDER BY chunk_id) AS shown FROM ranked GROUP BY entity)
SELECT row_number() OVER (ORDER BY count DESC, seen_at) AS rank, entity, count, shown || CASE WHEN chunks > 5 THEN ' 等 ' || CAST(chunks AS VARCHAR) || ' 个' ELSE '' END AS chunk_preview FROM per ORDER BY count DESC, seen_at LIMIT 50"""


@query(_page_sql("name"))
def q6_list_characters(spark, sf_dir):
    return lookup.entity_page(indexes.postings(_entries(spark, sf_dir, "characters"), ("name",)), "name", 50)


@query(_page_sql("location"))
def q6_list_locations(spark, sf_dir):
    return lookup.entity_page(indexes.postings(_entries(spark, sf_dir, "locations"), ("location",)), "location", 50)


# ---- aliases


@query(f"WITH {tt.FACTS}, {PAIRS} SELECT alias, canonical_candidate, alias_count, canonical_count FROM pairs")
def a1_alias_pairs(spark, sf_dir):
    return al.containment(_names(spark, sf_dir))


@query(f"""WITH {tt.FACTS}, {RULES} SELECT alias, canonical_candidate, ratio, rule, CASE rule WHEN 'substring_auto' THEN 'high' WHEN 'substring_review' THEN 'medium' ELSE 'low' END AS confidence, rule = 'substring_auto' AS auto_accept, {REASON} AS reason FROM ruled""")
def a2_alias_classes(spark, sf_dir):
    return _candidates(spark, sf_dir).select("alias", "canonical_candidate", "ratio", "rule", "confidence", "auto_accept", "reason")


RANKED = "CASE rule WHEN 'substring_auto' THEN 0 WHEN 'substring_review' THEN 1 ELSE 2 END, canonical_count DESC, length(canonical_candidate) DESC, canonical_candidate, alias"


@query(f"WITH {tt.FACTS}, {RULES} SELECT alias, canonical_candidate, rule FROM ruled ORDER BY {RANKED} LIMIT 200")
def a3_alias_order(spark, sf_dir):
    """The head of the candidates in their order."""
    return al.ordered(_candidates(spark, sf_dir)).select("alias", "canonical_candidate", "rule").limit(200)


@query(f"""WITH {tt.FACTS}, {RULES} SELECT alias, canonical_candidate AS canonical FROM (SELECT *, row_number() OVER (PARTITION BY alias ORDER BY canonical_count DESC, length(canonical_candidate) DESC, canonical_candidate) AS r FROM ruled WHERE rule = 'substring_auto') x WHERE r = 1""")
def a4_alias_map(spark, sf_dir):
    return al.alias_map(_candidates(spark, sf_dir))


@query(f"WITH {LAYERS} SELECT alias, canonical, alias_source FROM layers")
def a6_fact_aliases(spark, sf_dir):
    return _aliases(spark, sf_dir)


@query("""WITH ends AS (SELECT split_part(p_name, ' ', 2) AS alias, min(p_name) AS least, max(p_name) AS most FROM part GROUP BY split_part(p_name, ' ', 2)),
nick AS (SELECT n_name AS alias, r_name AS canonical FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT alias, canonical, 'nickname' AS alias_source FROM nick UNION ALL
SELECT alias, CASE WHEN contains(alias, 'e') THEN most ELSE least END, CASE WHEN contains(alias, 'e') THEN 'auto' ELSE 'confirmed' END FROM ends WHERE NOT (contains(alias, 'e') AND most = least)""")
def a7_query_aliases(spark, sf_dir):
    nations = tt.table(spark, sf_dir, "nation").join(tt.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("alias"), F.col("r_name").alias("canonical"))
    return al.query_aliases(nations, _confirmed(spark, sf_dir), _auto(spark, sf_dir), _blocked(spark, sf_dir))


@query(f"""WITH {tt.FACTS}, {RULES} SELECT count(*) AS total, count(*) FILTER (rule = 'substring_auto') AS accepted, count(*) FILTER (rule = 'substring_review') AS review, count(*) FILTER (rule IN ('freq_close_skip', 'substring_weak')) AS low FROM ruled""")
def a8_review_totals(spark, sf_dir):
    return al.review_totals(_candidates(spark, sf_dir))


@query(f"""WITH {tt.FACTS}, {RULES}, cut AS (SELECT *, CASE rule WHEN 'substring_auto' THEN 1 WHEN 'substring_review' THEN 2 ELSE 3 END AS section FROM ruled)
SELECT section, row_number() OVER (PARTITION BY section ORDER BY canonical_count DESC, length(canonical_candidate) DESC, canonical_candidate, alias) AS place,
  '| ' || alias || ' | ' || canonical_candidate || ' | ' || CAST(alias_count AS VARCHAR) || ' | ' || CAST(canonical_count AS VARCHAR) || ' | ' || CASE WHEN section < 3 THEN {SHOWN} || ' | ' ELSE '' END || {REASON} || ' |' AS line FROM cut""")
def a8_review_rows(spark, sf_dir):
    return al.review_rows(_candidates(spark, sf_dir))


# ---- characters


@query(f"WITH {tt.FACTS}, {APPEAR} SELECT canonical_name, raw_name, chunk_id, pos, chapter_hint, char_start, action, emotion, alias_source FROM appear")
def p1_appearances(spark, sf_dir):
    return _appearances(spark, sf_dir).drop("char_end")


@query(f"WITH {tt.FACTS}, {APPEAR} SELECT alias_source, count(*) AS count FROM appear GROUP BY alias_source")
def p2_alias_sources(spark, sf_dir):
    return ch.source_counts(_appearances(spark, sf_dir))


TOP_ACTIONS = "SELECT canonical_name, value, n, rank FROM (SELECT canonical_name, value, n, row_number() OVER (PARTITION BY canonical_name ORDER BY n DESC, seen_at) AS rank FROM (SELECT canonical_name, {v} AS value, count(*) AS n, min(chunk_id || lpad(CAST(pos AS VARCHAR), 9, '0'){part}) AS seen_at FROM {src} GROUP BY canonical_name, {v}) x) y WHERE rank <= 20"


@query(f"""
WITH {tt.FACTS}, {APPEAR}, base AS (SELECT canonical_name, count(*) AS mention_count, count(DISTINCT chunk_id) AS chunk_count, min(chunk_id) AS first_chunk, max(chunk_id) AS last_chunk FROM appear GROUP BY canonical_name),
al AS (SELECT canonical_name, string_agg(DISTINCT raw_name, '|' ORDER BY raw_name) AS aliases FROM appear WHERE raw_name <> canonical_name GROUP BY canonical_name),
act AS (SELECT canonical_name, string_agg(value, '|' ORDER BY rank) AS top_actions FROM ({TOP_ACTIONS.format(v='action', part='', src='appear')}) z GROUP BY canonical_name)
SELECT base.canonical_name, mention_count, chunk_count, first_chunk, last_chunk, coalesce(aliases, '') AS aliases, top_actions FROM base LEFT JOIN al ON base.canonical_name = al.canonical_name LEFT JOIN act ON base.canonical_name = act.canonical_name""")
def p3_profiles(spark, sf_dir):
    p = ch.profiles(_appearances(spark, sf_dir), with_chunks=False)
    return p.select("canonical_name", "mention_count", "chunk_count", "first_chunk", "last_chunk", F.array_join("aliases", "|").alias("aliases"), F.array_join("top_actions", "|").alias("top_actions"))


@query(f"""
WITH {tt.FACTS}, {APPEAR}, parts AS (SELECT canonical_name, chunk_id, pos, split_part(emotion, '、', 1) AS token, '1' AS k FROM appear UNION ALL SELECT canonical_name, chunk_id, pos, split_part(emotion, '、', 2), '2' FROM appear)
{TOP_ACTIONS.format(v='token', part=' || k', src='parts')}""")
def p4_top_emotions(spark, sf_dir):
    return ch.top_values(_appearances(spark, sf_dir), "emotion", tokens=True)


@query(f"WITH {tt.FACTS}, n AS (SELECT DISTINCT name FROM facts) SELECT count(*) AS names, count(*) AS ascii_names, false AS looks_right FROM n")
def p5_encoding_check(spark, sf_dir):
    return ch.encoding_check(_entries(spark, sf_dir, "characters").select("name").distinct(), "name")


@query(f"WITH {tt.FACTS}, {APPEAR} SELECT canonical_name, count(*) AS mention_count, coalesce(string_agg(DISTINCT CASE WHEN raw_name <> canonical_name THEN raw_name END, ', ' ORDER BY CASE WHEN raw_name <> canonical_name THEN raw_name END), '') AS aliases FROM appear GROUP BY canonical_name ORDER BY mention_count DESC, canonical_name LIMIT 10")
def p6_top_profiles(spark, sf_dir):
    facts = _appearances(spark, sf_dir)
    return ch.top_profiles(ch.profile_counts(facts), ch.observed_aliases(facts)).select("canonical_name", "mention_count", "aliases")


# ---- look-ups


def _queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = tt.table(spark, sf_dir, "part")
    return parts.select(F.explode(F.array("p_name", F.element_at(F.split("p_name", " "), 2), F.concat(F.lit("  "), "p_name"), "p_brand", F.lit(" "))).alias("query")).distinct()


def _resolved(spark: SparkSession, sf_dir: str, facts: DataFrame) -> DataFrame:
    nicknames = tt.table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("alias")).agg(F.min("p_name").alias("canonical"))
    return lookup.resolve(_queries(spark, sf_dir), ch.profile_counts(facts), ch.observed_aliases(facts), nicknames)


RESOLVED = f"""{tt.FACTS}, {APPEAR}, asked AS (SELECT DISTINCT unnest([p_name, split_part(p_name, ' ', 2), '  ' || p_name, p_brand, ' ']) AS query FROM part),
known AS (SELECT canonical_name, count(*) AS n FROM appear GROUP BY canonical_name),
seen AS (SELECT raw_name, canonical_name FROM (SELECT a.raw_name, a.canonical_name, row_number() OVER (PARTITION BY a.raw_name ORDER BY k.n DESC, a.canonical_name DESC) AS r FROM (SELECT DISTINCT raw_name, canonical_name FROM appear WHERE raw_name <> canonical_name) a JOIN known k ON k.canonical_name = a.canonical_name) x WHERE r = 1),
nick AS (SELECT p_brand, min(p_name) AS canonical FROM part GROUP BY p_brand),
resolved AS (SELECT query, coalesce(k.canonical_name, s.canonical_name, n2.canonical_name) IS NOT NULL AS matched, coalesce(k.canonical_name, s.canonical_name, n2.canonical_name) AS canonical_name,
  CASE WHEN k.canonical_name IS NOT NULL THEN 'canonical' WHEN s.canonical_name IS NOT NULL THEN 'observed_alias' WHEN n2.canonical_name IS NOT NULL THEN 'query_alias' END AS match_type
FROM asked LEFT JOIN known k ON k.canonical_name = trim(query) LEFT JOIN seen s ON s.raw_name = trim(query) LEFT JOIN nick n ON n.p_brand = trim(query) LEFT JOIN known n2 ON n2.canonical_name = n.canonical)"""


@query(f"WITH {RESOLVED} SELECT * FROM resolved")
def q1_resolve_names(spark, sf_dir):
    return _resolved(spark, sf_dir, _appearances(spark, sf_dir))


RELATED = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY person ORDER BY overlap_chunk_count DESC, related_person) AS rank FROM (
  SELECT person, related_person, count(DISTINCT chunk_id) AS overlap_chunk_count, arg_min(interaction, chunk_id || lpad(CAST(pos AS VARCHAR), 9, '0')) AS interaction_sample, min(chunk_id) AS sample_chunk_id
  FROM (SELECT person_a AS person, person_b AS related_person, chunk_id, pos, interaction FROM facts UNION ALL SELECT person_b, person_a, chunk_id, pos, interaction FROM facts WHERE person_a <> person_b) ways GROUP BY person, related_person) per) x WHERE rank <= 3"""
LOCATED = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY canonical_name ORDER BY overlap_chunk_count DESC, location) AS rank FROM (
  SELECT canonical_name, location, count(*) AS overlap_chunk_count, min(a.chunk_id) AS sample_chunk_id FROM (SELECT DISTINCT canonical_name, chunk_id FROM appear) a JOIN (SELECT DISTINCT location, chunk_id FROM facts) l ON a.chunk_id = l.chunk_id GROUP BY canonical_name, location) met) x WHERE rank <= 3"""


@query(f"WITH {tt.FACTS} {RELATED}")
def q2_relationship_candidates(spark, sf_dir):
    return lookup.relationship_candidates(_entries(spark, sf_dir, "relationships"))


@query(f"""WITH {tt.FACTS}, asked AS (SELECT DISTINCT substr(s_name, 3) AS query FROM supplier)
SELECT query, person_a AS related_person, chunk_id, pos, interaction FROM facts JOIN asked ON query = substr(person_b, 3) OR query = substr(person_a, 3)""")
def q2_loose_relations(spark, sf_dir):
    """Names that stand only inside longer ones: suppliers without the first two letters."""
    asked = tt.table(spark, sf_dir, "supplier").select(F.expr("substring(s_name, 3)").alias("query"))
    return lookup.loose_relations(_entries(spark, sf_dir, "relationships"), asked)


@query(f"WITH {tt.FACTS}, {APPEAR} {LOCATED}")
def q3_location_candidates(spark, sf_dir):
    return lookup.location_candidates(_appearances(spark, sf_dir), _entries(spark, sf_dir, "locations"))


@query(f"""WITH {tt.FACTS}, {APPEAR} SELECT canonical_name, place, raw_name, chunk_id, chapter_hint, action, emotion, alias_source FROM (SELECT *, row_number() OVER (PARTITION BY canonical_name ORDER BY chunk_id, pos) AS place FROM appear) x WHERE place <= 3""")
def q4_appearance_samples(spark, sf_dir):
    return lookup.samples(_appearances(spark, sf_dir), 3)


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _appearances(spark, sf_dir)
    return lookup.person_results(_resolved(spark, sf_dir, facts), ch.profiles(facts, with_chunks=False), lookup.relationship_candidates(_entries(spark, sf_dir, "relationships")), lookup.location_candidates(facts, _entries(spark, sf_dir, "locations")), lookup.samples(facts, 3))


#: A resolved query with all that is known of its person, at most a few items of each kind.
PEOPLE = f"""{RESOLVED},
per_name AS (SELECT canonical_name, count(*) AS mention_count, min(chunk_id) AS first_chunk, max(chunk_id) AS last_chunk, list_sort(list(DISTINCT raw_name) FILTER (raw_name <> canonical_name)) AS aliases FROM appear GROUP BY canonical_name),
tokens AS (SELECT canonical_name, chunk_id, pos, split_part(emotion, '、', 1) AS token, '1' AS k FROM appear UNION ALL SELECT canonical_name, chunk_id, pos, split_part(emotion, '、', 2), '2' FROM appear),
acted AS (SELECT canonical_name, list(value ORDER BY rank) AS top_actions FROM ({TOP_ACTIONS.format(v='action', part='', src='appear')}) z GROUP BY canonical_name),
felt AS (SELECT canonical_name, list(value ORDER BY rank) AS top_emotions FROM ({TOP_ACTIONS.format(v='token', part=' || k', src='tokens')}) z GROUP BY canonical_name),
shown AS (SELECT canonical_name, list({{'raw_name': raw_name, 'chunk_id': chunk_id, 'chapter_hint': chapter_hint, 'action': action, 'emotion': emotion, 'alias_source': alias_source}} ORDER BY place) AS appearance_samples
  FROM (SELECT *, row_number() OVER (PARTITION BY canonical_name ORDER BY chunk_id, pos) AS place FROM appear) x WHERE place <= 3 GROUP BY canonical_name),
related AS (SELECT person AS canonical_name, list({{'related_person': related_person, 'overlap_chunk_count': overlap_chunk_count, 'interaction_sample': interaction_sample, 'sample_chunk_id': sample_chunk_id}} ORDER BY rank) AS relationship_candidates FROM ({RELATED}) x GROUP BY person),
located AS (SELECT canonical_name, list({{'location': location, 'overlap_chunk_count': overlap_chunk_count, 'sample_chunk_id': sample_chunk_id}} ORDER BY rank) AS location_candidates FROM ({LOCATED}) x GROUP BY canonical_name),
people AS (SELECT r.query, r.matched, r.canonical_name, r.match_type, CASE WHEN r.match_type = 'query_alias' THEN r.query END AS query_alias_input, coalesce(aliases, []) AS aliases, mention_count, first_chunk, last_chunk, coalesce(top_actions, []) AS top_actions, coalesce(top_emotions, []) AS top_emotions,
  coalesce(appearance_samples, []) AS appearance_samples, coalesce(relationship_candidates, []) AS relationship_candidates, coalesce(location_candidates, []) AS location_candidates
  FROM resolved r LEFT JOIN per_name USING (canonical_name) LEFT JOIN acted USING (canonical_name) LEFT JOIN felt USING (canonical_name) LEFT JOIN shown USING (canonical_name) LEFT JOIN related USING (canonical_name) LEFT JOIN located USING (canonical_name))"""


@query(f"""WITH {PEOPLE} SELECT query, CAST(to_json({{'query': query, 'query_type': 'person', 'matched': matched, 'resolved_canonical_name': canonical_name, 'match_type': match_type, 'observed_aliases': aliases, 'query_alias_input': query_alias_input,
  'appearance_samples': appearance_samples, 'notes': CASE WHEN NOT matched THEN ['{lookup.NO_MATCH_NOTE}'] WHEN match_type = 'query_alias' THEN ['{lookup.ORDER_NOTE}', '{lookup.SEPARATE_NOTE}', '{lookup.QUERY_NOTE}'] ELSE ['{lookup.ORDER_NOTE}', '{lookup.SEPARATE_NOTE}'] END}}) AS VARCHAR) AS json FROM people""")
def q5_person_json(spark, sf_dir):
    return lookup.json_results(_results(spark, sf_dir))


@query(f"""
WITH {tt.FACTS}, hits AS (
  SELECT chunk_id, 'characters' AS field, string_agg(v, ', ' ORDER BY pos, k) AS hit FROM (SELECT chunk_id, pos, 1 AS k, name AS v FROM facts UNION ALL SELECT chunk_id, pos, 2, action FROM facts UNION ALL SELECT chunk_id, pos, 3, emotion FROM facts) x WHERE contains(v, 'NO') GROUP BY chunk_id
  UNION ALL SELECT chunk_id, 'events', string_agg(v, ', ' ORDER BY pos, k) FROM (SELECT chunk_id, pos, 1 AS k, event AS v FROM facts UNION ALL SELECT chunk_id, pos, 2, cause FROM facts UNION ALL SELECT chunk_id, pos, 3, result FROM facts) x WHERE contains(v, 'NO') GROUP BY chunk_id
  UNION ALL SELECT chunk_id, 'locations', string_agg(location, ', ' ORDER BY pos) FROM facts WHERE contains(location, 'NO') GROUP BY chunk_id
  UNION ALL SELECT chunk_id, 'summary', max(chapter_hint || ' ' || source_file) FROM facts WHERE contains(chapter_hint || ' ' || source_file, 'NO') GROUP BY chunk_id)
SELECT chunk_id, field, CASE WHEN length(hit) > 200 THEN substr(hit, 1, 200) || '...' ELSE hit END AS hit FROM hits""")
def q7_search(spark, sf_dir):
    return lookup.search(_kb(spark, sf_dir), "NO").select("chunk_id", "field", "hit")


@query(f"""
WITH {tt.FACTS}, asked AS (SELECT DISTINCT n_name AS keyword FROM nation UNION SELECT DISTINCT substr(p_type, 1, 5) FROM part UNION SELECT 'R'), hits AS (
  SELECT keyword, chunk_id, 'characters' AS field, string_agg(v, ', ' ORDER BY pos, k) AS hit FROM (SELECT chunk_id, pos, 1 AS k, name AS v FROM facts UNION ALL SELECT chunk_id, pos, 2, action FROM facts UNION ALL SELECT chunk_id, pos, 3, emotion FROM facts) x, asked WHERE contains(v, keyword) GROUP BY keyword, chunk_id
  UNION ALL SELECT keyword, chunk_id, 'events', string_agg(v, ', ' ORDER BY pos, k) FROM (SELECT chunk_id, pos, 1 AS k, event AS v FROM facts UNION ALL SELECT chunk_id, pos, 2, cause FROM facts UNION ALL SELECT chunk_id, pos, 3, result FROM facts) x, asked WHERE contains(v, keyword) GROUP BY keyword, chunk_id
  UNION ALL SELECT keyword, chunk_id, 'locations', string_agg(location, ', ' ORDER BY pos) FROM facts, asked WHERE contains(location, keyword) GROUP BY keyword, chunk_id
  UNION ALL SELECT keyword, chunk_id, 'summary', max(chapter_hint || ' ' || source_file) FROM facts, asked WHERE contains(chapter_hint || ' ' || source_file, keyword) GROUP BY keyword, chunk_id)
SELECT keyword, chunk_id, field, CASE WHEN length(hit) > 200 THEN substr(hit, 1, 200) || '...' ELSE hit END AS hit FROM hits""")
def q7_index_search(spark, sf_dir):
    """All nations, beginnings of part types and one short keyword, searched at once through the index."""
    nations = tt.table(spark, sf_dir, "nation").select(F.col("n_name").alias("keyword"))
    types = tt.table(spark, sf_dir, "part").select(F.substring("p_type", 1, 5)).distinct().toDF("keyword")
    asked = nations.unionByName(types).unionByName(spark.createDataFrame([("R",)], "keyword string"))
    index = search_index.SearchIndex(spark, scratch(spark, "search")).build(_kb(spark, sf_dir))
    return index.search(asked).select("keyword", "chunk_id", "field", "hit")


@query(f"WITH {tt.DOCS} SELECT chunk_id, CASE WHEN lang = 'en' THEN chunk_id ELSE chunk_id || ' [' || lang || ']' END AS evidence FROM docs")
def q8_evidence_tags(spark, sf_dir):
    chunks = tt.doc_chunks(spark, sf_dir)
    typed = chunks.select("chunk_id", F.when(F.col("lang") == "en", "story_scene").otherwise(F.col("lang")).alias("section_type"))
    return lookup.evidence(chunks.select("chunk_id"), typed)


@query(f"WITH {tt.FACTS} SELECT chunk_id, string_agg(marker, '|' ORDER BY p) AS ids FROM (SELECT chunk_id, marker, min(pos) AS p FROM facts GROUP BY chunk_id, marker) x GROUP BY chunk_id")
def q9_normalized_ids(spark, sf_dir):
    padded = F.transform("time_markers", lambda t: F.concat(F.lit(" 　"), t, F.lit("\t")))
    return tt.canon(spark, sf_dir).select("chunk_id", F.array_join(lookup.normalized_ids(padded), "|").alias("ids"))


def _listed(title: str, items: str) -> str:
    return f"|| chr(10) || '{title}:' || chr(10) || CASE WHEN len({items}) > 0 THEN array_to_string(list_transform({items}[1:5], lambda y: '  - ' || y), chr(10)) ELSE '  （无）' END"


@query(f"""WITH {PEOPLE} SELECT query, CASE WHEN NOT matched THEN '查询词: ' || query || chr(10) || '{lookup.NO_MATCH_NOTE}' ELSE '查询词: ' || query || chr(10) || 'canonical: ' || canonical_name || chr(10) || 'match_type: ' || match_type || chr(10)
  || 'observed aliases: ' || CASE WHEN len(aliases) > 0 THEN array_to_string(aliases, '、') ELSE '（无）' END || CASE WHEN match_type = 'query_alias' THEN chr(10) || 'query_alias_input: ' || query ELSE '' END || chr(10) || 'mention_count: ' || CAST(mention_count AS VARCHAR)
  || chr(10) || 'first_chunk: ' || first_chunk || chr(10) || 'last_chunk: ' || last_chunk {_listed('actions', 'top_actions')} {_listed('emotions', 'top_emotions')}
  {_listed('relations', "list_transform(relationship_candidates, lambda r: r.related_person || ' | ' || CAST(r.overlap_chunk_count AS VARCHAR))")} {_listed('places', "list_transform(location_candidates, lambda r: r.location || ' | ' || CAST(r.overlap_chunk_count AS VARCHAR))")} END AS card FROM people""")
def q10_person_cards(spark, sf_dir):
    return lookup.person_card(_results(spark, sf_dir))


# ---- contexts


def _tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _queries(spark, sf_dir).select("query", F.explode(F.array(F.lit("continue_writing"), F.lit("rewrite"), F.lit("other"))).alias("mode")).withColumn("source_text", F.when(F.col("mode") == "rewrite", F.concat(F.lit("about "), "query")))


TASKS = f"""{PEOPLE}, tasks AS (SELECT people.*, mode, CASE WHEN mode = 'rewrite' THEN 'about ' || query ELSE '' END AS source_text, CASE match_type WHEN 'canonical' THEN '[' || query || '] is a canonical name'
  WHEN 'observed_alias' THEN '[' || query || '] is an observed alias of [' || canonical_name || ']' WHEN 'query_alias' THEN '[' || query || '] is a query-time alias of [' || canonical_name || ']' ELSE 'no person matched in any layer' END AS query_resolution
  FROM people CROSS JOIN (SELECT unnest(['continue_writing', 'rewrite']) AS mode) m)"""


@query(f"""WITH {TASKS} SELECT query, mode, CAST(to_json({{'mode': mode, 'query': query, 'resolved_character': {{'matched': matched, 'canonical_name': canonical_name, 'match_type': match_type, 'observed_aliases': aliases, 'query_alias_input': query_alias_input,
  'mention_count': coalesce(mention_count, 0), 'first_chunk': first_chunk, 'last_chunk': last_chunk}}, 'query_resolution': query_resolution, 'appearance_samples': appearance_samples, 'relationship_candidates': relationship_candidates, 'location_candidates': location_candidates,
  'style_guidance': {{'status': 'placeholder', 'note': '{context.WORDING["style_note"]}', 'manual_style_hint': ''}}, 'source_text': source_text}}) AS VARCHAR) AS context FROM tasks""")
def x1_generation_contexts(spark, sf_dir):
    built = context.contexts(context.validate(_tasks(spark, sf_dir))[0], _results(spark, sf_dir))
    return built.select("query", "mode", F.to_json("context", {"ignoreNullFields": "false"}).alias("context"))


@query("WITH asked AS (SELECT DISTINCT unnest([p_name, split_part(p_name, ' ', 2), '  ' || p_name, p_brand, ' ']) AS query FROM part) SELECT query, 'other' AS mode, 'unknown mode' AS reason FROM asked")
def x2_rejected_tasks(spark, sf_dir):
    return context.validate(_tasks(spark, sf_dir))[1].select("query", "mode", "reason")


W = context.WORDING


def _items(rows: str, form: str) -> str:
    return f"CASE WHEN len({rows}) > 0 THEN array_to_string(list_transform({rows}, lambda s: '  - ' || {form}), chr(10)) ELSE '  （无）' END"


PROMPT = f"""CASE mode WHEN 'rewrite' THEN '{W["rewrite"][0]}' || chr(10) || '{W["rewrite"][1]}' || repeat(chr(10), 2) || '{W["source"]}' || chr(10) || regexp_replace(source_text, '^\\s+|\\s+$', '', 'g') ELSE '{W["continue_writing"][0]}' || chr(10) || '{W["continue_writing"][1]}' END || repeat(chr(10), 2)
  || '{W["person"]}' || chr(10) || CASE WHEN matched THEN '  name: ' || canonical_name || chr(10) || '  matched by: ' || match_type || chr(10) || '  aliases: ' || CASE WHEN len(aliases) > 0 THEN array_to_string(aliases, '、') ELSE '（无）' END || chr(10) || '  resolution: ' || query_resolution
    || chr(10) || '  mentions: ' || CAST(mention_count AS VARCHAR) || chr(10) || '  first chunk: ' || first_chunk || chr(10) || '  last chunk: ' || last_chunk ELSE '{W["unmatched"]}' END || repeat(chr(10), 2)
  || '{W["appearances"]}' || chr(10) || {_items("appearance_samples", "s.chunk_id || ' | ' || s.raw_name || ' | ' || s.action || ' | ' || s.emotion")} || repeat(chr(10), 2)
  || '{W["relations"]}' || chr(10) || {_items("relationship_candidates", "s.related_person || ' | ' || CAST(s.overlap_chunk_count AS VARCHAR) || ' | ' || s.interaction_sample")} || repeat(chr(10), 2)
  || '{W["places"]}' || chr(10) || {_items("location_candidates", "s.location || ' | ' || CAST(s.overlap_chunk_count AS VARCHAR)")} || repeat(chr(10), 2) || '{W["style"]}' || chr(10) || '  {W["style_note"]}' || repeat(chr(10), 2) || '{W["closing"]}'"""


@query(f"WITH {TASKS} SELECT query, mode, {PROMPT} AS prompt FROM tasks")
def x3_prompts(spark, sf_dir):
    """A blank prefix changes nothing."""
    return context.prompts(context.contexts(context.validate(_tasks(spark, sf_dir))[0], _results(spark, sf_dir)), prefix=" \n ")


@query(f"WITH {TASKS} SELECT query, mode, 'Be brief.' || repeat(chr(10), 2) || {PROMPT} AS prompt FROM tasks")
def x4_prefixed_prompts(spark, sf_dir):
    return context.prompts(context.contexts(context.validate(_tasks(spark, sf_dir))[0], _results(spark, sf_dir)), prefix=" Be brief. ")


# ---- chunks and gates


@query("SELECT doc_id, i AS pos, p AS paragraph FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS i, p FROM (SELECT doc_id, k, trim(parts[k], ' ' || chr(9) || chr(13)) AS p FROM (SELECT doc_id, string_split(text, chr(10)) AS parts, unnest(range(1, CAST(len(string_split(text, chr(10))) AS BIGINT) + 1)) AS k FROM documents) a) b WHERE p <> '') c")
def k2_paragraphs(spark, sf_dir):
    return tt.table(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunking.paragraphs(F.col("text"), "\\n")).alias("pos", "paragraph"))


#: Paragraphs of at most 500 characters, longer ones packed by sentences, packed into chunks and located: three left folds.
PACKED = """parts AS (SELECT doc_id, source, text, list_filter(list_transform(string_split(text, chr(10)), lambda p: trim(p, ' ' || chr(9) || chr(13))), lambda p: p <> '') AS paras FROM documents WHERE text IS NOT NULL),
sentences AS (SELECT doc_id, i, para, CASE WHEN length(para) > 500 THEN regexp_extract_all(para, '[^.!?]*[.!?]|[^.!?]+') ELSE []::VARCHAR[] END AS s FROM (SELECT doc_id, unnest(range(1, len(paras) + 1)) AS i, unnest(paras) AS para FROM parts) x),
folded AS (SELECT doc_id, i, para, CASE WHEN s = [] THEN NULL ELSE list_reduce(list_transform(s, lambda x: {'done': []::VARCHAR[], 'open': x}), lambda a, x:
    CASE WHEN length(a.open) + length(x.open) <= 500 THEN {'done': a.done, 'open': a.open || x.open}
    ELSE {'done': a.done || CASE WHEN a.open <> '' THEN [a.open] ELSE []::VARCHAR[] END || CASE WHEN length(x.open) > 500 THEN list_transform(range(0, (length(x.open) - 1) // 500 * 500, 500), lambda k: substr(x.open, k + 1, 500)) ELSE []::VARCHAR[] END,
          'open': CASE WHEN length(x.open) > 500 THEN substr(x.open, (length(x.open) - 1) // 500 * 500 + 1) ELSE x.open END} END, {'done': []::VARCHAR[], 'open': ''}) END AS f FROM sentences),
items AS (SELECT doc_id, list({'done': []::VARCHAR[], 'open': CASE WHEN length(para) <= 500 THEN para END, 'long': CASE WHEN f IS NULL THEN []::VARCHAR[] WHEN f.open <> '' THEN f.done || [f.open] ELSE f.done END} ORDER BY i) AS x FROM folded GROUP BY doc_id),
packed AS (SELECT doc_id, list_reduce(x, lambda a, p:
    CASE WHEN p.open IS NOT NULL AND coalesce(length(a.open), 0) + length(p.open) + 1 <= 500 THEN {'done': a.done, 'open': CASE WHEN a.open IS NULL THEN p.open ELSE a.open || chr(10) || p.open END, 'long': []::VARCHAR[]}
    ELSE {'done': a.done || CASE WHEN a.open IS NOT NULL THEN [a.open] ELSE []::VARCHAR[] END || p.long, 'open': p.open, 'long': []::VARCHAR[]} END, {'done': []::VARCHAR[], 'open': NULL::VARCHAR, 'long': []::VARCHAR[]}) AS p FROM items),
chunked AS (SELECT doc_id, CASE WHEN p.open IS NOT NULL THEN p.done || [p.open] ELSE p.done END AS made FROM packed),
placed AS (SELECT parts.doc_id, source, made, list_reduce(list_transform(made, lambda c: {'at': []::BIGINT[], 'last': 0::BIGINT, 'c': c}), lambda a, x: list_transform([strpos(substr(text, greatest(0, a.last - 200) + 1), substr(x.c, 1, 50))], lambda hit:
    {'at': a.at || [CASE WHEN hit = 0 THEN a.last ELSE greatest(0, a.last - 200) + hit - 1 END], 'last': CASE WHEN hit = 0 THEN a.last ELSE greatest(0, a.last - 200) + hit - 1 END + length(x.c), 'c': ''})[1], {'at': []::BIGINT[], 'last': 0::BIGINT, 'c': ''}).at AS places FROM parts JOIN chunked ON parts.doc_id = chunked.doc_id),
chunks AS (SELECT doc_id, source, unnest(range(1, len(made) + 1)) AS i, unnest(made) AS text, unnest(places) AS start FROM placed)"""


@query(f"""WITH {PACKED} SELECT 'doc' || CAST(doc_id AS VARCHAR) || '_' || CASE WHEN i < 10000 THEN lpad(CAST(i AS VARCHAR), 4, '0') ELSE CAST(i AS VARCHAR) END AS chunk_id, 'doc' || CAST(doc_id AS VARCHAR) AS source_name, i AS chunk_idx,
  source || '.txt' AS source_file, '正文' AS chapter_hint, start AS char_start, start + length(text) AS char_end, md5(text) AS text_md5 FROM chunks""")
def k4_chunks(spark, sf_dir):
    return chunking.chunk_documents(tt.raw_texts(spark, sf_dir), most=500, gap="\\n", ends=".!?").withColumn("text_md5", F.md5("text")).drop("text")


@query(f"WITH {PACKED} SELECT 'doc' || CAST(doc_id AS VARCHAR) AS source_name, i AS chunk_idx, '正文' AS chapter_hint, start AS char_start, start + length(text) AS char_end, md5(text) AS text_md5 FROM chunks")
def k4_chunks_sql(spark, sf_dir):
    """The same through SQL: the chunker as a table function beside each text."""
    chunking.register_sql(spark, "chunk_text", gap="\\n", ends=".!?")
    tt.raw_texts(spark, sf_dir).createOrReplaceTempView("texts_to_chunk")
    return spark.sql("SELECT t.source_name, c.chunk_idx, c.chapter_hint, c.char_start, c.char_end, md5(c.text) AS text_md5 FROM texts_to_chunk t, LATERAL chunk_text(t.text, 500) c")


@query("""WITH lines AS (SELECT doc_id, k, x, regexp_matches(x, '^(the|un|der)') AS titled, sum(CASE WHEN regexp_matches(x, '^(the|un|der)') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k) AS nth
  FROM (SELECT doc_id, unnest(range(1, len(p) + 1)) AS k, unnest(p) AS x FROM (SELECT doc_id, string_split(lower(text), chr(10)) AS p FROM documents) a) b),
cut AS (SELECT doc_id, nth, string_agg(x, chr(10) ORDER BY k) AS body, arg_min(x, k) AS head, bool_or(titled) AS titled, min(k) AS k, max(nth) OVER (PARTITION BY doc_id) AS most FROM lines GROUP BY doc_id, nth)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY nth) AS nth, CASE WHEN most = 0 THEN '正文' WHEN titled THEN substr(regexp_replace(head, '^\\s+|\\s+$', '', 'g'), 1, 40) ELSE '前言' END AS hint, length(regexp_replace(body, '\\s+$', '')) AS n FROM cut WHERE body <> ''""")
def k1_sections(spark, sf_dir):
    cut = chunking.sections(tt.table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("text")), "the|un|der")
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("section"))
    return cut.select("doc_id", nth.alias("nth"), "hint", F.length(F.regexp_replace("section_text", r"\s+$", "")).alias("n"))


@query(f"""WITH {PACKED} SELECT 'doc' || CAST(d.doc_id AS VARCHAR) AS source_name, 'utf-8-sig' AS encoding, CAST(length(text) AS BIGINT) AS total_chars, CAST(length(text) AS BIGINT) AS processed_chars, coalesce(n, 0) AS chunk_count,
  CASE WHEN n > 0 THEN 'doc' || CAST(d.doc_id AS VARCHAR) || '_0001' END AS first_chunk, CASE WHEN n > 0 THEN 'doc' || CAST(d.doc_id AS VARCHAR) || '_' || lpad(CAST(n AS VARCHAR), 4, '0') END AS last_chunk
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM chunks GROUP BY doc_id) c ON d.doc_id = c.doc_id""")
def k7_run_summary(spark, sf_dir):
    raw = tt.raw_texts(spark, sf_dir)
    return chunking.run_summary(raw, chunking.chunk_documents(raw, most=500, gap="\\n", ends=".!?")).drop("limit_chars", "limit_lines")


@query("SELECT doc_id, array_to_string(string_split(text, chr(10))[1:2], chr(10)) || CASE WHEN len(string_split(text, chr(10))) > 2 THEN chr(10) ELSE '' END AS text FROM documents")
def s2_limit_lines(spark, sf_dir):
    return chunking.limited(tt.table(spark, sf_dir, "documents").select("doc_id", "text"), limit_lines=2)


@query("SELECT doc_id, substr(text, 1, 77) AS text FROM documents")
def s2_limit_chars(spark, sf_dir):
    return chunking.limited(tt.table(spark, sf_dir, "documents").select("doc_id", "text"), limit_chars=77)


GATED = f"""{tt.DOCS}, gate AS (SELECT chunk_id, CASE WHEN length(trim(text)) < 200 THEN 'too_short (' || CAST(length(trim(text)) AS VARCHAR) || ' chars < 200)'
    WHEN len(full_) BETWEEN 1 AND 2 AND regexp_matches(full_[1], '^(Th|Un|De)') THEN 'title_pattern (' || CAST(len(full_) AS VARCHAR) || ' lines, first=' || chr(39) || substr(full_[1], 1, 30) || chr(39) || ')' END AS reason
  FROM (SELECT *, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> '') AS full_ FROM docs) f)"""


@query(f"WITH {GATED} SELECT chunk_id, reason FROM gate")
def g1_structural_gate(spark, sf_dir):
    return gates.gated(tt.doc_chunks(spark, sf_dir), titles="Th|Un|De").select("chunk_id", F.col("structural_reason").alias("reason"))


@query(f"WITH {tt.LOG} SELECT DISTINCT chunk_id FROM log WHERE status IN ('success', 'structural_chunk')")
def g2_done_ids(spark, sf_dir):
    return gates.done_ids(tt.state_log(spark, sf_dir))


@query(f"""WITH {GATED}, results AS (SELECT gate.chunk_id, CASE WHEN reason IS NOT NULL THEN 'structural_chunk' WHEN doc_id % 7 = 0 THEN 'failed' ELSE 'success' END AS status, reason, length(text) AS n, text FROM gate JOIN docs ON gate.chunk_id = docs.chunk_id)
SELECT 'state' AS log, chunk_id, status AS detail FROM results UNION ALL SELECT 'structural', chunk_id, reason || ' / ' || CAST(n AS VARCHAR) FROM results WHERE status = 'structural_chunk'
UNION ALL SELECT 'bad', chunk_id, 'no answer: ' || md5(substr(text, 1, 2000)) FROM results WHERE status = 'failed'""")
def g5_log_rows(spark, sf_dir):
    docs = gates.gated(tt.doc_chunks(spark, sf_dir), titles="Th|Un|De")
    status = F.when(F.col("structural_reason").isNotNull(), "structural_chunk").when(F.col("doc_id") % 7 == 0, "failed").otherwise("success")
    results = docs.select("chunk_id", status.alias("status"), F.coalesce("structural_reason", F.lit("no answer")).alias("reason"), F.length("text").alias("char_count"), F.col("text").alias("raw"))
    state, structural, bad = gates.log_rows(results)
    row = lambda df, name, detail: df.select(F.lit(name).alias("log"), "chunk_id", detail.alias("detail"))
    return row(state, "state", F.col("status")).unionByName(row(structural, "structural", F.concat("reason", F.lit(" / "), F.col("char_count").cast("string")))).unionByName(row(bad, "bad", F.concat("reason", F.lit(": "), F.md5("raw_response"))))


PENDING = f"{tt.DOCS}, {tt.LOG}, pending AS (SELECT chunk_id, doc_id, lang FROM docs WHERE trim(text) <> '' AND chunk_id NOT IN (SELECT chunk_id FROM log WHERE status <> 'failed'))"


@query(f"WITH {PENDING} SELECT chunk_id, doc_id, lang FROM pending")
def g3_pending(spark, sf_dir):
    return gates.pending(tt.doc_chunks(spark, sf_dir), tt.state_log(spark, sf_dir)).select("chunk_id", "doc_id", "lang")


@query(f"WITH {PENDING} SELECT chunk_id FROM pending ORDER BY chunk_id LIMIT 100 OFFSET 20")
def g4_page(spark, sf_dir):
    return gates.page(gates.pending(tt.doc_chunks(spark, sf_dir), tt.state_log(spark, sf_dir)).select("chunk_id"), 20, 100)


@query(f"""WITH {tt.DOCS}, {tt.LOG} SELECT (SELECT count(*) FROM docs) AS total, (SELECT count(DISTINCT chunk_id) FROM log WHERE status <> 'failed') AS done_before, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'structural_chunk') AS structural, count(*) AS processed FROM log""")
def g6_run_summary(spark, sf_dir):
    log = tt.state_log(spark, sf_dir)
    return gates.run_summary(tt.doc_chunks(spark, sf_dir), log, log)


# ---- responses


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.checked(tt.responses(spark, sf_dir), "canon")


@query(f"WITH {tt.DOCS} SELECT chunk_id, 'chunk_id: ' || chunk_id || chr(10) || chr(10) || text AS content, 2048 AS max_tokens FROM docs")
def r1_requests(spark, sf_dir):
    made = responses.requests(tt.doc_chunks(spark, sf_dir), "system").select("chunk_id", F.from_json("request", "struct<messages:array<struct<role:string,content:string>>,max_tokens:int>").alias("r"))
    return made.select("chunk_id", F.col("r.messages")[1]["content"].alias("content"), F.col("r.max_tokens").alias("max_tokens"))


@query(f"WITH {tt.ANSWERS} SELECT chunk_id, attempt, valid, cut AS truncated FROM answers")
def r5_validated(spark, sf_dir):
    return _checked(spark, sf_dir).select("chunk_id", "attempt", "valid", "truncated")


@query(f"""WITH {tt.ANSWERS}, per AS (SELECT chunk_id, count(*) AS attempts, least(count(*) FILTER (cut), 2) AS stage, bool_or(valid) AS ok FROM answers GROUP BY chunk_id)
SELECT chunk_id, attempts, CAST(stage AS INTEGER) AS stage, CASE stage WHEN 0 THEN 1024 ELSE 1536 END AS max_tokens FROM per WHERE NOT ok AND attempts <= 2""")
def r9_next_requests(spark, sf_dir):
    return responses.next_requests(_checked(spark, sf_dir))


#: The record of a good answer, and what a cut one and one with a wrong key leave behind.
RECORD = """'{"chunk_id": "' || chunk_id || '", "summary": "' || kind || '", "characters": [{"name": "n' || CAST(user_id AS VARCHAR) || '", "action": "a", "emotion": ""}], "events": [], "locations": ["' || kind || '"], "time_markers": [], "relationships": []}'"""
ANSWERED = """'{"chunk_id": "x", "summary": "' || kind || '", "characters": [{"name": "n' || CAST(user_id AS VARCHAR) || '", "action": "a", "emotion": ""},], "events": [], "locations": ["' || kind || '"], "time_markers": [], "relationships": []}'"""


@query(f"""WITH {tt.ANSWERS}, per AS (SELECT chunk_id, count(*) AS n, bool_or(valid) AS ok, coalesce(min(CASE WHEN valid THEN attempt END), max(attempt)) AS attempt FROM answers GROUP BY chunk_id)
SELECT chunk_id, CASE WHEN ok THEN 'success' ELSE 'failed' END AS status, attempt, CASE WHEN ok THEN {RECORD} END AS json,
  CASE WHEN ok THEN NULL WHEN cut THEN 'Unterminated string starting at: line 1 column 38 (char 37)' ELSE '$.summary: missing; $.summmary: not allowed' END AS reason,
  CASE WHEN ok THEN NULL WHEN cut THEN substr({ANSWERED}, 1, 40) ELSE replace({ANSWERED}, '"summary"', '"summmary"') END AS raw FROM per JOIN answers USING (chunk_id, attempt) WHERE ok OR n > 2""")
def r11_accepted(spark, sf_dir):
    return responses.accepted(_checked(spark, sf_dir))


@query(f"""WITH {tt.ANSWERS} SELECT chunk_id, attempt, CASE WHEN cut THEN substr({ANSWERED}, 1, 40) WHEN valid THEN replace({ANSWERED}, '}},]', '}}]') ELSE replace(replace({ANSWERED}, '}},]', '}}]'), '"summary"', '"summmary"') END AS cleaned FROM answers""")
def r3_cleaned(spark, sf_dir):
    return _checked(spark, sf_dir).select("chunk_id", "attempt", "cleaned")


@query("SELECT conv_id, turn, CASE WHEN turn % 3 = 2 THEN NULL ELSE regexp_replace(text, '^\\s+|\\s+$', '', 'g') END AS content FROM conversations")
def r2_message_content(spark, sf_dir):
    """Chat responses with a string, with parts, or without content."""
    c = tt.table(spark, sf_dir, "conversations")
    message = lambda content: F.to_json(F.struct(F.array(F.struct(F.struct(F.lit("assistant").alias("role"), content.alias("content")).alias("message"))).alias("choices")))
    half = F.floor(F.length("text") / 2).cast("int")
    piece = lambda x: F.struct(F.lit("text").alias("type"), x.alias("text"))
    parts = F.array(piece(F.substring("text", F.lit(1), half)), piece(F.substring("text", half + 1, F.length("text"))))
    raw = F.when(F.col("turn") % 3 == 0, message(F.col("text"))).when(F.col("turn") % 3 == 1, message(parts)).otherwise('{"choices": []}')
    return c.select("conv_id", "turn", responses.message_content(raw).alias("content"))


STYLE_KINDS = """styled AS (SELECT event_id, event_id % 4 AS k, 's' || CAST(event_id AS VARCHAR) AS chunk_id, event_type AS kind FROM events)"""


def _style_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Style answers by event: tags with an alias, a repeated one and unknown ones; every fourth has an unknown density, one a wrong think block."""
    e = tt.table(spark, sf_dir, "events")
    k = F.col("event_id") % 4
    density = F.when(k == 3, "odd").otherwise("高")
    think = F.when(k == 1, "<think> \n</think>\n").when(k == 2, "<think>x</think>").otherwise("")
    body = F.concat(think, F.lit('{"chunk_id": "?", "narration_tone": "'), "event_type", F.lit('", "dialogue_density": "'), density, F.lit('", "prose_features": ["a", "b", "c"], "key_dialogues": [{"speaker": "s", "line": "l"}], "style_tags": ["热血", " 温情 ", "热血", "nothing", "幽默"]}'))
    return e.select(F.concat(F.lit("s"), F.col("event_id").cast("string")).alias("chunk_id"), F.lit(1).alias("attempt"), body.alias("raw"))


@query(f"""WITH {STYLE_KINDS} SELECT chunk_id, k <> 3 AS valid, CASE WHEN k = 3 THEN '$.dialogue_density: not one of the allowed values' ELSE '' END AS violations,
  '{{"chunk_id": "' || chunk_id || '", "narration_tone": "' || kind || '", "dialogue_density": "' || CASE WHEN k = 3 THEN 'odd' ELSE '高' END || '", "prose_features": ["a", "b", "c"], "key_dialogues": [{{"speaker": "s", "line": "l", "chunk_id": "' || chunk_id || '"}}], "style_tags": ["热血", "温情", "冷幽默"]}}' AS json FROM styled""")
def r6_style_records(spark, sf_dir):
    """Style records: ids overwritten, absent dialogue ids filled in, tags made uniform."""
    rows = responses.checked(_style_answers(spark, sf_dir), "style")
    return rows.select("chunk_id", "valid", F.array_join("violations", "; ").alias("violations"), "json")


@query(f"WITH {STYLE_KINDS} SELECT chunk_id, CASE WHEN k = 2 THEN '<think>x</think>{{' ELSE '{{' END AS head FROM styled")
def r4_think_block(spark, sf_dir):
    """Only an empty think block in front goes (before the object is cut out)."""
    rows = _style_answers(spark, sf_dir)
    return rows.select("chunk_id", F.concat(F.substring_index(responses.without_empty_think(F.col("raw")), "{", 1), F.lit("{")).alias("head"))


@query(f"""WITH {STYLE_KINDS} SELECT chunk_id, 1792 AS max_tokens FROM styled WHERE k = 0""")
def r10_recovery_requests(spark, sf_dir):
    return responses.recovery_requests(_ladder(spark, sf_dir))


def _ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every second event three answers, two cut and one good; the good one is sparse for every fourth."""
    e = _style_answers(spark, sf_dir).where("cast(substring(chunk_id, 2) as long) % 2 = 0")
    sparse = F.expr("cast(substring(chunk_id, 2) as long) % 4 = 0")
    full = F.replace(F.col("raw"), F.lit('[{"speaker": "s", "line": "l"}]'), F.lit('[{"speaker": "s", "line": "l"}, {"speaker": "s", "line": "m"}, {"speaker": "s", "line": "n"}]'))
    good = F.replace(F.when(sparse, F.col("raw")).otherwise(full), F.lit("<think>x</think>"), F.lit(""))
    cut = F.substring(good, 1, 60)
    answers = F.array(*[F.struct(F.lit(n).alias("attempt"), c.alias("raw")) for n, c in ((1, cut), (2, cut), (3, good))])
    return responses.checked(e.select("chunk_id", F.inline(answers)), "style")


@query(f"""WITH {STYLE_KINDS} SELECT chunk_id, k = 0 AND event_id % 8 = 0 AS recovered, CASE WHEN k = 0 AND event_id % 8 <> 0 THEN 1 ELSE 3 END AS dialogues FROM styled WHERE k IN (0, 2)""")
def r10_recovered(spark, sf_dir):
    """Answers to recovery requests: every second one is good and taken, the others are cut and the old record stays."""
    rows = _ladder(spark, sf_dir)
    good = responses.accepted(rows)
    again = rows.where("attempt = 3").join(responses.recovery_requests(rows), "chunk_id", "left_semi")
    full = F.replace(F.col("raw"), F.lit('[{"speaker": "s", "line": "l"}]'), F.lit('[{"speaker": "s", "line": "l"}, {"speaker": "s", "line": "m"}, {"speaker": "s", "line": "n"}]'))
    raw = F.when(F.expr("cast(substring(chunk_id, 2) as long) % 8 = 0"), full).otherwise(F.substring("raw", 1, 50))
    out = responses.recovered(good, responses.checked(again.select("chunk_id", F.lit(1).alias("attempt"), raw.alias("raw")), "style"))
    return out.select("chunk_id", "recovered", F.size(F.from_json("json", "struct<key_dialogues:array<string>>")["key_dialogues"]).alias("dialogues"))


@query(f"WITH {STYLE_KINDS} SELECT chunk_id, '热血/温情/冷幽默' AS tags FROM styled")
def r7_tags(spark, sf_dir):
    rows = tt.table(spark, sf_dir, "events").select(F.concat(F.lit("s"), F.col("event_id").cast("string")).alias("chunk_id"), F.array(*map(F.lit, ("热血", " 温情 ", "热血", "nothing", "幽默"))).alias("tags"))
    return rows.select("chunk_id", F.array_join(responses.uniform_tags(F.col("tags")), "/").alias("tags"))


@query("""WITH e AS (SELECT *, 'u' || CAST(user_id AS VARCHAR) || '_' || CAST(event_id // 50 AS VARCHAR) AS chunk_id FROM events WHERE event_type IN ('click', 'purchase'))
SELECT chunk_id, arg_min(event_type, event_id) AS summary, 'n' || CAST(max(user_id) AS VARCHAR) AS name FROM e GROUP BY chunk_id""")
def r12_overlaid(spark, sf_dir):
    good = responses.accepted(_checked(spark, sf_dir))
    meta = good.select("chunk_id", F.lit("old").alias("summary"), F.lit("f").alias("source_file"))
    return responses.overlaid(meta, good, CANON).select("chunk_id", "summary", F.col("characters")[0]["name"].alias("name"))


# ---- section types

WORDS = {"author_meta": ("^the\\b", "\\bof the\\b"), "front_matter": ("\\bcopyright\\b", "\\breserved\\b"), "in_universe_document": ("@",), "setting_exposition": ("\\|",)}


def _scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks that may be no story scenes; four in five have a canon record, some without events or characters."""
    docs = tt.doc_chunks(spark, sf_dir)
    some = lambda k: F.when(F.col("doc_id") % k == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("x")))
    return sections.scan(docs, docs.where("doc_id % 5 <> 0").select("chunk_id", some(2).alias("events"), some(3).alias("characters")), WORDS, ('"',), ("\\band\\b", "\\bund\\b"))


def _found(*patterns: str) -> str:
    return "list_filter([" + ", ".join(f"nullif(regexp_extract(h, '(?im){p}'), '')" for p in patterns) + "], lambda x: x IS NOT NULL)"


SCANNED = f"""{tt.DOCS}, head AS (SELECT chunk_id, doc_id, text, substr(text, 1, 500) AS h, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> '') AS rows_ FROM docs),
hits AS (SELECT *, CASE {' '.join(f"WHEN len({_found(*p)}) > 0 THEN {{'type': '{k}', 'hits': {_found(*p)}}}" for k, p in WORDS.items())} END AS k, len(rows_) AS n, len(list_filter(rows_, lambda x: regexp_matches(x, '^[0-9]+[.、)]'))) AS numbered FROM (SELECT *, replace(h, '|', chr(1)) AS bars FROM head) b),
typed AS (SELECT chunk_id, doc_id, k, CASE WHEN n > 5 AND numbered / n > 0.4 THEN '编号列表占比 ' || CAST(numbered AS VARCHAR) || '/' || CAST(n AS VARCHAR)
  WHEN length(text) > 300 AND NOT contains(text, '"') AND len(regexp_extract_all(text, '\\band\\b')) + len(regexp_extract_all(text, '\\bund\\b')) < 3 THEN '无对话标记且叙事动词不足' END AS other FROM hits),
scanned AS (SELECT chunk_id, coalesce(k.type, 'setting_exposition') AS suggested_type, CASE WHEN second IS NOT NULL AND (k IS NOT NULL OR second = 'canon 输出无事件且无角色') THEN 'high' ELSE 'uncertain' END AS confidence,
  coalesce('关键词命中: ' || array_to_string(k.hits, ', '), other) || coalesce('; ' || second, '') AS reasons
  FROM (SELECT *, CASE WHEN doc_id % 5 <> 0 AND doc_id % 6 = 0 THEN 'canon 输出无事件且无角色' WHEN doc_id % 5 <> 0 AND doc_id % 2 = 0 THEN 'canon 输出无事件' END AS second FROM typed) s WHERE k IS NOT NULL OR other IS NOT NULL)"""


@query(f"WITH {SCANNED} SELECT * FROM scanned")
def t1_section_scan(spark, sf_dir):
    return _scanned(spark, sf_dir).select("chunk_id", "suggested_type", "confidence", F.array_join("reasons", "; ").alias("reasons"))


@query(f"WITH {SCANNED} SELECT dimension, value, count(*) AS count FROM (SELECT 'total' AS dimension, 'all' AS value FROM scanned UNION ALL SELECT 'confidence', confidence FROM scanned UNION ALL SELECT 'type', suggested_type FROM scanned) x GROUP BY dimension, value")
def t5_scan_summary(spark, sf_dir):
    return sections.scan_summary(_scanned(spark, sf_dir))


def _label_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels over the whole range of documents and some beyond it."""
    kind = F.element_at(F.array(F.lit("author_meta"), F.lit("front_matter"), F.lit("story_scene"), F.lit("bogus"), F.lit("")), (F.col("event_id") % 5 + 1).cast("int"))
    chunk = F.concat(F.lit("d"), F.lpad((F.col("event_id") * 7 % F.col("ids")).cast("string"), 9, "0"))
    ids = tt.table(spark, sf_dir, "documents").agg((F.floor(F.max("doc_id") * 1.25) + 2).alias("ids"))
    return tt.table(spark, sf_dir, "events").crossJoin(ids).select(F.col("event_id").alias("line_no"), chunk.alias("chunk_id"), F.when(F.col("event_type") != "click", kind).alias("suggested_type"), kind.alias("section_type"))


LABELS = "marks AS (SELECT event_id AS line_no, 'd' || lpad(CAST(event_id * 7 % (SELECT CAST(floor(max(doc_id) * 1.25) AS BIGINT) + 2 FROM documents) AS VARCHAR), 9, '0') AS chunk_id, event_id % 5 AS k FROM events)"


@query(f"WITH {LABELS} SELECT line_no, chunk_id, CASE WHEN k = 3 THEN 'unknown type bogus' ELSE 'missing section_type' END AS reason FROM marks WHERE k IN (3, 4)")
def t6_rejected_labels(spark, sf_dir):
    return sections.validated_labels(_label_entries(spark, sf_dir))[1].select("line_no", "chunk_id", "reason")


@query(f"""WITH {LABELS}, {tt.DOCS}, last AS (SELECT chunk_id, arg_max(CASE k WHEN 0 THEN 'author_meta' ELSE 'front_matter' END, line_no) AS section_type FROM marks WHERE k IN (0, 1) GROUP BY chunk_id)
SELECT docs.chunk_id, section_type FROM docs LEFT JOIN last ON docs.chunk_id = last.chunk_id""")
def t7_apply_labels(spark, sf_dir):
    good, _ = sections.validated_labels(_label_entries(spark, sf_dir))
    return sections.apply_labels(tt.doc_chunks(spark, sf_dir), good)[0].select("chunk_id", "section_type")


@query(f"""WITH {LABELS}, {tt.DOCS}, last AS (SELECT chunk_id, arg_max(CASE k WHEN 0 THEN 'author_meta' ELSE 'front_matter' END, line_no) AS section_type FROM marks WHERE k IN (0, 1) GROUP BY chunk_id)
SELECT docs.chunk_id, CAST(NULL AS VARCHAR) AS first, section_type AS before, CASE WHEN doc_id % 5 = 0 THEN 'setting_exposition' ELSE section_type END AS now, section_type AS restored FROM docs LEFT JOIN last ON docs.chunk_id = last.chunk_id""")
def t7_label_versions(spark, sf_dir):
    """Labels of all documents as versions: the first state, a version of the confirmed labels, one of later labels, and one that
    restores the second; all four are read from the same folder."""
    good, _ = sections.validated_labels(_label_entries(spark, sf_dir))
    chunks = tt.doc_chunks(spark, sf_dir)
    table = versions.LabelVersions(spark, scratch(spark, "labels"))
    table.start(chunks)
    table.apply(good)
    table.apply(chunks.where("doc_id % 5 = 0").select("chunk_id", F.lit("setting_exposition").alias("section_type"), F.col("doc_id").alias("line_no")))
    table.restore(2)
    read = lambda v, name: table.read(v).select("chunk_id", F.col("section_type").alias(name))
    return read(1, "first").join(read(2, "before"), "chunk_id").join(read(3, "now"), "chunk_id").join(read(None, "restored"), "chunk_id")


@query(f"""WITH {LABELS}, {tt.DOCS}, good AS (SELECT * FROM marks WHERE k IN (0, 1)), known AS (SELECT good.* FROM good WHERE chunk_id IN (SELECT chunk_id FROM docs))
SELECT (SELECT count(*) FROM marks) AS entries, (SELECT count(*) FROM known) AS success, (SELECT count(DISTINCT chunk_id) FROM known) AS chunks_labelled, (SELECT count(*) FROM good) - (SELECT count(*) FROM known) AS errors, (SELECT count(*) FROM marks WHERE k IN (3, 4)) AS rejected""")
def t8_apply_log(spark, sf_dir):
    entries = _label_entries(spark, sf_dir)
    good, rejected = sections.validated_labels(entries)
    return sections.apply_log(entries, good, sections.apply_labels(tt.doc_chunks(spark, sf_dir), good)[1], rejected)


@query(f"""WITH {LABELS}, {tt.DOCS}, last AS (SELECT chunk_id, arg_max(CASE k WHEN 0 THEN 'author_meta' ELSE 'front_matter' END, line_no) AS t FROM marks WHERE k IN (0, 1) GROUP BY chunk_id)
SELECT coalesce(t, 'story_scene') AS section_type, count(*) AS count FROM docs LEFT JOIN last ON docs.chunk_id = last.chunk_id GROUP BY coalesce(t, 'story_scene')""")
def t9_verify(spark, sf_dir):
    good, _ = sections.validated_labels(_label_entries(spark, sf_dir))
    return sections.verify(sections.apply_labels(tt.doc_chunks(spark, sf_dir), good)[0])


@query(f"""WITH {LABELS}, {tt.DOCS}, good AS (SELECT * FROM marks WHERE k IN (0, 1) AND chunk_id IN (SELECT chunk_id FROM docs)), c AS (SELECT (SELECT count(*) FROM docs) AS total, count(DISTINCT chunk_id) AS tagged, count(*) AS success FROM good)
SELECT total, tagged, total - tagged AS untagged, true AS equals_chunks, tagged = success AS equals_success FROM c""")
def t9_verify_log(spark, sf_dir):
    entries = _label_entries(spark, sf_dir)
    good, rejected = sections.validated_labels(entries)
    labelled, unknown = sections.apply_labels(tt.doc_chunks(spark, sf_dir), good)
    return sections.verify_log(labelled, sections.apply_log(entries, good, unknown, rejected))


# ---- recall, graph, audits


@query(f"""WITH {tt.DOCS}, terms AS (SELECT DISTINCT split_part(p_name, ' ', 2) AS term FROM part)
SELECT chunk_id, term, instr(text, term) - 1 AS pos, (length(text) - length(replace(text, term, ''))) // length(term) AS n FROM docs JOIN terms ON contains(text, term)""")
def b1_recall(spark, sf_dir):
    terms = tt.table(spark, sf_dir, "part").select(F.element_at(F.split("p_name", " "), 2).alias("term"))
    return recall.mentions_in_text(tt.doc_chunks(spark, sf_dir), terms)


@query(f"""WITH {tt.DOCS}, terms AS (SELECT DISTINCT split_part(p_name, ' ', 2) AS term FROM part), m AS (SELECT chunk_id, term AS entity, row_number() OVER (PARTITION BY term ORDER BY chunk_id) AS place FROM docs JOIN terms ON contains(text, term) WHERE doc_id % 2 = 1)
SELECT entity, count(*) AS chunk_count, string_agg(CASE WHEN place <= 20 THEN chunk_id END, ' ' ORDER BY chunk_id) AS evidence FROM m GROUP BY entity""")
def b1_recall_rounds(spark, sf_dir):
    """Rounds until nothing new is found; what stands in every other document is known before."""
    docs = tt.doc_chunks(spark, sf_dir)
    terms = tt.table(spark, sf_dir, "part").select(F.element_at(F.split("p_name", " "), 2).alias("term"))
    known = recall.mentions_in_text(docs.where("doc_id % 2 = 0"), terms).select(F.col("term").alias("entity"), "chunk_id")
    none = terms.select(F.col("term").alias("alias"), F.col("term").alias("canonical")).limit(0)
    found = recall.evidence_chunks(recall.recall_rounds(docs, terms, none, known))
    return found.withColumn("evidence", F.array_join("evidence", " "))


@query("""WITH c AS (SELECT DISTINCT split_part(p_name, ' ', 2) AS alias, p_name AS canonical FROM part), s AS (SELECT alias, min(canonical) AS settled FROM c GROUP BY alias)
SELECT 'several_canonicals' AS problem, alias, CAST(count(*) AS VARCHAR) AS detail FROM c GROUP BY alias HAVING count(*) > 1 UNION ALL SELECT 'against_confirmed', c.alias, canonical FROM c JOIN s ON c.alias = s.alias WHERE canonical <> settled""")
def b2_exit_gate(spark, sf_dir):
    c = tt.table(spark, sf_dir, "part").select(F.element_at(F.split("p_name", " "), 2).alias("alias"), F.col("p_name").alias("canonical"), F.array("p_brand").alias("evidence"))
    return recall.exit_gate(c.dropDuplicates(["alias", "canonical"]), _confirmed(spark, sf_dir))


@query(f"""WITH {tt.FACTS}, {APPEAR}, t AS (SELECT canonical_name AS subject, 'appears_in' AS predicate, chunk_id AS object, chunk_id FROM appear
  UNION ALL SELECT canonical_name, 'appears_at', location, a.chunk_id FROM (SELECT DISTINCT canonical_name, chunk_id FROM appear) a JOIN (SELECT DISTINCT location, chunk_id FROM facts) l ON a.chunk_id = l.chunk_id
  UNION ALL SELECT person_a, 'interacts_with', person_b, chunk_id FROM facts)
SELECT subject, predicate, object, CAST(sum(m) AS BIGINT) AS n, min(chunk_id) AS first_chunk, string_agg(CASE WHEN place <= 5 THEN chunk_id END, ' ' ORDER BY chunk_id) AS evidence
FROM (SELECT subject, predicate, object, chunk_id, count(*) AS m, row_number() OVER (PARTITION BY subject, predicate, object ORDER BY chunk_id) AS place FROM t GROUP BY subject, predicate, object, chunk_id) x GROUP BY subject, predicate, object""")
def b3_triples(spark, sf_dir):
    return graph.triples(_appearances(spark, sf_dir), _entries(spark, sf_dir, "locations"), _entries(spark, sf_dir, "relationships")).withColumn("evidence", F.array_join("evidence", " "))


@query(f"""WITH {tt.FACTS}, items AS (SELECT source_file AS source, chunk_id, pos AS p, 'time' AS kind, marker AS text FROM facts UNION ALL SELECT source_file, chunk_id, pos + 1000000, 'event', event FROM facts)
SELECT source, row_number() OVER (PARTITION BY source ORDER BY chunk_id, p) AS place, chunk_id, kind, text FROM items""")
def b4_timeline(spark, sf_dir):
    return graph.timeline(tt.canon(spark, sf_dir))


@query(f"""WITH {tt.FACTS}, per AS (SELECT chunk_id, max(source_file) AS source, count(*) AS n FROM facts GROUP BY chunk_id),
pairs AS (SELECT DISTINCT source_file AS source, chunk_id, person_a, person_b FROM facts), firsts AS (SELECT source, person_a, person_b, min(chunk_id) AS f FROM pairs GROUP BY source, person_a, person_b),
reused AS (SELECT p.chunk_id, count(*) AS r FROM pairs p JOIN firsts f ON p.source = f.source AND p.person_a = f.person_a AND p.person_b = f.person_b WHERE p.chunk_id > f.f GROUP BY p.chunk_id),
scored AS (SELECT per.chunk_id, source, n, coalesce(r, 0) AS r, percent_rank() OVER (PARTITION BY source ORDER BY per.chunk_id) AS share FROM per LEFT JOIN reused ON per.chunk_id = reused.chunk_id),
points AS (SELECT chunk_id, source, (CASE WHEN share BETWEEN 0.3 AND 0.7 THEN 1 ELSE 0 END) + (CASE WHEN n >= 3 THEN 1 ELSE 0 END) + (CASE WHEN n >= 6 THEN 1 ELSE 0 END) + (CASE WHEN n >= 4 THEN 1 ELSE 0 END) + (CASE WHEN r >= 3 THEN 1 ELSE 0 END) AS points FROM scored)
SELECT chunk_id, source, points, CASE WHEN points >= 4 THEN 'L3' WHEN points >= 2 THEN 'L2' ELSE 'L1' END AS level FROM points""")
def b5_risk_levels(spark, sf_dir):
    return graph.risk_levels(tt.canon(spark, sf_dir))


@query("SELECT role AS label, CASE WHEN turn % 2 = 0 THEN 'high' ELSE 'low' END AS severity, count(*) AS count FROM conversations WHERE role IN ('user', 'assistant') AND trim(text) <> '' GROUP BY role, CASE WHEN turn % 2 = 0 THEN 'high' ELSE 'low' END")
def b6_review_tallies(spark, sf_dir):
    findings = tt.table(spark, sf_dir, "conversations").select(F.col("role").alias("label"), F.when(F.col("turn") % 2 == 0, "high").otherwise("low").alias("severity"), F.col("text").alias("evidence"))
    return audit.finding_tallies(audit.checked_findings(findings, ["user", "assistant"]).where("problem is null"))


@query("""WITH r AS (SELECT event_type AS a, 'm' || CAST(user_id % 7 AS VARCHAR) AS b, CASE WHEN value > 50 THEN event_type WHEN value > 20 THEN 'm' || CAST(user_id % 7 AS VARCHAR) END AS w FROM events),
s AS (SELECT a AS candidate, coalesce(w = a, false) AS won, coalesce(w = b, false) AS lost FROM r UNION ALL SELECT b, coalesce(w = b, false), coalesce(w = a, false) FROM r)
SELECT candidate, count(*) AS compared, count(*) FILTER (won) AS wins, count(*) FILTER (lost) AS losses, count(*) FILTER (won) / count(*) AS win_rate FROM s GROUP BY candidate""")
def b7_preferences(spark, sf_dir):
    b = F.concat(F.lit("m"), (F.col("user_id") % 7).cast("string"))
    reviews = tt.table(spark, sf_dir, "events").select(F.col("event_type").alias("candidate_a"), b.alias("candidate_b"), F.when(F.col("value") > 50, F.col("event_type")).when(F.col("value") > 20, b).alias("winner"), F.array("event_type").alias("tags_a"), F.array(b).alias("tags_b"))
    return audit.preferences(reviews)[1]


@query("""WITH f AS (SELECT p_name AS character, 'f' || CAST(p_partkey AS VARCHAR) AS field, CASE WHEN p_size % 5 = 0 THEN 'TODO' ELSE p_type END AS value, p_size, 'd' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS chunk_id FROM part)
SELECT character, field, CASE WHEN value = 'TODO' THEN 'placeholder' ELSE 'no evidence' END AS problem FROM f WHERE value = 'TODO' OR p_size % 2 = 0 OR chunk_id NOT IN (SELECT 'd' || lpad(CAST(doc_id AS VARCHAR), 9, '0') FROM documents)
UNION ALL SELECT character, field, 'evidence chunk missing' FROM f WHERE p_size % 2 <> 0 AND chunk_id NOT IN (SELECT 'd' || lpad(CAST(doc_id AS VARCHAR), 9, '0') FROM documents)""")
def b8_package_audit(spark, sf_dir):
    p = tt.table(spark, sf_dir, "part").select(F.col("p_name").alias("character"), F.concat(F.lit("f"), F.col("p_partkey").cast("string")).alias("field"), F.when(F.col("p_size") % 5 == 0, "TODO").otherwise(F.col("p_type")).alias("value"), "p_size", F.concat(F.lit("d"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("chunk_id"))
    return audit.package_audit(p.select("character", "field", "value"), p.where("p_size % 2 <> 0").select("character", "field", "chunk_id"), tt.doc_chunks(spark, sf_dir))


@query("SELECT 'character' AS kind, count(*) AS items, count(*) FILTER (contains(text, lang)) AS grounded, 0 AS notices FROM documents UNION ALL SELECT 'location', count(*), count(*) FILTER (contains(text, source)), 0 FROM documents UNION ALL SELECT 'summary', count(*), 0, count(*) FILTER (n_chars < 100 OR n_chars > 200) FROM documents UNION ALL SELECT 'dialogue', count(*), count(*) FILTER (contains(text, trim(line))), count(*) FILTER (length(line) > 30) FROM (SELECT text, substr(text, length(text) // 2 + 1, 25 + doc_id % 10) || CASE WHEN doc_id % 3 = 0 THEN '§' ELSE '' END AS line FROM documents) d WHERE regexp_replace(line, '^\\s+|\\s+$', '', 'g') <> ''")
def b9_grounding(spark, sf_dir):
    docs = tt.doc_chunks(spark, sf_dir)
    canon = docs.select("chunk_id", F.array(F.struct(F.col("lang").alias("name"))).alias("characters"), F.array("source_name").alias("locations"), F.col("text").alias("summary"))
    middle = F.substring("text", F.floor(F.length("text") / 2).cast("int") + 1, (F.col("doc_id") % 10 + 25).cast("int"))
    line = F.concat(middle, F.when(F.col("doc_id") % 3 == 0, "§").otherwise(""))
    style = docs.select("chunk_id", F.array(F.struct(line.alias("line"))).alias("key_dialogues"))
    return audit.grounding_summary(audit.grounding(canon, style, docs))


# ---- streams


@query("SELECT event_type AS status, count(*) AS count FROM events GROUP BY event_type")
def st2_running_counts(spark, sf_dir):
    """The events table as a stream of files, counted by type; the counts must equal the batch's."""
    from loretable.streaming.intake import running_counts, start_counts

    schema = tt.table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")  # a pattern: the table may be one file
    name = f"running_{uuid4().hex}"
    query = start_counts(running_counts(stream.withColumnRenamed("event_type", "status"), "status"), name, scratch(spark, "counts"))
    query.awaitTermination()
    return spark.table(name)


@query(f"""WITH {tt.FACTS}, base AS (SELECT name, count(*) AS count, count(DISTINCT chunk_id) AS chunk_count, min(chunk_id) AS first_chunk, max(chunk_id) AS last_chunk FROM facts GROUP BY name)
SELECT base.name, count, chunk_count, first_chunk, last_chunk, actions, emotions FROM base JOIN ({_array_sql('name', 'action', 'actions', 5)}) a ON base.name = a.name JOIN ({_array_sql('name', 'emotion', 'emotions', 5)}) e ON base.name = e.name""")
def st2_running_characters(spark, sf_dir):
    """The character index kept by a stream over records that come in no order; half of the files come after a restart."""
    from loretable.streaming.intake import chunk_stream
    from loretable.streaming.running_index import read_running_index, start_running_index

    records = tt.canon(spark, sf_dir).select("chunk_id", "characters")
    path, out, checkpoint = (scratch(spark, n) for n in ("records", "running", "running_checkpoint"))
    for half in range(2):
        records.where(F.pmod(F.xxhash64("chunk_id"), F.lit(2)) == half).repartition(4, "chunk_id").write.mode("append").parquet(path)
        start_running_index(chunk_stream(spark, path, records.schema, 2), out, checkpoint, most=5).awaitTermination()
    found = read_running_index(spark, out)
    return found.select("name", "count", "chunk_count", "first_chunk", "last_chunk", F.array_join("actions", "|").alias("actions"), F.array_join("emotions", "|").alias("emotions"))


@query(f"""WITH {tt.ANSWERS}, per AS (SELECT chunk_id, count(*) AS n, least(count(*) FILTER (cut), 2) AS stage, bool_or(valid) AS ok, coalesce(min(CASE WHEN valid THEN attempt END), max(attempt)) AS attempt FROM answers GROUP BY chunk_id)
SELECT chunk_id, CASE WHEN ok THEN 'success' WHEN n > 2 THEN 'failed' ELSE 'pending' END AS status, CASE WHEN ok OR n > 2 THEN attempt END AS attempt, CASE WHEN ok THEN {RECORD} END AS json,
  CASE WHEN ok OR n <= 2 THEN NULL WHEN cut THEN 'Unterminated string starting at: line 1 column 38 (char 37)' ELSE '$.summary: missing; $.summmary: not allowed' END AS reason,
  CASE WHEN NOT ok AND n <= 2 THEN 'retry' END AS ask, n AS attempts, CAST(stage AS INTEGER) AS stage, CASE WHEN NOT ok AND n <= 2 THEN 2048 END AS max_tokens FROM per JOIN answers USING (chunk_id, attempt)""")
def r11_ladder_stream(spark, sf_dir):
    """The retry ladder as a stream over answers in no order; half of the files come after a restart."""
    from loretable.streaming.attempts import situations, start_ladder
    from loretable.streaming.intake import chunk_stream

    answers = tt.responses(spark, sf_dir)
    path, out, checkpoint = (scratch(spark, n) for n in ("answers", "ladder", "ladder_checkpoint"))
    for half in range(2):
        answers.where(F.pmod(F.xxhash64("chunk_id", "attempt"), F.lit(2)) == half).repartition(4, "attempt", "chunk_id").write.mode("append").parquet(path)
        start_ladder(chunk_stream(spark, path, answers.schema, 2), out, checkpoint, kind="canon").awaitTermination()
    return situations(spark, out).select("chunk_id", "status", "attempt", "json", "reason", "ask", "attempts", "stage", "max_tokens")


@query(f"WITH {GATED} SELECT chunk_id, coalesce(reason, 'pending') AS went FROM gate")
def st1_intake(spark, sf_dir):
    """The documents table as a stream of files, gated into two tables; a second start finds nothing new."""
    from loretable.streaming.intake import start_intake

    schema = tt.table(spark, sf_dir, "documents").schema
    paths = [scratch(spark, n) for n in ("pending", "structural", "intake")]
    for _ in range(2):
        stream = spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/documents.parque[t]").select(F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("chunk_id"), "text")
        start_intake(stream, *paths, titles="Th|Un|De").awaitTermination()
    pending = spark.read.parquet(paths[0]).select("chunk_id", F.lit("pending").alias("went"))
    return pending.unionByName(spark.read.parquet(paths[1]).select("chunk_id", F.col("reason").alias("went")))


@query(f"WITH {GATED} SELECT chunk_id, coalesce(reason, 'pending') AS went FROM gate")
def st1_once_intake(spark, sf_dir):
    """Documents taken once for ever without state: the table's file comes twice, under two names."""
    from loretable.streaming.intake import chunk_stream, start_once, taken

    docs = tt.table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("chunk_id"), "text")
    path, root, checkpoint = (scratch(spark, n) for n in ("arrivals", "taken", "once"))
    for _ in range(2):
        docs.write.mode("append").parquet(path)
        start_once(chunk_stream(spark, path, docs.schema), root, checkpoint, titles="Th|Un|De").awaitTermination()
    return taken(spark, root).select("chunk_id", F.coalesce("structural_reason", F.lit("pending")).alias("went"))


# ---- sinks and sources, written and read again


@query("""SELECT 's' || CAST(s_suppkey AS VARCHAR) AS chunk_id, s_name AS summary, true AS good FROM supplier WHERE s_suppkey % 7 <> 0 UNION ALL SELECT NULL, CAST(count(*) AS VARCHAR), false FROM supplier WHERE s_suppkey % 7 = 0""")
def s4_json_folder(spark, sf_dir):
    """Suppliers as a folder of JSON files, one each; every seventh is cut off and counted as unreadable."""
    s = tt.table(spark, sf_dir, "supplier")
    record = F.to_json(F.struct(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("chunk_id"), F.col("s_name").alias("summary")))
    path = scratch(spark, "records")
    # files take their time one by one, so all cores write, and each task moves its own
    values = s.repartition(4 * spark.sparkContext.defaultParallelism, "s_suppkey").select(F.when(F.col("s_suppkey") % 7 == 0, F.substring(record, 1, 12)).otherwise(record).alias("value"))
    values.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
    good, bad = io.load_records(spark, path, "chunk_id string, summary string", files="*.txt")
    return good.withColumn("good", F.lit(True)).unionByName(bad.agg(F.count("*").cast("string").alias("summary")).select(F.lit(None).cast("string").alias("chunk_id"), "summary", F.lit(False).alias("good")))


@query("SELECT DISTINCT least(trim(p_type), trim(p_brand)) AS a, greatest(trim(p_type), trim(p_brand)) AS b FROM part")
def s6_block_pairs(spark, sf_dir):
    """Pairs that must not be merged, as lists of objects under a key, one file for each size of parts."""
    pairs = tt.table(spark, sf_dir, "part").select("p_size", F.struct(F.concat(F.lit(" "), "p_type").alias("a"), F.col("p_brand").alias("b")).alias("pair")).distinct()
    lists = pairs.groupBy("p_size").agg(F.collect_list("pair").alias("pairs")).select(F.to_json(F.struct("pairs")).alias("value"))
    path = scratch(spark, "pairs")
    lists.write.option("maxRecordsPerFile", 1).text(path)
    return io.read_block_pairs(spark, path)


@query(f"WITH {PACKED} SELECT 'doc' || CAST(doc_id AS VARCHAR) AS source_name, count(*) AS chunks, CAST(sum(length(text)) AS BIGINT) AS chars FROM chunks GROUP BY doc_id")
def s7_chunk_tables(spark, sf_dir):
    """Chunks of all sources, written by buckets of sources and read again."""
    path = scratch(spark, "chunks")
    io.write_chunks(chunking.chunk_documents(tt.raw_texts(spark, sf_dir), most=500, gap="\\n", ends=".!?"), path, buckets=16)
    return io.read_chunks(spark, path).groupBy("source_name").agg(F.count("*").alias("chunks"), F.sum(F.length("text")).alias("chars"))


@query(f"WITH {tt.FACTS} SELECT location, count(*) AS count, count(DISTINCT chunk_id) AS chunk_count FROM facts GROUP BY location")
def s8_index_as_json(spark, sf_dir):
    path = scratch(spark, "index")
    io.write_table(indexes.counts(indexes.postings(_entries(spark, sf_dir, "locations"), ("location",)), ("location",)).select("location", "count", "chunk_count"), path, "json")
    return spark.read.schema("location string, count bigint, chunk_count bigint").json(path)


@query("SELECT '| ' || p_name || ' | is | ' || p_type || ' | ' || CAST(count(*) AS VARCHAR) || ' | ' || min(p_brand) || ' |' AS line FROM part GROUP BY p_name, p_type")
def s9_rendered_text(spark, sf_dir):
    rows = tt.table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("subject"), F.lit("is").alias("predicate"), F.col("p_type").alias("object")).agg(F.count("*").alias("n"), F.min("p_brand").alias("first_chunk"))
    path = scratch(spark, "texts")
    io.write_texts(graph.markdown_rows(rows), "line", path, "line")
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("""SELECT event_id % 10 <> 3 AS good, CASE WHEN event_id % 10 = 3 THEN '{"id": ' || CAST(event_id AS VARCHAR) ELSE event_type END AS what FROM events WHERE event_id % 10 <> 4""")
def s5_json_lines(spark, sf_dir):
    """Events as JSON lines: every tenth is cut off, every tenth blank."""
    e = tt.table(spark, sf_dir, "events")
    cut = F.concat(F.lit('{"id": '), F.col("event_id").cast("string"))
    line = F.when(F.col("event_id") % 10 == 3, cut).when(F.col("event_id") % 10 == 4, " ").otherwise(F.concat(cut, F.lit(', "kind": "'), "event_type", F.lit('"}')))
    path = scratch(spark, "lines")
    e.select(line.alias("value")).write.text(path)
    good, bad = io.read_jsonl(spark, path, "id long, kind string")
    return good.select(F.lit(True).alias("good"), F.col("kind").alias("what")).unionByName(bad.select(F.lit(False), F.col("line")).toDF("good", "what"))


@query("""SELECT row_number() OVER (ORDER BY event_id) AS line_no, CASE WHEN event_id % 10 = 4 THEN '' ELSE CAST(event_id AS VARCHAR) || ' ' || event_type END AS line FROM events""")
def s5_line_numbers(spark, sf_dir):
    """Events in order as lines (every tenth is blank), in files that are each read by ranges; a line's number in the whole table is
    its number in its file and the lines of the files before."""
    from loretable.sources.lines import read_lines

    e, path = tt.table(spark, sf_dir, "events"), scratch(spark, "ordered")
    text = F.when(F.col("event_id") % 10 == 4, "").otherwise(F.concat_ws(" ", F.col("event_id").cast("string"), "event_type"))
    e.select("event_id", text.alias("value")).repartitionByRange(3, "event_id").sortWithinPartitions("event_id").select("value").write.text(path)
    at = scratch(spark, "numbered")
    read_lines(spark, path).write.parquet(at)
    lines = spark.read.parquet(at)
    per = lines.groupBy("file").agg(F.max("line_no").alias("n"))
    before = per.select("file", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return lines.join(before, "file").select((F.col("before") + F.col("line_no")).alias("line_no"), "line")


#: Encodings of documents' texts by doc_id: two of UTF-8, one of GB 18030, one that neither can read in full.
ENCODED = ("CASE WHEN doc_id % 4 < 2 THEN 'utf-8-sig' ELSE 'gb18030' END", "CASE doc_id % 4 WHEN 3 THEN chr(65533) ELSE '' END")


@query(f"""WITH l AS (SELECT doc_id, text, string_split(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)) AS p FROM documents WHERE text IS NOT NULL)
SELECT {ENCODED[0]} AS encoding, CAST(doc_id AS VARCHAR) || ' é ' || md5(string_agg(line, chr(10) ORDER BY k)) || {ENCODED[1]} AS line FROM (SELECT doc_id, unnest(range(1, len(p) + 1)) AS k, unnest(p) AS line FROM l) x GROUP BY doc_id""")
def s1_text_files(spark, sf_dir):
    """Documents as text files of four encodings (UTF-8 with \\n and with \\r\\n, GB 18030, and that with a byte that no character has),
    read back in pieces; each document is a line of its number, an accent and a digest of its lines."""
    docs = tt.table(spark, sf_dir, "documents").where("text is not null")
    line = F.concat(F.col("doc_id").cast("string"), F.lit(" é "), F.md5(F.regexp_replace("text", "\r\n?", "\n")))
    rows = docs.select("doc_id", line.alias("line"))
    path = scratch(spark, "files")
    for kind in range(4):
        part = rows.where(F.col("doc_id") % 4 == kind)
        out = part.select(io.encoded(F.col("line"), "utf-8" if kind < 2 else "gb18030", b"\xff" if kind == 3 else b"").alias("value"))
        out.write.option("lineSep", "\r\n" if kind == 1 else "\n").text(f"{path}/kind={kind}")
    pieces = io.read_pieces(spark, path)
    return pieces.select("encoding", F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")


@query("SELECT trim(p_brand) AS alias, min(p_name) AS canonical FROM part GROUP BY p_brand")
def s6_alias_maps(spark, sf_dir):
    """Alias objects, one per brand, with blanks around and keys of metadata."""
    rows = tt.table(spark, sf_dir, "part").groupBy("p_brand").agg(F.min("p_name").alias("name"))
    made = rows.select(F.to_json(F.map_from_arrays(F.array(F.concat(F.lit(" "), "p_brand"), F.lit("_asset_layer"), F.lit("blank")), F.array(F.concat("name", F.lit("  ")), F.lit("x"), F.lit(" ")))).alias("json"))
    return al.mapping_rows(made)
