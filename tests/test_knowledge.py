import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loretable.operators import aliases as al
from loretable.operators import audit, context, graph, indexes, lookup, merge, recall
from loretable.operators import characters as ch
from loretable.schemas import CANON, STYLE

RECORDS = [
    ("b_0001", "先", [(" 安洁 ", "走", "喜、怒"), ("安洁", "", "喜，"), ("杜", "走", "")], [("战", "因", "果")], ["城", "城", " "], ["夜"], [("安洁", "杜", "打"), ("杜", "安洁", "骂")]),
    ("b_0002", "后", [("安洁莉特", "飞", None), ("杜", "走", "怒"), ("", "x", "y")], [("战", "", "果"), ("会", "因", "")], ["山"], [], [("杜", "杜", "想"), ("安洁莉特", "杜", "")]),
    ("b_0003", None, [], [], [], [], []),
]


def canon(spark):
    return spark.createDataFrame(RECORDS, CANON)


def style(spark):
    return spark.createDataFrame([("b_0002", "淡", "高", [], [("杜", "你好", "b_0002"), ("杜", "再见", "b_0002")], ["热血", "热血"]), ("b_0009", "", "低", ["x"], [], [])], STYLE)


def test_indexes(spark):
    got = {r.name: r for r in indexes.index(canon(spark), "characters").collect()}
    assert (got["安洁"]["count"], got["安洁"].chunks, got["安洁"].actions, got["安洁"].emotions) == (2, ["b_0001"], ["走"], ["喜、怒", "喜，"])
    assert (got["杜"]["count"], got["杜"].chunks, got["杜"].actions, got["杜"].emotions) == (2, ["b_0001", "b_0002"], ["走"], ["怒"])
    assert {r.location: r["count"] for r in indexes.index(canon(spark), "locations").collect()} == {"城": 2, "山": 1}
    events = {r.event: r for r in indexes.index(canon(spark), "events").collect()}
    assert events["战"].causes == ["因"] and events["战"].results == ["果"] and events["会"].results == []
    pairs = {(r.person_a, r.person_b): (r["count"], r.interactions) for r in indexes.index(canon(spark), "relationships").collect()}
    assert pairs == {("安洁", "杜"): (2, ["打", "骂"]), ("杜", "杜"): (1, ["想"]), ("安洁莉特", "杜"): (1, [])}
    hist = {(r.dimension, r.value): r["count"] for r in indexes.style_histogram(style(spark)).collect()}
    assert hist == {("style_tag", "热血"): 2, ("narration_tone", "淡"): 1, ("dialogue_density", "高"): 1, ("dialogue_density", "低"): 1, ("total", "records"): 2}
    ranks = lookup.entity_list(indexes.index(canon(spark), "characters"), "name").orderBy("rank").collect()
    assert [(r.rank, r.entity) for r in ranks] == [(1, "安洁"), (2, "杜"), (3, "安洁莉特")]


def kb(spark):
    c = canon(spark).withColumns({"source_file": F.lit("b.txt"), "chapter_hint": F.lit("一"), "char_start": F.lit(0), "char_end": F.lit(9)})
    return merge.master(c, style(spark).withColumn("source_file", F.lit("s.txt")))


def test_master(spark):
    got = {r.chunk_id: r for r in kb(spark).collect()}
    assert set(got) == {"b_0001", "b_0002", "b_0003", "b_0009"}
    assert got["b_0009"].source_file == "s.txt" and got["b_0009"].chapter_hint == "" and got["b_0009"].char_start is None and got["b_0009"].canon is None
    assert got["b_0002"].source_file == "b.txt" and got["b_0002"].style.narration_tone == "淡"
    assert tuple(merge.header(kb(spark)).first()) == (4, 3, 2)
    text = {r.chunk_id: r.markdown for r in merge.chunk_markdown(kb(spark)).collect()}
    assert "**摘要**：先" in text["b_0001"] and "- 杜：走（）" in text["b_0001"] and "**风格**：语气：淡 | 对话密度：高 | 标签：热血 / 热血" in text["b_0002"]
    assert text["b_0003"].split("\n")[:2] == ["## [b_0003] 一", "**位置**：字符 0–9"]


NAMES = {"安洁": 39, "安洁莉特": 100, "李": 5, "李四": 10, "李四光": 4, "四光": 2, "王五": 20, "王五王": 40, "赵六": 1, "赵六七": 0, "a" * 70: 30, "a" * 5: 6, "bbb": 8, "bb": 3}


def plain_pairs(names):
    return {(a, b) for a in names for b in names if len(a) >= 2 and a != b and a in b and names[b] > 0}


def test_alias_candidates(spark):
    rows = al.classified(al.containment(spark.createDataFrame(list(NAMES.items()), "name string, count long"))).collect()
    assert {(r.alias, r.canonical_candidate) for r in rows} == plain_pairs(NAMES)
    rule = {(r.alias, r.canonical_candidate): (r.rule, r.confidence, r.auto_accept) for r in rows}
    assert rule["安洁", "安洁莉特"] == ("substring_auto", "high", True)
    assert rule["王五", "王五王"][0] == "freq_close_skip" and rule["李四", "李四光"][0] == "freq_close_skip"
    assert rule["四光", "李四光"][0] == "freq_close_skip" and rule["bb", "bbb"] == ("substring_review", "medium", False)
    reason = {r.alias: r.reason for r in rows}
    assert reason["安洁"] == "子串简称，频率差显著(ratio=0.39)，canonical出现100次" and reason["bb"] == "需人工确认：canonical低频(8次)"


def test_containment_equals_all_pairs(spark):
    rng = random.Random(2)
    names = {"".join(rng.choice("甲乙丙") for _ in range(rng.randint(1, 7))): rng.randint(0, 30) for _ in range(150)}
    for longest in (64, 4):
        got = {(r.alias, r.canonical_candidate) for r in al.containment(spark.createDataFrame(list(names.items()), "name string, count long"), longest).collect()}
        assert got == plain_pairs(names)


@pytest.mark.parametrize(("a", "c", "rule"), [(40, 100, "substring_review"), (39, 100, "substring_auto"), (50, 100, "freq_close_skip"), (1, 9, "substring_review"), (1, 5, "substring_review"), (1, 4, "substring_weak"), (3, 10, "substring_auto"), (4, 9, "substring_weak")])
def test_alias_thresholds(spark, a, c, rule):
    assert al.classified(spark.createDataFrame([("ab", "abc", a, c)], "alias string, canonical_candidate string, alias_count long, canonical_count long")).first().rule == rule


def mapping(spark, rows):
    return spark.createDataFrame(rows, "alias string, canonical string")


def test_alias_layers(spark):
    blocked = al.unordered(spark.createDataFrame([("乙全", "乙"), (" ", "x")], "a string, b string"))
    auto, confirmed = mapping(spark, [("甲", "甲一"), ("乙", "乙二"), ("丙", "丙一")]), mapping(spark, [("甲", "甲全"), ("乙", "乙全")])
    got = {r.alias: (r.canonical, r.alias_source) for r in al.fact_aliases(confirmed, auto, blocked).collect()}
    assert got == {"甲": ("甲全", "confirmed"), "乙": ("乙二", "auto"), "丙": ("丙一", "auto")}
    q = al.query_aliases(mapping(spark, [("丙", "丙昵")]), confirmed, auto, blocked)
    assert {r.alias: r.alias_source for r in q.collect()} == {"甲": "confirmed", "乙": "auto", "丙": "nickname"}
    objects = spark.createDataFrame([('{"_asset_layer": "x", " a ": " b", "c": " ", "": "d"}',)], "json string")
    assert [tuple(r) for r in al.mapping_rows(objects).collect()] == [("a", "b")]
    two = al.classified(spark.createDataFrame([("安洁", "安洁甲", 1, 50), ("安洁", "安洁乙乙", 1, 50), ("安洁", "安洁", 1, 9)], "alias string, canonical_candidate string, alias_count long, canonical_count long"))
    assert [tuple(r) for r in al.alias_map(two).collect()] == [("安洁", "安洁乙乙")]


def facts(spark):
    return ch.appearances(kb(spark), spark.createDataFrame([("安洁", "安洁莉特", "auto")], "alias string, canonical string, alias_source string"))


def test_appearances_and_profiles(spark):
    rows = facts(spark)
    assert Counter(r.alias_source for r in rows.collect()) == {"auto": 2, "identity": 3}
    p = {r.canonical_name: r for r in ch.profiles(rows).collect()}
    a = p["安洁莉特"]
    assert (a.mention_count, a.aliases, a.first_chunk, a.last_chunk, a.chunk_ids, a.top_actions, a.top_emotions) == (3, ["安洁"], "b_0001", "b_0002", ["b_0001", "b_0002"], ["走", "飞"], ["喜", "怒"])
    assert p["杜"].top_emotions == ["怒"] and p["杜"].aliases == []
    many = spark.createDataFrame([("n", f"c{i:02d}", 0, f"a{i % 25:02d}", None) for i in range(60)], "canonical_name string, chunk_id string, pos int, action string, emotion string")
    top = [r.value for r in ch.top_values(many, "action").orderBy("rank").collect()]
    assert top == [f"a{i:02d}" for i in range(20)]
    assert ch.encoding_check(spark.createDataFrame([("abc",), ("字",)], "canonical_name string")).first().looks_right


def test_resolution_order(spark):
    counts = spark.createDataFrame([("甲", 5), ("乙", 9), ("丙", 1)], "canonical_name string, mention_count long")
    observed = spark.createDataFrame([("甲", "小"), ("乙", "小"), ("丙", "甲")], "canonical_name string, alias string")
    nick = mapping(spark, [("昵", "丙"), ("空", "无"), ("小", "丙")])
    asked = spark.createDataFrame([(" 甲 ",), ("小",), ("昵",), ("空",), ("",), ("谁",)], "query string")
    got = {r["query"]: (r.matched, r.canonical_name, r.match_type) for r in lookup.resolve(asked, counts, observed, nick).collect()}
    none = (False, None, None)
    assert got == {" 甲 ": (True, "甲", "canonical"), "小": (True, "乙", "observed_alias"), "昵": (True, "丙", "query_alias"), "空": none, "": none, "谁": none}


def test_candidates_and_search(spark):
    rel = indexes.mentions(canon(spark), "relationships")
    got = {(r.person, r.related_person): (r.overlap_chunk_count, r.interaction_sample, r.sample_chunk_id) for r in lookup.relationship_candidates(rel).collect()}
    assert got[("杜", "安洁")] == (1, "打", "b_0001") and got[("杜", "杜")] == (1, "想", "b_0002") and got[("安洁莉特", "杜")] == (1, None, "b_0002")
    loose = lookup.loose_relations(rel, spark.createDataFrame([("安洁",)], "query string")).collect()
    assert [(r.chunk_id, r.related_person) for r in loose] == [("b_0002", "安洁莉特")]
    places = lookup.location_candidates(facts(spark), indexes.mentions(canon(spark), "locations"), 1)
    assert {(r.canonical_name, r.location) for r in places.collect()} == {("安洁莉特", "城"), ("杜", "城")}
    assert sorted((r.chunk_id, r.field, r.hit) for r in lookup.search(kb(spark), "杜").collect()) == [("b_0001", "characters", "杜"), ("b_0001", "relationships", "杜, 杜"), ("b_0002", "characters", "杜"), ("b_0002", "relationships", "杜, 杜, 杜")]
    assert lookup.search(kb(spark), "先", "summary").count() == 1
    tagged = lookup.evidence(spark.createDataFrame([("b_0001",), ("b_0002",), (None,)], "chunk_id string"), spark.createDataFrame([("b_0001", "front_matter"), ("b_0002", "story_scene")], "chunk_id string, section_type string"))
    assert sorted(r.evidence for r in tagged.collect()) == sorted(["b_0001 [front_matter]", "b_0002", "（无）"])


def test_contexts_and_prompts(spark):
    f = facts(spark)
    asked = spark.createDataFrame([("安洁",), ("谁",)], "query string")
    resolved = lookup.resolve(asked, ch.profile_counts(f), ch.observed_aliases(f), mapping(spark, [("x", "y")]))
    results = lookup.person_results(resolved, ch.profiles(f), lookup.relationship_candidates(indexes.mentions(canon(spark), "relationships")), lookup.location_candidates(f, indexes.mentions(canon(spark), "locations")), lookup.samples(f, 3))
    assert {r["query"]: '"matched":true' in r.json for r in lookup.json_results(results).collect()} == {"安洁": True, "谁": False}
    tasks = spark.createDataFrame([("安洁", "continue_writing", "dropped"), ("安洁", "rewrite", None), ("谁", "rewrite", "原文 "), ("安洁", "poem", "x")], "query string, mode string, source_text string")
    good, bad = context.validate(tasks)
    assert sorted(r.reason for r in bad.collect()) == ["rewrite needs a source text", "unknown mode"]
    got = {(r["query"], r["mode"]): r.prompt for r in context.prompts(context.contexts(good, results), prefix="  守则 ").collect()}
    assert set(got) == {("安洁", "continue_writing"), ("谁", "rewrite")}
    assert got["安洁", "continue_writing"].startswith("守则\n\n#") and "安洁莉特" in got["安洁", "continue_writing"] and "dropped" not in got["安洁", "continue_writing"]
    assert "no person found" in got["谁", "rewrite"] and "\n原文\n" in got["谁", "rewrite"]
    assert context.prompts(context.contexts(good, results), prefix=" ").first().prompt.startswith("#")
    cards = {r["query"]: r.card for r in lookup.person_card(results).collect()}
    assert "mention_count: 3" in cards["安洁"] and lookup.NO_MATCH_NOTE in cards["谁"]


def test_recall(spark):
    chunks = spark.createDataFrame([("1", "安洁莉特和安洁，安洁"), ("2", "杜"), ("3", None)], "chunk_id string, text string")
    terms = spark.createDataFrame([("安洁",), ("安洁莉特",), (" ",), ("杜",), (None,)], "term string")
    for most in (100, 1):
        found = recall.mentions_in_text(chunks, terms, most)
        assert {(r.chunk_id, r.term, r.pos, r.n) for r in found.collect()} == {("1", "安洁莉特", 0, 1), ("1", "安洁", 0, 3), ("2", "杜", 0, 1)}
    repeated = recall.mentions_in_text(spark.createDataFrame([("1", "aaaaa")], "chunk_id string, text string"), spark.createDataFrame([("aa",), ("aaa",)], "term string"))
    assert {(r.term, r.pos, r.n) for r in repeated.collect()} == {("aa", 0, 2), ("aaa", 0, 1)}
    known = spark.createDataFrame([("安洁莉特", "1")], "entity string, chunk_id string")
    new = recall.recall_rounds(chunks, terms, mapping(spark, [("安洁", "安洁莉特")]), known)
    assert [(r.entity, r.chunk_id) for r in new.collect()] == [("杜", "2")]
    gate = recall.exit_gate(spark.createDataFrame([("a", "b", ["1"]), ("a", "c", []), ("b", "d", ["1"])], "alias string, canonical string, evidence array<string>"), mapping(spark, [("b", "e")]))
    assert {(r.problem, r.alias) for r in gate.collect()} == {("several_canonicals", "a"), ("no_evidence", "a"), ("against_confirmed", "b"), ("chain", "a")}
    assert recall.evidence_chunks(new).first().evidence == ["2"]


def test_graph_and_risk(spark, tmp_path):
    t = graph.triples(facts(spark), indexes.mentions(canon(spark), "locations"), indexes.mentions(canon(spark), "relationships"))
    got = {(r.subject, r.predicate, r.object): (r.n, r.evidence) for r in t.collect()}
    assert got["安洁莉特", "appears_in", "b_0001"] == (2, ["b_0001"]) and got["杜", "appears_at", "城"][0] == 1 and got["安洁", "interacts_with", "杜"] == (2, ["b_0001"])
    graph.write_triples(t, str(tmp_path / "t"))
    assert spark.read.option("header", True).csv(str(tmp_path / "t")).count() == t.count()
    assert graph.markdown_rows(t).where("line like '| 杜 | appears_at | 城 | 1 | b_0001 |'").count() == 1
    line = graph.timeline(canon(spark).withColumn("source_file", F.lit("b"))).orderBy("place").collect()
    assert [(r.kind, r.text) for r in line] == [("time", "夜"), ("event", "战"), ("event", "战"), ("event", "会")]
    assert {r.chunk_id: r.level for r in graph.risk_levels(canon(spark).withColumn("source_file", F.lit("b"))).collect()} == {"b_0001": "L1", "b_0002": "L1", "b_0003": "L1"}


def test_audits(spark):
    findings = spark.createDataFrame([("ok", "high", "x"), ("ok", "high", " "), ("odd", "low", "x"), (None, "low", "x")], "label string, severity string, evidence string")
    assert [r.problem for r in audit.checked_findings(findings, ["ok"]).collect()] == [None, "no evidence", "unknown label", "unknown label"]
    reviews = spark.createDataFrame([("a", "b", "a", ["t"], []), ("a", "c", "c", [], ["u"]), ("b", "c", None, [], [])], "candidate_a string, candidate_b string, winner string, tags_a array<string>, tags_b array<string>")
    pairs, rates = audit.preferences(reviews)
    assert {(r.winner, r.loser) for r in pairs.collect()} == {("a", "b"), ("c", "a")}
    assert {r.candidate: (r.compared, r.wins, r.losses, r.win_rate) for r in rates.collect()} == {"a": (2, 1, 1, 0.5), "b": (2, 0, 1, 0.0), "c": (2, 1, 0, 0.5)}
    fields = spark.createDataFrame([("p", "name", ""), ("p", "age", "NULL"), ("p", "job", "cook"), ("p", "home", "城"), ("p", "key", "k")], "character string, field string, value string")
    proof = spark.createDataFrame([("p", "home", "1"), ("p", "key", "1"), ("p", "job", "9")], "character string, field string, chunk_id string")
    got = {(r.field, r.problem) for r in audit.package_audit(fields, proof, spark.createDataFrame([("1",)], "chunk_id string"), ("key",)).collect()}
    assert got == {("name", "no name"), ("age", "placeholder"), ("job", "no evidence"), ("job", "evidence chunk missing"), ("key", "one evidence")}
    chunks = spark.createDataFrame([("b_0001", "安洁走进城"), ("b_0002", "杜说你好")], "chunk_id string, text string")
    rows = audit.grounding(canon(spark), style(spark), chunks)
    seen = {(r.chunk_id, r.kind, r.item): (r.grounded, r.notice) for r in rows.collect()}
    assert seen["b_0001", "character", "安洁"] == (True, None) and seen["b_0002", "location", "山"] == (False, None) and seen["b_0002", "dialogue", "再见"] == (False, None) and seen["b_0001", "summary", "先"] == (None, "short")
