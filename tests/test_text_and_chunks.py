import random
import re

import pytest
from pyspark.sql import functions as F

from loretable.functions import text as tx
from loretable.operators import chunking, gates, sections


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t")).alias("x")).first().x


def test_text_helpers(spark):
    assert one(spark, tx.strip, "　 a b\t\n ") == "a b"
    assert one(spark, tx.lines, "a\n\n  b \r\n\x0bc") == ["a", "b", "c"]
    assert one(spark, tx.is_blank, " 　") and one(spark, tx.is_blank, None)
    rows = spark.createDataFrame([(0.125,), (2.0,), (0.375,), (1 / 3,)], "x double").select(tx.two_decimals(F.col("x")).alias("t")).collect()
    assert [r.t for r in rows] == ["0.12", "2.00", "0.38", "0.33"]


NOVEL = "开头的话。\n\n第一章 初见\n\n" + "他走了。" * 40 + "\n\n" + "她说：好！" * 30 + "\r\n第二章 再会\n短。\n\n\n" + "长" * 130 + "\n\n　　末段。\n番外 一个很长的标题" + "字" * 60 + "\n\n内容"


def raw(spark, text, name="book"):
    return spark.createDataFrame([(name, f"{name}.txt", "utf-8", text)], "source_name string, source_file string, encoding string, text string")


@pytest.mark.parametrize("most", [10, 50, 130, 131, 4900])
def test_chunks_keep_text_and_limits(spark, most):
    text = NOVEL.replace("\r\n", "\n")
    got = chunking.chunk_documents(raw(spark, text), most).orderBy("chunk_idx").collect()
    assert [r.chunk_idx for r in got] == list(range(1, len(got) + 1)) and got[0].chunk_id == "book_0001"
    assert all(0 < len(r.text) <= most for r in got)
    squeeze = lambda s: re.sub(r"\s", "", s)
    assert squeeze("".join(r.text for r in got)) == squeeze(text)
    assert all(r.char_end - r.char_start == len(r.text) for r in got)
    if most > 60:
        assert all(text[r.char_start : r.char_end] == r.text for r in got if text.count(r.text[:50]) == 1 and "\n" not in r.text)


def test_hints_and_numbers(spark):
    text = NOVEL.replace("\r\n", "\n")
    hints = [r.chapter_hint for r in chunking.chunk_documents(raw(spark, text)).orderBy("chunk_idx").collect()]
    assert hints == ["前言", "第一章 初见", "第二章 再会", ("番外 一个很长的标题" + "字" * 60)[:40]]
    assert [r.hint for r in chunking.sections(raw(spark, text)).orderBy("section").collect()] == hints
    plain = chunking.chunk_documents(raw(spark, "没有标题\n\n第二段 第三章"))
    assert [(r.chapter_hint, r.text) for r in plain.collect()] == [("正文", "没有标题\n第二段 第三章")]
    assert chunking.chunk_documents(raw(spark, None)).count() == 0 and chunking.chunk_documents(raw(spark, " \n ")).count() == 0


def test_chunks_through_sql(spark):
    text = NOVEL.replace("\r\n", "\n")
    chunking.register_sql(spark)
    raw(spark, text).unionByName(raw(spark, None, "none")).createOrReplaceTempView("novels")
    got = spark.sql("SELECT c.* FROM novels n, LATERAL chunk_text(n.text, 50) c ORDER BY c.chunk_idx").collect()
    want = chunking.chunk_documents(raw(spark, text), 50).orderBy("chunk_idx").select("chunk_idx", "chapter_hint", "char_start", "char_end", "text").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want] and len(got) > 5


def test_packing_rules():
    assert chunking.packed_sentences("一。二！三", 4) == ["一。二！", "三"]
    assert chunking.packed_sentences("abcdefghij。k", 4) == ["abcd", "efgh", "ij。k"]
    assert chunking.packed_sentences("……", 1) == ["…", "…"]
    assert chunking.packed_paragraphs(["aa", "bb", "ccc"], 5) == ["aa\nbb", "ccc"]
    assert chunking.packed_paragraphs(["abcde"], 5) == ["abcde"]
    assert chunking.packed_paragraphs(["x", "abcdef", "y"], 5) == ["x", "abcde", "f", "y"]
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("ab。！") for _ in range(rng.randint(0, 40)))
        parts = chunking.packed_sentences(text, 7)
        assert "".join(parts) == text and all(len(p) <= 7 for p in parts)


def test_repeated_openings_and_misses():
    text = "x" * 60 + "y" + "x" * 60 + "z"
    assert chunking.located(text, ["x" * 60 + "y", "x" * 60 + "z"]) == [(0, 61), (0, 61)]
    assert chunking.located("abc", ["abc", "nowhere"]) == [(0, 3), (3, 10)]


def test_limits_and_summary(spark):
    rows = raw(spark, "a\nb\nc")
    assert chunking.limited(rows, limit_lines=2).first().text == "a\nb\n"
    assert chunking.limited(rows, limit_chars=3).first().text == "a\nb"
    with pytest.raises(ValueError):
        chunking.limited(rows, 1, 1)
    r = chunking.run_summary(rows, chunking.chunk_documents(rows)).first()
    assert (r.total_chars, r.chunk_count, r.first_chunk, r.last_chunk) == (5, 1, "book_0001", "book_0001")


def test_gate(spark):
    cases = {"a": "字" * 199, "b": "字" * 200, "c": "第三幕 " + "字" * 300, "d": "第三幕\n" + "字" * 300, "e": "第三幕\n一行\n" + "字" * 300, "f": "开头\n第三幕 " + "字" * 300, "g": None, "h": "　" + "字" * 199 + " "}
    got = {r.chunk_id: r.structural_reason for r in gates.gated(spark.createDataFrame(list(cases.items()), "chunk_id string, text string")).collect()}
    assert got["a"] == got["h"] == "too_short (199 chars < 200)" and got["g"] == "too_short (0 chars < 200)"
    assert got["b"] is None and got["e"] is None and got["f"] is None
    assert got["c"].startswith("title_pattern (1 lines") and got["d"] == "title_pattern (2 lines, first='第三幕')"


def test_resume(spark):
    chunks = spark.createDataFrame([("1", "x"), ("2", "x"), ("3", " "), ("4", "x")], "chunk_id string, text string")
    log = spark.createDataFrame([("1", "success"), ("1", "failed"), ("2", "failed"), ("9", "structural_chunk")], "chunk_id string, status string")
    assert sorted(r.chunk_id for r in gates.pending(chunks, log).collect()) == ["2", "4"]
    assert [r.chunk_id for r in gates.page(chunks, 1, 2).collect()] == ["2", "3"]
    assert tuple(gates.run_summary(chunks, log, log).first()) == (4, 2, 1, 2, 1, 4)
    state, structural, bad = gates.log_rows(spark.createDataFrame([("1", "failed", "why", 3, "r" * 3000), ("2", "structural_chunk", "short", 1, None)], "chunk_id string, status string, reason string, char_count int, raw string"))
    assert state.count() == 2 and structural.count() == 1 and len(bad.first().raw_response) == 2000


def test_section_scan(spark):
    story = "他走着，看着她，心想。" * 40
    texts = {
        "kw": "作者按：感谢读者 求票\n" + story, "late": "字" * 500 + "作者按" + story, "two": "版权 作者注", "lists": "\n".join(f"{i}. 规则" for i in range(6)), "five": "\n".join(f"{i}. 规则" for i in range(5)),
        "bare": "这里是说明" * 80, "spoken": "这里是说明" * 80 + "他说：好", "story": story, "canon": "实验记录", "none": None,
    }
    canon = spark.createDataFrame([("canon", [], []), ("kw", [], ["x"])], "chunk_id string, events array<string>, characters array<string>")
    got = {r.chunk_id: (r.suggested_type, r.confidence, r.reasons) for r in sections.scan(spark.createDataFrame(list(texts.items()), "chunk_id string, text string"), canon).collect()}
    assert got["kw"] == ("author_meta", "high", ["关键词命中: 作者按, 感谢读者, 求票", "canon 输出无事件"])
    assert got["two"][0] == "author_meta" and got["two"][1] == "uncertain"
    assert got["lists"] == ("setting_exposition", "uncertain", ["编号列表占比 6/6"])
    assert got["bare"][2] == ["无对话标记且叙事动词不足"] and got["canon"] == ("in_universe_document", "high", ["关键词命中: 实验记录", "canon 输出无事件且无角色"])
    assert set(got) == {"kw", "two", "lists", "bare", "canon"}


def test_labels(spark):
    entries = spark.createDataFrame([(1, "a", "author_meta", None), (2, "a", "", "front_matter"), (3, "b", "story_scene", None), (4, None, "author_meta", None), (5, "c", "odd", None), (6, "z", "author_meta", None), (7, "b", None, None)], "line_no long, chunk_id string, suggested_type string, section_type string")
    good, bad = sections.validated_labels(entries)
    assert sorted(r.line_no for r in good.collect()) == [1, 2, 6] and sorted(r.line_no for r in bad.collect()) == [4, 5, 7]
    chunks = spark.createDataFrame([("a",), ("b",)], "chunk_id string")
    labelled, unknown = sections.apply_labels(chunks, good)
    assert {r.chunk_id: r.section_type for r in labelled.collect()} == {"a": "front_matter", "b": None}
    assert tuple(sections.apply_log(entries, good, unknown, bad).first()) == (7, 2, 1, 1, 3)
    assert {r.section_type: r["count"] for r in sections.verify(labelled).collect()} == {"front_matter": 1, "story_scene": 1}
