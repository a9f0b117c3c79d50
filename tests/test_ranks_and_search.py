import random

import pytest
from pyspark.sql import functions as F

from loretable.operators import aliases, gates, lookup, ranks, search_index


@pytest.mark.parametrize("task_rows", [7, 100, 10_000])
def test_places_equal_a_window(spark, task_rows):
    rng = random.Random(task_rows)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(40), f"k{i}") for i in range(300)] + [("one", 1, "k")]
    frame = spark.createDataFrame(rows, "g string, n int, k string")
    got = {(r.g, r.k): (r.p, r.total) for r in ranks.placed(frame, ["g"], [F.desc("n"), "k"], "p", "total", task_rows).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        want |= {(g, r[2]): (i, len(mine)) for i, r in enumerate(mine, 1)}
    assert got == want
    assert ranks.placed(frame.limit(0), ["g"], ["n"]).count() == 0


def test_one_group_is_dealt_to_many_tasks(spark):
    frame = spark.range(5000).select(F.lit("all").alias("g"), F.col("id"))
    placed = ranks.placed(frame, ["g"], [F.desc("id")], task_rows=500)
    assert placed.where("place + id <> 5000").count() == 0
    largest = placed.groupBy(F.floor((F.col("place") - 1) / 500)).count().agg(F.max("count")).first()[0]
    assert largest == 500


def test_pages_equal_a_sorted_list(spark):
    rng = random.Random(1)
    keys = [None] * 3 + [f"k{rng.randrange(3000):05d}" for _ in range(4000)] + ["same"] * 900
    frame = spark.createDataFrame([(k,) for k in keys], "chunk_id string").repartition(4)
    order = sorted(keys, key=lambda k: (k is not None, k or ""))
    for offset, limit in [(0, 10), (1, 5), (2500, 100), (3990, 30), (4895, 50), (4903, 1), (9000, 10), (4700, None), (0, 0)]:
        got = [r.chunk_id for r in ranks.page(frame, offset, limit, most=50).collect()]
        assert got == order[offset : None if limit is None else offset + limit], (offset, limit)
    plan = ranks.page(frame, 2500, 100, most=50)._jdf.queryExecution().optimizedPlan().toString()
    assert ">= k" in plan and "< k" in plan
    unique = frame.where("chunk_id is not null").distinct()
    first = [r.chunk_id for r in gates.page_after(unique, None, 7).collect()]
    second = [r.chunk_id for r in gates.page_after(unique, first[-1], 7).collect()]
    assert first + second == sorted({k for k in keys if k})[:14]
    assert ranks.page(frame.limit(0), 3, 4).count() == 0


def test_containment_is_linear_in_the_length_of_names(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("甲乙丙丁戊己庚辛") for _ in range(10_000))
    names = [(long, 5), (long[3000:3400], 2), (long[77:80], 1), (long[:2], 1), ("甲", 9), ("不在", 4), (long[9:14] + "壬", 3)]
    got = {(r.alias, r.canonical_candidate) for r in aliases.containment(spark.createDataFrame(names, "name string, count long")).collect()}
    want = {(a, b) for a, _ in names for b, n in names if len(a) >= 2 and a != b and a in b and n > 0}
    assert got == want and (long[3000:3400], long) in got
    spread = spark.createDataFrame(names[:1], "name string, count long").select(F.size(F.flatten(F.array(*[aliases.grams(F.col("name"), k) for k in (2, 3)]))).alias("n")).first().n
    assert spread <= 2 * len(long)


KB = "chunk_id string, chapter_hint string, char_start long, char_end long, canon struct<summary:string,characters:array<struct<name:string,action:string,emotion:string>>,events:array<struct<event:string,cause:string,result:string>>,locations:array<string>,time_markers:array<string>,relationships:array<struct<person_a:string,person_b:string,interaction:string>>>"


def test_index_search_equals_a_scan_for_each_keyword(spark, tmp_path):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("甲乙丙ab ") for _ in range(rng.randrange(0, 9)))
    maybe = lambda f: None if rng.random() < 0.1 else f()
    some = lambda f: [f() for _ in range(rng.randrange(4))]
    three = lambda: (maybe(word), maybe(word), maybe(word))
    rows = [(f"c{i}", maybe(word), i, i + 1, maybe(lambda: (maybe(word), maybe(lambda: some(three)), some(three), some(lambda: maybe(word)), some(word), some(three)))) for i in range(60)]
    kb = spark.createDataFrame(rows, KB)
    index = search_index.SearchIndex(spark, str(tmp_path / "i"), buckets=8).build(kb)
    keywords = ["甲乙丙", "ab", "a", "乙a甲", "bbb", "c5", "c59", "没有这个"]
    asked = spark.createDataFrame([(k,) for k in [*keywords, "", None, "a"]], "keyword string")
    columns = ["chunk_id", "chapter_hint", "char_start", "char_end", "field", "hit"]
    got = sorted(map(str, index.search(asked).select("keyword", *columns).collect()))
    want = [str(r) for k in keywords for r in lookup.search(kb, k).select(F.lit(k).alias("keyword"), *columns).collect()]
    assert got == sorted(want) and len(want) > 20
    one = spark.createDataFrame([("甲乙", "locations"), ("c5", "chunk_id")], "keyword string, field string")
    want = [str(r) for k, f in (("甲乙", "locations"), ("c5", "chunk_id")) for r in lookup.search(kb, k, f).select(F.lit(k).alias("keyword"), *columns).collect()]
    assert sorted(map(str, index.search(one).select("keyword", *columns).collect())) == sorted(want)


def test_only_asked_buckets_of_postings_are_read(spark, tmp_path):
    kb = spark.createDataFrame([(f"c{i}", f"title number {i}", 0, 1, None) for i in range(50)], KB)
    index = search_index.SearchIndex(spark, str(tmp_path / "i"), buckets=16).build(kb)
    asked = spark.createDataFrame([("titl",)], "keyword string").select("keyword", F.lit(None).cast("string").alias("field"), search_index.grams(F.col("keyword"), 3).alias("grams"))
    found = index.postings(asked)
    assert found.count() == 50
    filters = found._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert "bucket" in filters and len([d for d in (tmp_path / "i/postings").glob("bucket=*")]) > 2


def test_a_text_in_all_chunks_is_posted_once(spark, tmp_path):
    kb = spark.createDataFrame([(f"c{i}", "same title", 0, 1, None) for i in range(50)], KB)
    search_index.SearchIndex(spark, str(tmp_path / "i"), buckets=4).build(kb)
    assert spark.read.parquet(str(tmp_path / "i/postings")).where("gram = 'tit'").count() == 1
