"""Records are made in steps that leave little on disk, once for each query."""

from pyspark.sql import functions as F

from loretable.functions import tables
from loretable.operators import indexes, lookup
from loretable.plans import queries as core
from loretable.plans import testtables as tt
from loretable.schemas import CANON
from loretable.sources import io

SF = "/root/testdata/sf0.001"


def test_records_are_made_once_a_query_and_anew_for_the_next(spark, monkeypatch):
    calls, made = [], tt._canon
    monkeypatch.setattr(tt, "_canon", lambda *a: calls.append(a) or made(*a))
    core.QUERIES["q10_person_cards"](spark, SF)
    assert len(calls) == 1
    core.QUERIES["m3_location_index"](spark, SF)
    assert len(calls) == 2


def test_a_step_reads_no_shuffle_and_drops_what_is_over(spark):
    first, at = tables.staged(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "first")
    second, _ = tables.staged(first.groupBy("count").agg(F.count("*").alias("n")), "second", at)
    assert "Exchange" not in second._jdf.queryExecution().executedPlan().toString()
    assert {r["count"]: r.n for r in second.collect()} == {14: 5, 15: 2}
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(at)
    assert not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def test_only_wanted_arrays_are_made(spark):
    rows = spark.createDataFrame([("c1", "", [], [], [], [], [("b", "a", "x"), ("a", "b", "y")])], CANON)
    one = indexes.index(rows, "relationships", of=())
    assert "interactions" not in one.columns and one.first().chunks == ["c1"] and one.first()["count"] == 2


def test_pairs_in_both_orders_count_together(spark):
    rows = spark.createDataFrame([("a", "b", "c1", 0, ""), ("b", "a", "c1", 1, "y"), ("b", "a", "c2", 0, "z"), ("a", "a", "c3", 0, "s")], "person_a string, person_b string, chunk_id string, pos int, interaction string")
    got = lookup.relationship_candidates(rows)
    assert sorted(tuple(r)[:5] for r in got.collect()) == [("a", "a", 1, "s", "c3"), ("a", "b", 2, "y", "c1"), ("b", "a", 2, "y", "c1")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate")  # pairs are mirrored above the counts, not before them


def test_many_small_files_are_read_by_few_tasks(spark, tmp_path):
    for i in range(150):
        (tmp_path / f"r{i}.json").write_text(f'{{"chunk_id": "c{i}"}}' if i % 3 else "{")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5m")  # two files a task, as for a folder that is larger than this one
    try:
        good, bad = io.load_records(spark, str(tmp_path), "chunk_id string")
        assert bad.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
        assert good.count() == 100 and bad.count() == 50
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
