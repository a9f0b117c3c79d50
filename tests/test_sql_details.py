"""Details in which engines differ, against the SQL."""

import os

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as entry
from loretable.functions import text as tx
from oracle import TABLES, difference


def test_two_decimals_equal_the_sql(spark):
    pairs = [(a, b) for a in range(1, 200) for b in (3, 7, 8, 16, 40, 125, 200)] + [(254214, 48), (1901315, 8), (2789661, 8), (10**12, 7)]
    got = spark.createDataFrame(pairs, "a long, b long").select(tx.two_decimals(F.col("a") / F.col("b")).alias("t")).collect()
    want = [duckdb.execute("SELECT printf('%.2f', round_even(CAST(?::BIGINT / ?::BIGINT AS DECIMAL(38, 18)), 2))", p).fetchone()[0] for p in pairs]
    assert [r.t for r in got] == want
    assert want[-4] == "5296.13"


def test_edges_of_words_are_those_of_the_sql(spark, tmp_path):
    texts = ["x und y " * 2 + "z undöver " + "w" * 300, "x und y " * 2 + "z bundö " + "w" * 300, "é the end", "éthe end", "of theé end"]
    rows = [(i, t, "de", "web", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    for t in set(TABLES) - {"documents"}:
        os.symlink(f"/root/testdata/sf0.001/{t}.parquet", f"{tmp_path}/{t}.parquet")
    for name in ("t1_section_scan", "t5_scan_summary"):
        assert not difference(spark, str(tmp_path), name, entry.queries()[name], entry.oracle_sql()[name])
