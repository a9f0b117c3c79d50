"""Keyword search by an index: for many keywords at once, without a scan of the knowledge base for each.

Every text that can be searched is an item; items lie in folders by a bucket of their text. Most texts stand there many
times (names, places), so only distinct texts are looked at: the posting table says which of them hold which three
characters, in folders by a bucket of the three. A keyword's texts hold all of its grams, so only the buckets of those
are read, what is in all of their postings is a candidate, and the texts of the candidates' items decide. Keywords of
less than three characters have no gram: for those the distinct texts are scanned, once for all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loretable.functions.tables import scratch
from loretable.functions.text import grams
from loretable.operators.lookup import HIT_CHARS, SEARCHED

GRAM, BUCKETS = 3, 64
ITEM = "array<struct<field:string,place:int,text:string>>"


def bucket(c: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


def items(kb: DataFrame) -> DataFrame:
    """(chunk_id, chapter_hint, char_start, char_end, field, place, text): each text of a chunk that can be searched; of
    a list of structs each value, in order. Nulls are no items."""

    def of(name: str, path: str) -> Column:
        kind = kb.select(F.col(path).alias("x")).schema["x"].dataType
        texts = F.col(path)
        if kind.typeName() == "string":
            texts = F.array(texts)
        elif kind.elementType.typeName() == "struct":
            texts = F.flatten(F.transform(texts, lambda s: F.array(*[s[n] for n in kind.elementType.names])))
        made = F.transform(texts, lambda t, i: F.struct(F.lit(name).alias("field"), i.cast("int").alias("place"), t.alias("text")))
        return F.coalesce(made, F.array()).cast(ITEM)

    every = F.concat(*[of(n, p) for n, p in SEARCHED.items()])
    return kb.select("chunk_id", "chapter_hint", "char_start", "char_end", F.inline(every)).where("text is not null and text <> ''")


class SearchIndex:
    """A posting table and the items under a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def build(self, kb: DataFrame) -> SearchIndex:
        """Write the tables; they are made anew from the whole knowledge base. An item's part is a bucket of its text.

        Both are dealt by bucket before they are written, and a bucket that a frequent text or gram fills is dealt to
        several tasks, so no task has a gram's postings whole and no folder is in many small files.
        """
        key = F.xxhash64("text")
        rows = items(kb).withColumns({"id": key, "part": F.pmod(key, F.lit(self.buckets)).cast("int")})
        rows.hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/items")
        self._items().select("id", "text").distinct().write.mode("overwrite").parquet(f"{self.path}/texts")
        posts = self._texts().select("id", F.explode(grams(F.col("text"), GRAM)).alias("gram"))
        posts = posts.withColumn("bucket", bucket(F.col("gram"), self.buckets))
        posts.hint("rebalance", "bucket").sortWithinPartitions("gram").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/postings")
        return self

    def _items(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/items")

    def _texts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/texts")

    def postings(self, asked: DataFrame) -> DataFrame:
        """(keyword, of, id) of texts that hold all grams of a keyword; two texts with one id count as one here. asked: keyword,
        field, of at least three characters. Which buckets are asked for is known before, so the others' folders are not read."""
        wanted = asked.select("keyword", F.col("field").alias("of"), F.explode("grams").alias("gram"), F.size("grams").alias("n")).withColumn("bucket", bucket(F.col("gram"), self.buckets))
        numbers = sorted(r[0] for r in wanted.select("bucket").distinct().collect())
        posts = self.spark.read.parquet(f"{self.path}/postings").where(F.col("bucket").isin(*numbers))
        met = posts.join(wanted, ["bucket", "gram"])
        return met.groupBy("keyword", "of", "id").agg(F.count("*").alias("hits"), F.max("n").alias("n")).where("hits >= n").select("keyword", "of", "id")

    def search(self, keywords: DataFrame) -> DataFrame:
        """(keyword, chunk_id, chapter_hint, char_start, char_end, field, hit) for keywords(keyword, and field if only one
        is asked): the same rows as a scan for each. Null and empty keywords find nothing; repeated ones count once."""
        asked = keywords if "field" in keywords.columns else keywords.withColumn("field", F.lit(None).cast("string"))
        asked = asked.select("keyword", "field", grams(F.col("keyword"), GRAM).alias("grams")).where("keyword is not null and keyword <> ''").dropDuplicates(["keyword", "field"])
        at = scratch(self.spark, "candidates")
        met = self.postings(asked.where("size(grams) > 0"))
        short = asked.where("size(grams) = 0").select("keyword", F.col("field").alias("of"))
        if short.head(1):
            # a keyword of one or two characters is a gram of that length
            own = self._texts().select("id", F.explode(F.concat(grams(F.col("text"), 1), grams(F.col("text"), 2))).alias("keyword"))
            met = met.unionByName(own.join(short, "keyword").select(*met.columns).distinct())
        met.withColumn("part", F.pmod("id", F.lit(self.buckets)).cast("int")).write.parquet(at)
        candidates = self.spark.read.parquet(at)
        # parts are a bounded number; those without a candidate are not read
        parts = sorted(r[0] for r in candidates.select("part").distinct().collect())
        found = self._items().where(F.col("part").isin(*parts)).join(candidates, ["part", "id"]).where("of is null or of = field")
        # a keyword that is asked in one field and in all finds an item once
        if asked.groupBy("keyword").count().where("count > 1").head(1):
            found = found.dropDuplicates(["keyword", "chunk_id", "field", "place"])
        held = found.where(F.col("text").contains(F.col("keyword")))
        meta = ["chapter_hint", "char_start", "char_end"]
        per = held.groupBy("keyword", "chunk_id", "field").agg(*[F.first(c).alias(c) for c in meta], F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda x: x["text"]), ", ").alias("hit"))
        hit = F.when(F.length("hit") > HIT_CHARS, F.concat(F.substring("hit", 1, HIT_CHARS), F.lit("..."))).otherwise(F.col("hit"))
        return per.select("keyword", "chunk_id", *meta, "field", hit.alias("hit"))
