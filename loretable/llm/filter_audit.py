"""How filters interact: for every order of five filters, what each step removes, from counters kept by a retracting stream.

The table's files are processed as a stream of micro-batches (available now). What a text fails by itself (A to D)
is a bit mask, made by column functions. Whether it fails E, as a copy of a smaller id's text, may change with later
files: keyed state holds the smallest id of each text so far, and when a smaller one comes the earlier row's mask is
taken back from its part's counters and entered again with E. State is kept in pages: a page is a group of texts
by the hash of the text, so that one call handles many texts, and its state is their rows of smallest id.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from loretable.llm.common import materialize, shared_dir

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: Bytes of input for a page of state, and micro-batches for all files.
PAGE_BYTES, BATCHES = 1 << 20, 4
COUNTS = ["rows", "good", "toxic"]
DELTA = "part string, mask int, rows long, good long, toxic long"
ROW_FIELDS = ["key", "id", "part", "mask", "good", "toxic", "rows"]
PAGES = "page long, key binary, id long, part string, mask int, good int, toxic int, rows long"
_KINDS = {"key": T.BinaryType(), "id": T.LongType(), "part": T.StringType(), "mask": T.IntegerType(), "good": T.IntegerType(), "toxic": T.IntegerType(), "rows": T.LongType()}
PAGE_STATE = T.StructType([T.StructField(n, T.ArrayType(k)) for n, k in _KINDS.items()])
BLANKS = r"[\x20\x09-\x0D]+"
ROCKS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # many small stores: no disk is claimed before it is needed
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def own_mask(text: Column, words: Column) -> Column:
    """Bits of the filters A to D that a text with these words fails by itself."""
    n, distinct = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
    capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("long")
    fails = [n < 100, 100 * distinct < 80 * n, 100 * capitals > 10 * F.length(text).cast("long"), text.rlike("[#$%&*|]")]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def combined(pages: int):
    """A function over frames of rows: of each text the rows of its smallest id, counted; the others are copies for certain
    and, like rows without an id, are counted by part and mask, with no key."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f = f.assign(rows=1)
            loose, f = f[~f["has_id"]], f[f["has_id"]]
            copy = f["id"] > f.groupby("key", sort=False)["id"].transform("min")
            first = f[~copy].groupby(ROW_FIELDS[:-1], sort=False, as_index=False)["rows"].sum()
            yield first.assign(page=[int.from_bytes(k[:8], "little") % pages for k in first["key"]])[["page", *ROW_FIELDS]]
            settled = pd.concat([loose, f[copy].assign(mask=lambda x: x["mask"] | COPY)]).groupby(["part", "mask", "good", "toxic"], sort=False, as_index=False)["rows"].sum()
            yield settled.assign(key=None, id=0, page=[hash_page(*x, pages) for x in zip(settled["part"], settled["mask"], strict=True)])[["page", *ROW_FIELDS]]

    return work


def hash_page(part: str, mask: int, pages: int) -> int:
    import zlib

    return zlib.crc32(f"{mask}:{part}".encode()) % pages


class LeastIds(StatefulProcessor):
    """A page's rows of smallest id per text; emits signed changes of counters by part and mask."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("least", PAGE_STATE)

    def handleInputRows(self, key, rows, timerValues):
        held = self.state.get()
        texts: dict = {}
        for x in zip(*held, strict=True) if held else ():
            texts.setdefault(bytes(x[0]), [x[1], []])[1].append(list(x[2:]))
        change: dict = {}

        def count(part, mask, good, toxic, n):
            got = change.setdefault((part, mask), [0, 0, 0])
            for i, v in enumerate((n, n * good, n * toxic)):
                got[i] += v

        changed = False
        for r in rows:
            values = [r.part, r.mask, r.good, r.toxic, r.rows]
            if r.key is None:
                count(*values)
                continue
            old = texts.get(bytes(r.key))
            if old and old[0] < r.id:
                count(r.part, r.mask | COPY, r.good, r.toxic, r.rows)
                continue
            if old and old[0] > r.id:
                for part, mask, good, toxic, n in old[1]:
                    count(part, mask, good, toxic, -n)
                    count(part, mask | COPY, good, toxic, n)
            if not old or old[0] > r.id:
                old = texts[bytes(r.key)] = [r.id, []]
            same = next((x for x in old[1] if x[:4] == values[:4]), None)
            if same:
                same[4] += r.rows
            else:
                old[1].append(values)
            changed = True
            count(*values)
        if changed:
            flat = [(k, i, *x) for k, (i, many) in texts.items() for x in many]
            self.state.update(tuple(list(c) for c in zip(*flat, strict=True)))
        for (part, mask), (n, good, toxic) in change.items():
            if n or good or toxic:
                yield Row(part=part, mask=mask, rows=n, good=good, toxic=toxic)

    def close(self) -> None:
        pass


def marked(labels: DataFrame) -> DataFrame:
    """(id as text, good, toxic) of ids with a label of 1 in either; repeated labels count once (the largest)."""
    y = labels.groupBy(F.col("doc_id").cast("long").cast("string").alias("_id")).agg(*[F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))])
    return y.where("_id is not null and good + toxic > 0")


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files under a path, as the file system tells it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(hadoop).getLength()


def part_counters(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES, page_bytes: int = PAGE_BYTES, state: str | None = None) -> DataFrame:
    """(part, mask, rows, good, toxic) over all files of a table of documents; part is lang (null: empty).

    batches: micro-batches at about equal bytes. state: a folder of an earlier run, whose files are not read again
    (new files enter, and take back what they change). Each micro-batch's changes are a table under its number, so a
    batch that runs again replaces its own.
    """
    root = state or f"{shared_dir(spark)}/audit-{uuid.uuid4().hex}"
    size = input_bytes(spark, path)
    pages = max(1, -(-size // page_bytes))
    schema = spark.read.parquet(path).schema
    # a pattern: the table may be one file
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", str(max(1, -(-size // batches))))
    texts = reader.parquet(f"{path[:-1]}[{path[-1]}]").select(F.col("doc_id").cast("long").alias("id"), F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.withColumn("words", words_of(F.col("text"))).select(F.unhex(F.sha2("text", 256)).alias("key"), "id", "part", own_mask(F.col("text"), F.col("words")).alias("mask"))
    # a null id has no label: it is dealt by its text instead
    rows = rows.withColumn("_id", F.coalesce(F.col("id").cast("string"), F.concat(F.lit("-"), F.hex("key"))))
    rows = rows.join(materialize(marked(labels), "marked"), "_id", "left").select("key", F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNotNull().alias("has_id"), "part", "mask", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])
    before = {k: spark.conf.get(k, None) for k in ROCKS}
    for k, v in ROCKS.items():
        spark.conf.set(k, v)
    try:
        changes = rows.mapInPandas(combined(pages), PAGES).groupBy("page").transformWithState(LeastIds(), DELTA, "Append", "None")

        def enter(batch: DataFrame, number: int) -> None:
            batch.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS]).write.mode("overwrite").parquet(f"{root}/changes/batch={number}")

        query = changes.writeStream.foreachBatch(enter).outputMode("append").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    query.awaitTermination()
    fs = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/changes")
    if not fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs):
        return spark.createDataFrame([], DELTA)
    entered = spark.read.schema(DELTA).parquet(f"{root}/changes")
    return entered.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS]).where("rows <> 0")


def effects() -> dict[str, np.ndarray]:
    """Weights (order and step, mask) of each measure of rows."""
    masks = np.arange(1 << len(FILTERS))
    w = {c: np.zeros((len(ORDERS), len(FILTERS), len(masks)), np.int64) for c in ("kept", "removed", "redundant", "unique_fails", "shapley")}
    failing = np.array([bin(m).count("1") for m in masks])
    for o, order in enumerate(ORDERS):
        before = np.zeros(len(masks), bool)
        for s, name in enumerate(order):
            own = masks >> FILTERS.index(name) & 1 == 1
            w["removed"][o, s], w["redundant"][o, s] = own & ~before, own & before
            before = before | own
            w["kept"][o, s] = ~before
            w["unique_fails"][o, s] = own & (failing == 1)
            # a filter comes first among the failing ones in an equal share of all orders
            w["shapley"][o, s] = np.where(own, len(ORDERS) // np.maximum(failing, 1), 0)
    return {k: v.reshape(-1, len(masks)) for k, v in w.items()}


def interactions(counters: DataFrame) -> DataFrame:
    """All orders and steps of each part, from its counters by mask; one task holds a part's 32 counters at a time."""
    masks = 1 << len(FILTERS)
    filled = F.transform(F.sequence(F.lit(0), F.lit(masks - 1)), lambda m: F.coalesce(F.try_element_at(F.col("m"), m), F.struct(*[F.lit(0).cast("long").alias(c) for c in COUNTS])))
    per = counters.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("mask", F.struct(*COUNTS)))).alias("m")).select("part", filled.alias("c"))
    per = per.select("part", *[F.col(f"c.{c}").alias(c) for c in COUNTS])
    names = [(order, step + 1) for order in ORDERS for step in range(len(FILTERS))]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = effects()
        for f in frames:
            for part, *counts in f.itertuples(index=False):
                rows, good, toxic = (np.asarray(c, np.int64) for c in counts)
                out = pd.DataFrame({"part": part, "filter_order": [n[0] for n in names], "step": np.array([n[1] for n in names], np.int32)})
                yield out.assign(**{k: w @ rows for k, w in weights.items()}, good_lost=weights["removed"] @ good, toxic_lost=weights["removed"] @ toxic)

    measures = ["kept", "removed", "redundant", "unique_fails", "shapley", "good_lost", "toxic_lost"]
    return per.mapInPandas(work, f"part string, filter_order string, step int, {', '.join(f'{c} long' for c in measures)}")


def filter_audit(spark: SparkSession, path: str, labels: DataFrame, **how) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, shapley, good_lost, toxic_lost) for a table of documents under path.

    Null texts are empty, a null lang is the part ''. Rows of a null doc_id are no copies of others, nor others of
    them. Rows that repeat the smallest id of a text do not fail E. Whole texts are read once; only a digest, the id
    and small numbers are shuffled. Copies are counted before the shuffle, so of a text with a third of all rows
    each Arrow batch sends one row (and one for each part and label of its smallest id). Other columns are not read;
    an empty table gives no rows.
    """
    return interactions(part_counters(spark, path, labels, **how))


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), y AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, CASE WHEN len(words) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN t.doc_id > min(t.doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
  FROM t LEFT JOIN y ON t.doc_id = y.doc_id
), c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask
), f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(name, bit)
), o AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits FROM f a, f b, f c, f d, f e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), s AS (SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS BIGINT) AS earlier FROM o, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step) k
), r AS (
  SELECT part, filter_order, step, bit, CAST(sum(CASE WHEN mask & (earlier | bit) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN mask & bit <> 0 AND mask & earlier <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r
"""
