"""Shared pieces of the training-data operators: tables, shared folders, words, held-out rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dir: dict[str, str] = {}
#: Rows of a key that one task may hold in a join, and tasks that larger ones are dealt to.
HOT, SALTS = 1000, 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the context's checkpoint folder.

    Where the session names none a temporary folder stands in on one machine; on a cluster, where
    executors would not see each other's files, that is an error.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named and context._jsc.sc().getCheckpointDir().isDefined():
        named = context._jsc.sc().getCheckpointDir().get()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = context.applicationId
    if app not in _own_dir:
        _own_dir[app] = tempfile.mkdtemp(prefix="spark-loretable-")
    return _own_dir[app]


def materialize(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo; null ids give remainder of the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def documents_of(docs: DataFrame) -> DataFrame:
    """doc_id and whole text only (null text: empty), whatever else the table holds."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def share_of(column: str, share: float, seed: int) -> Column:
    """True for about that share of the rows, by a hash of a column; the same rows on every run."""
    return F.pmod(F.xxhash64(F.col(column), F.lit(seed)), F.lit(1 << 40)) < int(min(1.0, share) * (1 << 40))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """doc_id, text, y for documents with a label of 0 or 1, about bound of them at most.

    Labels are chosen first, by a hash of the id; as there are about bound of them at most, they are
    broadcast, and no text is shuffled. Repeated labels count once (the largest).
    """
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    y = y.groupBy("doc_id").agg(F.max("y").alias("y"))
    n = y.count()
    chosen = y if n <= bound else y.where(share_of("doc_id", bound / n, 7))
    return documents_of(docs).join(F.broadcast(chosen), "doc_id")


def member_test(keys: DataFrame, column: str, log2_bits: int = 26):
    """A function Column -> Column that is true for every value in keys[column] (null included).

    It is a one-hash bit filter of fixed size (2**log2_bits bits, 8 MB as set), so what is broadcast
    does not grow with the data; of a filter that is nearly empty only the words in use are sent (each
    broadcast lies on disk once for the driver and each executor). It may also be true for other values
    (about n / 2**log2_bits of them); callers let an exact join decide on the rows it lets through.
    """
    import numpy as np

    bit = F.pmod(F.xxhash64(F.col(column)), F.lit(1 << log2_bits))
    words = keys.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / 64).cast("int").alias("w"))
    words = words.agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("m")).toPandas().sort_values("w")
    places, masks = words["w"].to_numpy(np.int64), words["m"].to_numpy(np.int64)
    every = 1 << (log2_bits - 6)
    if len(places) > every // 4:
        mask = np.zeros(every, np.int64)
        mask[places] = masks
        places, masks = None, mask
    shared = keys.sparkSession.sparkContext.broadcast((places, masks))

    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        at, (places, masks) = h.to_numpy(np.int64), shared.value
        if places is None:
            return pd.Series((masks[at >> 6] >> (at & 63)) & 1 == 1)
        if not len(places):
            return pd.Series(np.zeros(len(at), bool))
        k = np.minimum(np.searchsorted(places, at >> 6), len(places) - 1)
        return pd.Series((places[k] == at >> 6) & ((masks[k] >> (at & 63)) & 1 == 1))

    return lambda c: maybe(F.pmod(F.xxhash64(c), F.lit(1 << log2_bits)))


def spread_join(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """rows with the columns of groups (one row per key; size: how many rows have it), left outer.

    Keys of more than HOT rows meet in SALTS tasks instead of one: their group's row is repeated for
    each, and rows are dealt by their place in the input. Which keys are large is asked of a filter of
    fixed size, on both sides alike; where there is none it is a plain join. No key may be null.
    """
    hot = materialize(groups.where(F.col(size) > HOT).select(key), "hot")
    if not hot.head(1):
        return rows.join(groups, key, "left")
    large = member_test(hot, key)
    salted = groups.withColumn("_salt", F.explode(F.when(large(F.col(key)), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    dealt = rows.withColumn("_salt", F.when(large(F.col(key)), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")).otherwise(0))
    return dealt.join(salted, [key, "_salt"], "left").drop("_salt")


def without(docs: DataFrame, decided: DataFrame, key: Callable[[Column], Column]) -> DataFrame:
    """docs without the rows that decided marks as not kept; rows of equal doc_id and key stay once.

    decided: doc_id, key, kept for each row of docs, kept the same for equal doc_id and key (nulls
    count as equal). key: column function of the text (null: empty) that gave decided's key. Of
    several rows of equal doc_id and key the longest text stays, then the smallest. Only rows whose
    doc_id a fixed-size filter takes for one of those that go or repeat are shuffled to be decided by
    a join; the whole texts of all the others stay where they are read.
    """
    pairs = decided.groupBy(F.col("doc_id").cast("long").alias("_id"), F.col("key").alias("_key")).agg(F.min("kept").alias("_kept"), F.count("*").alias("_n"))
    asked = materialize(pairs.where("not _kept or _n > 1").select("_id", "_key", "_kept"), "asked")
    maybe = member_test(asked, "_id")
    ids, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit(""))
    sure = docs.where(~maybe(ids))
    row = F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns])
    open_ = docs.where(maybe(ids)).select(row.alias("_row"), ids.alias("_i"), key(text).alias("_k"), F.struct((-F.length(text)).alias("n"), text.alias("t")).alias("_order"))
    decided = open_.join(asked, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_key")), "left").where("_kept is null or _kept")
    return sure.unionByName(decided.groupBy("_i", "_k").agg(F.min_by("_row", "_order").alias("_row")).select("_row.*"))
