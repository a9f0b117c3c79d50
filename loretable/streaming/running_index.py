"""The character index kept up to date by a stream: counts, first and last chunk, first distinct values per character.

State is keyed by the character's name and bounded: numbers, two chunk ids and the first few values of each kind
with the places where they were first seen. Order is that of (chunk, place), so files may come in any order: a
value that is not among the first few can only come to be by a smaller place, which is new input then.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from loretable.functions.files import Files
from loretable.functions.text import strip

VALUES = ("action", "emotion")
PARTIAL = "name string, rows long, chunks long, first_chunk string, last_chunk string, " + ", ".join(f"{v}s array<struct<chunk:string,pos:int,value:string>>" for v in VALUES)
INDEX = "name string, count long, chunk_count long, first_chunk string, last_chunk string, actions array<string>, emotions array<string>, revision long"
_SEEN = T.ArrayType(T.StructType([T.StructField("chunk", T.StringType()), T.StructField("pos", T.IntegerType()), T.StructField("value", T.StringType())]))
STATE = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("revision", "count", "chunk_count")] + [T.StructField(n, T.StringType()) for n in ("first_chunk", "last_chunk")] + [T.StructField(f"{v}s", _SEEN) for v in VALUES]
)
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # many small stores: no disk is claimed before it is needed
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def opening_mentions(records: DataFrame) -> DataFrame:
    """(chunk_id, pos, name, action, emotion, opens): mentions with a name; opens is 1 for a name's first in its chunk, else 0."""
    named = lambda c: F.coalesce(strip(c), F.lit(""))
    spread = records.select("chunk_id", F.transform("characters", lambda c: named(c["name"])).alias("names"), F.posexplode("characters").alias("pos", "e"))
    rows = spread.select("chunk_id", "pos", "names", *[named(F.col(f"e.{f}")).alias(f) for f in ("name", *VALUES)]).where("name <> ''")
    return rows.withColumn("opens", (F.array_position("names", F.col("name")) == F.col("pos") + 1).cast("int")).drop("names")


def first_values(seen: Iterator[tuple], most: int) -> list[tuple]:
    """The `most` values of smallest first place (chunk, pos), each once."""
    least: dict = {}
    for chunk, pos, value in seen:
        if value not in least or (chunk, pos) < least[value]:
            least[value] = (chunk, pos)
    return sorted((*place, value) for value, place in least.items())[:most]


def _place(x) -> tuple:
    """(chunk, pos, value) of a struct, which comes as a dict, a row or a tuple."""
    return (x["chunk"], x["pos"], x["value"]) if isinstance(x, dict) else tuple(x)


def partials(most: int):
    """A function over frames of mentions (name, chunk_id, pos, values): one row per name of a frame, so a name that
    is in every chunk sends one row per frame to its state, not one per mention."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for name, g in f.groupby("name", sort=False):
                places = [first_values((x for x in zip(g["chunk_id"], g["pos"].tolist(), g[v], strict=True) if x[2]), most) for v in VALUES]
                out.append((name, len(g), int(g["opens"].sum()), g["chunk_id"].min(), g["chunk_id"].max(), *[[{"chunk": c, "pos": p, "value": v} for c, p, v in x] for x in places]))
            yield pd.DataFrame(out, columns=["name", "rows", "chunks", "first_chunk", "last_chunk", *[f"{v}s" for v in VALUES]])

    return work


class RunningCharacter(StatefulProcessor):
    """Adds partial rows of a name to its state and emits the whole index row, with a growing revision."""

    def __init__(self, most: int):
        self.most = most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("character", STATE)

    def handleInputRows(self, key, rows, timerValues):
        old = self.state.get() or (0, 0, 0, None, None, *[[] for _ in VALUES])
        revision, count, chunks, first, last = old[:5]
        seen = [[_place(x) for x in old[5 + i]] for i in range(len(VALUES))]
        for r in rows:
            count, chunks = count + r.rows, chunks + r.chunks
            first = r.first_chunk if first is None else min(first, r.first_chunk)
            last = r.last_chunk if last is None else max(last, r.last_chunk)
            for i, v in enumerate(VALUES):
                seen[i] = first_values(iter([*seen[i], *map(_place, r[f"{v}s"])]), self.most)
        self.state.update((revision + 1, count, chunks, first, last, *seen))
        yield Row(name=key[0], count=count, chunk_count=chunks, first_chunk=first, last_chunk=last, actions=[x[2] for x in seen[0]], emotions=[x[2] for x in seen[1]], revision=revision + 1)

    def close(self) -> None:
        pass


def start_running_index(records: DataFrame, out: str, checkpoint: str, most: int = 20, once: bool = True, merge: int = 16) -> StreamingQuery:
    """Keep the character index of a stream of records (chunk_id, characters) under `out`; resumes from the checkpoint.

    Each micro-batch writes the rows that changed under its number, so a batch that runs again replaces its own;
    every `merge` batches the last row of each name is written as one table (`read_running_index` starts from it).
    once: a chunk that comes again is dropped, its ids are kept in state for that; without it the caller vouches
    that each chunk comes once (as the gated intake does). Null ids and names count as no mention.
    """
    spark = records.sparkSession
    rows = records.where("chunk_id is not null")
    rows = rows.dropDuplicates(["chunk_id"]) if once else rows
    found = opening_mentions(rows)
    before = {k: spark.conf.get(k, None) for k in STORE}
    for k, v in STORE.items():
        spark.conf.set(k, v)
    try:
        index = found.mapInPandas(partials(most), PARTIAL).groupBy("name").transformWithState(RunningCharacter(most), INDEX, "Append", "None")

        def enter(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/changes/batch={number}")
            if number and number % merge == 0:
                read_running_index(spark, out, number).write.mode("overwrite").parquet(f"{out}/merged/until={number}")

        return index.writeStream.foreachBatch(enter).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_running_index(spark: SparkSession, out: str, until: int | None = None) -> DataFrame:
    """The last row of each name: from the last merged table that is complete, and the batches after it."""
    files = Files(spark, out)
    numbers = lambda folder: sorted(int(n.split("=")[1]) for n in files.names(folder) if "=" in n and files.exists(f"{folder}/{n}/_SUCCESS"))
    merged = [n for n in numbers("merged") if until is None or n < until]
    start = merged[-1] if merged else -1
    batches = [n for n in numbers("changes") if n > start and (until is None or n <= until)]
    paths = ([f"{out}/merged/until={start}"] if merged else []) + [f"{out}/changes/batch={n}" for n in batches]
    if not paths:
        return spark.createDataFrame([], INDEX)
    rows = spark.read.schema(INDEX).parquet(*paths)
    return rows.groupBy("name").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "name"]), "revision").alias("r")).select("name", "r.*")
