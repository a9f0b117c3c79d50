"""Nearest neighbours by largest inner product: a navigable small-world graph per shard, shards' results merged.

Vectors are dealt to shards by the hash of their content. Each shard's graph is built in one task and stored
as flat arrays: nodes stand in order of falling level, so that the nodes of level l are the first n_l ones,
and the links of a level are one matrix of node numbers (-1: none). Inserts and searches go in blocks: numpy
walks the graph for all vectors of a block at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loretable.llm.common import materialize, share_of, shared_dir, spread_join

#: Distinct vectors in a shard (on average), links of a node (twice as many on level 0), candidates kept in building and searching.
SHARD, LINKS, BUILD, SEARCH = 8192, 16, 64, 96
#: Query vectors that are broadcast at once (on average), rows that walk a graph at once, candidates on upper levels.
WAVE, BLOCK, UPPER = 16384, 512, 8
INDEX = "shard int, dim int, vectors binary, owners binary, owner_bounds binary, levels array<int>, links array<binary>"


def lifted(x: np.ndarray) -> np.ndarray:
    """Vectors scaled into the unit ball with one more component that puts them on its surface.

    There the nearest vector is the one of largest inner product; a query's own component is 0.
    """
    x = x / np.abs(x).max()
    x = x / np.sqrt((x * x).sum(axis=1).max())
    return np.concatenate([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))[:, None]], axis=1).astype(np.float32)


class Graph:
    """nodes: lifted vectors in order of falling level; sizes: nodes on each level; links: a matrix for each level."""

    def __init__(self, nodes: np.ndarray, sizes: list[int], links: list[np.ndarray]):
        self.nodes, self.sizes, self.links = nodes, sizes, links

    def walk(self, level: int, queries: np.ndarray, entry: np.ndarray, width: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The `width` best nodes found from entry (rows x any, -1: none) among the first `most`, best first, and their likeness."""
        links, rows = self.links[level], len(queries)
        seen = np.zeros((rows, most + 1), bool)  # the last column stands for "none"
        ids, like, open_ = np.full((rows, width), -1), np.full((rows, width), -np.inf, np.float32), np.zeros((rows, width), bool)
        fresh, active = entry, np.arange(rows)
        while len(active):
            fresh = np.where((fresh >= 0) & (fresh < most), fresh, most)
            fresh = np.where(seen[active[:, None], fresh], most, fresh)
            seen[active[:, None], fresh] = True
            seen[:, most] = False
            value = np.einsum("rkd,rd->rk", self.nodes[np.minimum(fresh, len(self.nodes) - 1)], queries[active])
            value[fresh == most] = -np.inf
            all_ids, all_like = np.concatenate([ids[active], fresh], axis=1), np.concatenate([like[active], value], axis=1)
            all_open = np.concatenate([open_[active], fresh != most], axis=1)
            best = np.argpartition(-all_like, width - 1, axis=1)[:, :width] if all_like.shape[1] > width else np.broadcast_to(np.arange(all_like.shape[1]), all_like.shape)
            k = best.shape[1]
            ids[active, :k], like[active, :k], open_[active, :k] = (np.take_along_axis(a, best, 1) for a in (all_ids, all_like, all_open))
            active = active[open_[active].any(axis=1)]
            at = np.where(open_[active], like[active], -np.inf).argmax(axis=1)
            open_[active, at] = False
            fresh = links[ids[active, at]]
        order = np.argsort(-like, axis=1, kind="stable")
        ids, like = np.take_along_axis(ids, order, 1), np.take_along_axis(like, order, 1)
        return np.where(np.isneginf(like), -1, ids), like

    def descend(self, queries: np.ndarray, most: int, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(level, ids, likeness) from the top level down; width holds for level 0."""
        entry = np.zeros((len(queries), 1), np.int64)
        for level in range(len(self.sizes) - 1, -1, -1):
            found, like = self.walk(level, queries, entry, width if level == 0 else min(width, UPPER), min(most, self.sizes[level]))
            yield level, found, like
            entry = found

    def search(self, queries: np.ndarray, width: int) -> np.ndarray:
        return [found for _, found, _ in self.descend(queries, len(self.nodes), width)][-1]


def spread_links(nodes: np.ndarray, candidates: np.ndarray, like: np.ndarray, most: int) -> np.ndarray:
    """For each row at most that many candidates (-1: none): those nearer to the row's node than to any
    taken before come first, then the nearest of the others."""
    order = np.argsort(-like, axis=1, kind="stable")
    ids, like = np.take_along_axis(candidates, order, 1), np.take_along_axis(like, order, 1)
    valid = ~np.isneginf(like)
    x = nodes[np.maximum(ids, 0)]
    between = x @ x.transpose(0, 2, 1)
    rows, width = ids.shape
    taken, count = np.zeros((rows, width), bool), np.zeros(rows, np.int64)
    nearest = np.full((rows, width), -np.inf, np.float32)  # likeness to the most alike of those taken
    for j in range(width):
        take = valid[:, j] & (like[:, j] > nearest[:, j]) & (count < most)
        taken[:, j], count = take, count + take
        nearest[take] = np.maximum(nearest[take], between[take, j])
    first = np.argsort(np.where(taken, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :most]
    out = np.where(np.take_along_axis(valid, first, 1), np.take_along_axis(ids, first, 1), -1)
    return np.pad(out, ((0, 0), (0, max(0, most - width))), constant_values=-1)


def build(vectors: np.ndarray, seed: int = 0, links: int = LINKS, width: int = BUILD) -> tuple[np.ndarray, Graph]:
    """Order of the vectors in the graph, and the graph. Vectors are distinct rows."""
    n, rng = len(vectors), np.random.default_rng(seed)
    level = np.floor(rng.exponential(1 / np.log(links), n)).astype(int)
    order = np.lexsort((rng.permutation(n), -level))
    level, nodes = level[order], lifted(vectors)[order]
    sizes = [int((level >= k).sum()) for k in range(level.max() + 1)]
    graph = Graph(nodes, sizes, [np.full((s, links * (1 if k else 2)), -1) for k, s in enumerate(sizes)])
    lo = 0
    while lo < n:
        hi = min(n, lo + min(max(lo, 64), BLOCK))
        batch = np.arange(lo, hi)
        among = nodes[lo:hi] @ nodes[lo:hi].T
        np.fill_diagonal(among, -np.inf)
        near = np.argsort(-among, axis=1, kind="stable")[:, : 2 * links]
        found = {k: (ids, like) for k, ids, like in graph.descend(nodes[lo:hi], lo, width)} if lo else {}
        for k, size in enumerate(sizes):
            own = batch[batch < size]
            if not len(own):
                break
            m = len(own)
            mates, likeness = lo + near[:m], np.take_along_axis(among[:m], near[:m], 1)
            likeness = np.where(mates < size, likeness, -np.inf)
            if lo:
                mates, likeness = np.concatenate([found[k][0][:m], mates], axis=1), np.concatenate([found[k][1][:m], likeness], axis=1)
            matrix = graph.links[k]
            matrix[own] = spread_links(nodes, mates, likeness, matrix.shape[1])
            _link_back(graph, k, own)
        lo = hi
    return order, graph


def _link_back(graph: Graph, level: int, own: np.ndarray) -> None:
    """Links to the nodes `own` from the nodes they link to; a node with too many chooses again, in rounds
    until all are considered."""
    matrix, nodes = graph.links[level], graph.nodes
    source, target = np.repeat(own, matrix.shape[1]), matrix[own].ravel()
    source, target = source[target >= 0], target[target >= 0]
    known = (matrix[target] == source[:, None]).any(axis=1)
    source, target = source[~known], target[~known]
    by = np.argsort(target, kind="stable")
    source, target = source[by], target[by]
    start = np.searchsorted(target, target)
    place = np.arange(len(target)) - start
    width = matrix.shape[1]
    for round_ in range(int(place.max(initial=-1)) // width + 1):
        now = place // width == round_
        nodes_now, row = np.unique(target[now], return_inverse=True)
        for a in range(0, len(nodes_now), BLOCK):
            part = (row >= a) & (row < a + BLOCK)
            some = nodes_now[a : a + BLOCK]
            new = np.full((len(some), width), -1)
            new[row[part] - a, place[now][part] % width] = source[now][part]
            mates = np.concatenate([matrix[some], new], axis=1)
            like = np.einsum("rkd,rd->rk", nodes[np.maximum(mates, 0)], nodes[some])
            like[mates < 0] = -np.inf
            matrix[some] = spread_links(nodes, mates, like, width)


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v array<double>, key) of vectors that take part: id and vector not null, no null or non-finite component, not zero."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where("vec_id is not null and v is not null")
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.where(~bad & F.exists("v", lambda c: c != 0)).withColumn("key", F.sha2(F.col("v").cast("string"), 256))


def build_index(vectors: DataFrame, most: int, shard: int = SHARD) -> DataFrame:
    """One row per shard, from usable vectors: equal vectors are one node, which keeps the `most` smallest of its ids.

    A search for fewer than `most` rows needs no others, as ties go to the smaller id. Of a vector that has a
    third of all rows each task sends `most` rows at most, as the rank's limit holds before the shuffle.
    """
    place = F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))
    distinct = vectors.dropDuplicates(["vec_id", "key"]).withColumn("_place", place).where(F.col("_place") <= most)
    distinct = materialize(distinct.groupBy("key").agg(F.min_by("v", "vec_id").alias("v"), F.sort_array(F.collect_list("vec_id")).alias("owners")), "vectors")
    shards = max(1, -(-distinct.count() // shard))
    dealt = distinct.select(F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"), F.size("v").alias("dim"), "key", "v", "owners").repartitionById(shards, "shard")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        for dim in sorted(set(table["dim"].to_pylist())):
            rows = table.filter(pc.equal(table["dim"], dim)).sort_by("key").combine_chunks()
            x = np.asarray(rows["v"].combine_chunks().flatten()).reshape(-1, dim)
            order, graph = build(x)
            owners = rows["owners"].combine_chunks().take(pa.array(order))
            yield pa.RecordBatch.from_arrays(
                [rows["shard"].combine_chunks()[:1], pa.array([dim], pa.int32()), pa.array([x[order].tobytes()]), pa.array([np.asarray(owners.flatten()).astype(np.int64).tobytes()]),
                 pa.array([np.asarray(owners.offsets).astype(np.int32).tobytes()]), pa.array([graph.sizes], pa.list_(pa.int32())), pa.array([[m.astype(np.int32).tobytes() for m in graph.links]], pa.list_(pa.binary()))],
                ["shard", "dim", "vectors", "owners", "owner_bounds", "levels", "links"],
            )

    return materialize(dealt.mapInArrow(work, INDEX), "hnsw")


class Shard:
    """A row of the index, ready to be searched."""

    def __init__(self, row: dict):
        self.dim = row["dim"]
        self.vectors = np.frombuffer(row["vectors"]).reshape(-1, self.dim)
        bounds, owners = np.frombuffer(row["owner_bounds"], np.int32).astype(np.int64), np.frombuffer(row["owners"], np.int64)
        self.owners, self.bounds = owners[bounds[0] : bounds[-1]], bounds - bounds[0]
        links = [np.frombuffer(b, np.int32).astype(np.int64).reshape(n, -1) for b, n in zip(row["links"], row["levels"], strict=True)]
        self.graph = Graph(lifted(self.vectors), row["levels"], links)

    def nearest(self, queries: np.ndarray, most: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, id, score) of each query's best ids by the graph; score is the inner product in double precision."""
        scaled = queries / np.abs(queries).max(axis=1, keepdims=True)
        found = self.graph.search(np.concatenate([scaled, np.zeros((len(queries), 1))], axis=1).astype(np.float32), width)
        row, at = np.nonzero(found >= 0)
        node = found[row, at]
        score = np.einsum("kd,kd->k", self.vectors[node], queries[row])
        copies = np.diff(self.bounds)[node]
        first = np.repeat(self.bounds[node] - np.concatenate(([0], np.cumsum(copies)))[:-1], copies)
        return best(np.repeat(row, copies), self.owners[first + np.arange(copies.sum())], np.repeat(score, copies), most)


def best(row: np.ndarray, ids: np.ndarray, score: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's `most` entries of highest score, ties to the smaller id, each id once."""
    order = np.lexsort((ids, -score, row))
    row, ids, score = row[order], ids[order], score[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < most], ids[place < most], score[place < most]


def nearest_vectors(embeddings: DataFrame, queries: DataFrame, k: int = 20, shard: int = SHARD, width: int = SEARCH, wave: int = WAVE) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): the k rows of largest inner product found for each row of queries.

    queries: a table like embeddings (vec_id, embedding). A row is never its own answer; ties go to the smaller
    vec_id. Rows that are null (id or vector), zero or hold null or non-finite components take no part; vectors
    of other lengths than a query's are no candidates of it. A row that stands there again counts once; an id with
    several vectors is searched by each, and answers with its best. Fewer candidates than k give fewer rows, an
    empty table gives none. Other columns are not read.

    Equal query vectors are searched once, with k + 1 answers so that each asker can leave itself out. Query
    vectors are broadcast in waves of about `wave`; a wave passes over the whole index, and each task keeps the
    k + 1 best answers of its shards, so what is shuffled is that for each query and task.
    """
    spark, most = embeddings.sparkSession, k + 1
    vectors = materialize(usable(embeddings), "usable")
    index = build_index(vectors, most, shard)
    asked = materialize(usable(queries), "asked")
    distinct = materialize(asked.groupBy("key").agg(F.first("v").alias("v"), F.count("*").alias("askers")), "askers")
    waves = max(1, -(-distinct.count() // wave))
    path = f"{shared_dir(spark)}/answers-{uuid.uuid4().hex}"
    for i in range(waves):
        part = distinct.where(F.pmod(F.xxhash64("key", F.lit(3)), F.lit(waves)) == i).select("key", "v").toPandas()
        if len(part) or not i:
            _answers(index, part["key"].to_numpy(), list(part["v"]), most, width).write.parquet(f"{path}/wave={i}")
    answers = spark.read.schema("key string, vec_id long, score double").parquet(path)
    place = lambda key: F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), "vec_id"))
    once = answers.groupBy("key", "vec_id").agg(F.max("score").alias("score")).withColumn("_place", place("key")).where(F.col("_place") <= most)
    lists = materialize(once.groupBy("key").agg(F.collect_list(F.struct("vec_id", "score")).alias("found")).join(distinct.select("key", "askers"), "key"), "lists")
    told = spread_join(asked.select(F.col("vec_id").alias("query_id"), "key"), lists, "key", "askers").select("query_id", F.inline("found")).where("query_id <> vec_id")
    told = told.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", place("query_id")).where(F.col("rank") <= k)
    return told.select("query_id", "rank", "vec_id", "score")


def _answers(index: DataFrame, keys: np.ndarray, vectors: list, most: int, width: int) -> DataFrame:
    """(key, vec_id, score): the best answers of each task's shards to a wave of query vectors."""
    dims = np.array([len(v) for v in vectors], np.int64)
    wave = {int(d): (np.flatnonzero(dims == d), np.stack([np.asarray(vectors[i], np.float64) for i in np.flatnonzero(dims == d)])) for d in np.unique(dims)}
    shared = index.sparkSession.sparkContext.broadcast((keys, wave))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, parts = shared.value
        row, ids, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for batch in batches:
            for i in range(batch.num_rows):
                one = Shard(batch.slice(i, 1).to_pylist()[0])
                if one.dim in parts:
                    at, x = parts[one.dim]
                    found = [one.nearest(x[lo : lo + BLOCK], most, width) for lo in range(0, len(x), BLOCK)]
                    rows = [at[lo * BLOCK + f[0]] for lo, f in enumerate(found)]
                    row, ids, score = best(np.concatenate([row, *rows]), np.concatenate([ids, *[f[1] for f in found]]), np.concatenate([score, *[f[2] for f in found]]), most)
        yield pa.RecordBatch.from_arrays([pa.array(names[row], pa.string()), pa.array(ids), pa.array(score)], ["key", "vec_id", "score"])

    return index.mapInArrow(work, "key string, vec_id long, score double")


def measured_recall(embeddings: DataFrame, found: DataFrame, queries: DataFrame, k: int = 20, sample: int = 256) -> float:
    """Share of the true k nearest of about `sample` queries (by hash) that found holds; brute force in blocks over all rows."""
    n = queries.count()
    chosen = usable(queries).where(share_of("vec_id", sample / max(n, 1), 11)).toPandas()
    if not len(chosen):
        return 1.0
    dims = np.array([len(v) for v in chosen["v"]])
    shared = embeddings.sparkSession.sparkContext.broadcast((chosen["vec_id"].to_numpy(np.int64), dims, list(chosen["v"])))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        askers, dims, vectors = shared.value
        row, ids, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for b in batches:
            own, lengths = b.column(0).to_numpy(), np.array([len(v) for v in b.column(1)])
            for d in np.unique(dims):
                q, c = np.flatnonzero(dims == d), np.flatnonzero(lengths == d)
                if len(c):
                    x = np.asarray(b.column(1).take(pa.array(c)).flatten()).reshape(-1, d)
                    s = np.stack([vectors[i] for i in q]) @ x.T
                    s[askers[q][:, None] == own[c][None, :]] = -np.inf
                    some = np.argsort(-s, axis=1, kind="stable")[:, :k]
                    value = np.take_along_axis(s, some, 1)
                    r = np.repeat(q, some.shape[1])
                    row, ids, score = best(np.concatenate([row, r]), np.concatenate([ids, own[c][some].ravel()]), np.concatenate([score, value.ravel()]), k)
        keep = ~np.isneginf(score)
        yield pa.RecordBatch.from_arrays([pa.array(askers[row][keep]), pa.array(ids[keep]), pa.array(score[keep])], ["query_id", "vec_id", "score"])

    truth = usable(embeddings).select("vec_id", "v").mapInArrow(work, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    truth = truth.withColumn("_place", place).where(F.col("_place") <= k)
    hits = truth.join(found.select("query_id", "vec_id", F.lit(1).alias("_hit")), ["query_id", "vec_id"], "left")
    total, hit = hits.agg(F.count("*"), F.count("_hit")).first()
    return hit / total if total else 1.0
