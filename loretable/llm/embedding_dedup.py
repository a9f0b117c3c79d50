"""Near-duplicate embeddings by an inverted multi-index.

Unit vectors are cut into two halves, each quantised by a codebook of its own; the product of both
codebooks is a grid of cells. A vector visits cells in the order of the sum of both halves'
distances (multi-sequence order), as many as are needed for a target recall, and what stands in them
is verified by cosine in double precision. How many that is, is measured: for blocks of query
vectors all true partners in the whole table are found by brute force, and the rank at which each
partner's cell would have been visited is counted, until enough queries have shown partners. Where
they stay too few, vectors perturbed to the threshold's cosine give the least number of cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loretable.llm.common import materialize, share_of, spread_join
from loretable.llm.components import connected_components

#: Vectors (chosen by a hash) that the codebooks are fitted on, and codebook sizes at most.
SAMPLE, CODES = 32_768, 4096
#: Vectors wanted in a cell on average when the codebooks' size is chosen.
PER_CELL = 16
#: Query vectors (chosen by a hash) in the first block for measuring recall (each next one is twice as
#: large), queries asked in all, queries with partners that are enough, recall to reach with one direction.
QUERIES, ASKED, ENOUGH, RECALL = 256, 4096, 64, 0.999
#: With fewer queries with partners: share of pairs at just the threshold's cosine that must find each other.
LEAST_RECALL = 0.99
#: Vectors of a cell that one task holds at once; fuller cells are dealt into blocks.
BLOCK = 2048


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 0) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), k, replace=False)]
    step = max(1, 8_000_000 // k)
    for _ in range(rounds):
        near = np.concatenate([distances(x[lo : lo + step], centres).argmin(axis=1) for lo in range(0, len(x), step)])
        counts = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], x[rng.integers(0, len(x), k)])
    return centres


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1), 0)


class Grid:
    """Two codebooks and their product."""

    def __init__(self, vectors: np.ndarray, codes: int):
        x = unit(vectors.astype(np.float64))
        self.half = (x.shape[1] + 1) // 2
        k = max(1, min(codes, len(x)))
        self.books = [kmeans(x[:, : self.half], k), kmeans(x[:, self.half :], k) if x.shape[1] > self.half else np.zeros((1, 0))]

    def parts(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return distances(x[:, : self.half], self.books[0]), distances(x[:, self.half :], self.books[1])

    def visits(self, x: np.ndarray, cells: int) -> np.ndarray:
        """(rows, cells): ids of the nearest cells of unit vectors, nearest first.

        The n-th cell in multi-sequence order lies within the first n codes of each half, and at
        place (i, j) of the two sorted halves only if (i + 1)(j + 1) <= n.
        """
        # rows at once, so that places x rows stay bounded
        step = max(1, 2_000_000 // int(cells * (1 + np.log(cells))))
        if len(x) > step:
            return np.concatenate([self.visits(x[lo : lo + step], cells) for lo in range(0, len(x), step)])
        a, b = self.parts(x)
        cells = min(cells, a.shape[1] * b.shape[1])
        na, nb = min(cells, a.shape[1]), min(cells, b.shape[1])
        ia, ib = np.argsort(a, axis=1, kind="stable")[:, :na], np.argsort(b, axis=1, kind="stable")[:, :nb]
        i, j = (z.ravel() for z in np.meshgrid(np.arange(na), np.arange(nb), indexing="ij"))
        useful = (i + 1) * (j + 1) <= cells
        i, j = i[useful], j[useful]
        total = np.take_along_axis(a, ia, 1)[:, i] + np.take_along_axis(b, ib, 1)[:, j]
        order = np.argsort(total, axis=1, kind="stable")[:, :cells]
        return np.take_along_axis(ia, i[order], 1) * b.shape[1] + np.take_along_axis(ib, j[order], 1)

    def own(self, x: np.ndarray) -> np.ndarray:
        a, b = self.parts(x)
        return a.argmin(axis=1) * b.shape[1] + b.argmin(axis=1)

    def rank(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """How many cells x visits up to and including the given one."""
        a, b = self.parts(x)
        out = np.empty(len(x), np.int64)
        for r in range(len(x)):
            out[r] = (np.add.outer(a[r], b[r]) <= a[r, cell[r] // b.shape[1]] + b[r, cell[r] % b.shape[1]]).sum()
        return out


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as float64 rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 1))


def _usable() -> F.Column:
    """Not null, not zero, no null or non-finite component, and with a label."""
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad & F.exists("embedding", lambda v: v != 0), F.lit(False))


def fit_grid(distinct: DataFrame, n: int, codes: int = CODES, sample: int = SAMPLE) -> Grid:
    chosen = distinct if n <= sample else distinct.where(share_of("uid", sample / n, 5))
    rows = chosen.select("uid", "embedding").toPandas().sort_values("uid")["embedding"]
    k = int(np.clip(np.ceil(np.sqrt(n / PER_CELL)), 1, codes))
    return Grid(np.stack([np.asarray(v, np.float64) for v in rows]), k)


def least_cells(grid: Grid, x: np.ndarray, threshold: float, recall: float = LEAST_RECALL, copies: int = 4) -> int:
    """Cells for that recall of unit vectors and their copies, turned to the threshold's cosine at random.

    A pair is found if one of both visits the other's cell. Closer pairs are found more often.
    """
    x = np.repeat(x, copies, axis=0)
    away = np.random.default_rng(0).normal(size=x.shape)
    away -= (away * x).sum(axis=1, keepdims=True) * x
    y = threshold * x + np.sqrt(max(0.0, 1 - threshold**2)) * away / np.maximum(np.sqrt((away * away).sum(axis=1, keepdims=True)), 1e-12)
    ranks = np.sort(np.minimum(grid.rank(x, grid.own(y)), grid.rank(y, grid.own(x))))
    return int(ranks[int(np.ceil(recall * len(ranks))) - 1])


def _partner_ranks(distinct: DataFrame, grid: Grid, q: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """(query, rank, n): how many true partners in the whole table each query has at each rank."""
    uid, label = q["uid"].to_numpy(np.int64), q["label"].to_numpy()
    x = unit(np.stack([np.asarray(v, np.float64) for v in q["embedding"]]))
    shared = distinct.sparkSession.sparkContext.broadcast((uid, label, x, grid))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid, label, x, grid = shared.value
        counts: dict[tuple[int, int], int] = {}
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                part = b.slice(lo, 2000)
                y = unit(matrix(part.column(2)))
                near = (x @ y.T >= threshold) & (label[:, None] == part.column(1).to_numpy(zero_copy_only=False)) & (uid[:, None] != part.column(0).to_numpy(zero_copy_only=False))
                i, j = np.nonzero(near)
                if len(i):
                    pairs, n = np.unique(np.stack((i, grid.own(y)[j])), axis=1, return_counts=True)
                    for k in zip(pairs[0].tolist(), grid.rank(x[pairs[0]], pairs[1]).tolist(), n.tolist(), strict=True):
                        counts[k[:2]] = counts.get(k[:2], 0) + k[2]
        keys = np.array(list(counts), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(uid[keys[:, 0]]), pa.array(keys[:, 1]), pa.array(np.fromiter(counts.values(), np.int64, len(counts)))], ["query", "rank", "n"])

    return distinct.select("uid", "label", "embedding").mapInArrow(work, "query long, rank long, n long").groupBy("query", "rank").agg(F.sum("n").alias("n")).toPandas()


def cells_needed(distinct: DataFrame, grid: Grid, n: int, threshold: float, recall: float, queries: int = QUERIES, asked: int = ASKED, enough: int = ENOUGH) -> int:
    """Cells to visit for the target recall, measured on some query vectors against all vectors.

    Blocks of queries are asked until enough of them have shown partners, or all vectors or about
    asked of them are through. Each query with partners counts alike. If they are fewer than enough
    though not all vectors were asked, the result is least_cells at least.
    """
    found, first, seen, block = [], None, 0, queries
    while seen < n:
        block = min(block, max(1, asked - seen))
        chosen = distinct if seen + block >= n else distinct.where(share_of("uid", (seen + block) / n, 6))
        q = chosen.where(~share_of("uid", seen / n, 6)).select("uid", "label", "embedding").toPandas().sort_values("uid")
        seen, block = seen + block, block * 2
        if len(q):
            first = q if first is None else first
            found.append(_partner_ranks(distinct, grid, q, threshold))
        if sum(f["query"].nunique() for f in found) >= enough or seen >= asked:
            break
    least = 1
    if sum(f["query"].nunique() for f in found) < enough and seen < n:
        some = first if first is not None else distinct.select("uid", "embedding").limit(queries).toPandas()
        least = least_cells(grid, unit(np.stack([np.asarray(v, np.float64) for v in some["embedding"]])), threshold)
    ranks = pd.concat(found) if found else pd.DataFrame({"rank": []})
    if ranks.empty:
        return least
    share = (ranks["n"] / ranks.groupby("query")["n"].transform("sum")).groupby(ranks["rank"]).sum().sort_index().cumsum()
    return max(least, int(share.index[share >= recall * share.iloc[-1] - 1e-9][0]))


def near_embeddings(vectors: DataFrame, threshold: float = 0.93, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors with equal, non-null labels are linked at cosine >= threshold. Null and zero vectors, and
    those with null or non-finite components, link with nothing, as do vectors without a label.
    Vectors of other lengths than most never meet the threshold's test with them: each length is
    indexed on its own. Labels of any type are compared as they are, and vectors in double precision.
    Of cells at one distance the one with the smaller number is visited first. Equal vectors of one label are one row of the index with a count, so copies
    cost nothing and are linked to each other always. Null vec_ids keep a row of their own, repeated
    ones each of theirs. An empty table gives an empty result.
    """
    kinds = {f.name: f.dataType for f in vectors.schema.fields}
    whole = kinds["label"].typeName() in ("byte", "short", "integer", "long", "boolean")
    label = F.col("label").cast("int").cast("long") if kinds["label"].typeName() == "boolean" else F.col("label").cast("long" if whole else "string")
    number = "float" if kinds["embedding"].elementType.typeName() == "float" else "double"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.col("embedding").cast(f"array<{number}>").alias("embedding"))
    usable = rows.where(_usable())
    same = usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    distinct = materialize(same.withColumn("uid", F.monotonically_increasing_id()).withColumn("width", F.size("embedding")), "vectors")
    links, widths = None, [r.width for r in distinct.select("width").distinct().collect()]
    for w in sorted(widths):
        found = _search(distinct.where(F.col("width") == w).select("uid", "label", "embedding", "copies"), threshold, recall, block)
        links = found if links is None else links.unionByName(found)
    if links is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    counts = links.where("kind = 0").groupBy(F.col("a").alias("uid")).agg(F.sum("b").alias("others"))
    roots = connected_components(links.where("kind = 1").select("a", "b")).select(F.col("node").alias("uid"), "root")
    ids = distinct.select("uid", "label", "embedding", "least", "copies").join(counts, "uid", "left").join(roots, "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    named = materialize(ids.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n")), "named")
    full = spread_join(ids, named, "root", "n").select(F.struct("label", "embedding").alias("key"), (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"), "component_id", "copies")
    keyed = usable.select("vec_id", F.struct("label", "embedding").alias("key"))
    linked = spread_join(keyed, materialize(full, "classes"), "key", "copies").select("vec_id", "n_links", "component_id")
    alone = rows.where(~_usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _search(distinct: DataFrame, threshold: float, recall: float, block: int) -> DataFrame:
    """(kind, a, b): kind 0: vector a has b more linked copies; kind 1: a and b are linked."""
    n = distinct.count()
    grid = fit_grid(distinct, n)
    cells = cells_needed(distinct, grid, n, threshold, recall)
    shared = distinct.sparkSession.sparkContext.broadcast(grid)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                visits = grid.visits(unit(matrix(part.column(2))), cells).astype(np.int32)
                offsets = np.arange(part.num_rows + 1, dtype=np.int32) * visits.shape[1]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(offsets, visits.ravel())], ["uid", "label", "embedding", "copies", "visits"])

    types = dict(distinct.dtypes)
    placed = materialize(distinct.mapInArrow(place, f"uid long, label {types['label']}, embedding {types['embedding']}, copies long, visits array<int>"), "placed")
    # a vector stands in the first cell it visits; cells are dealt into blocks by their size
    home = F.col("visits")[0].alias("home")
    sizes = placed.groupBy("label", F.col("visits")[0].alias("cell")).count().select("label", "cell", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    rows = placed.select("uid", "label", "embedding", "copies", "visits", home)
    standing = rows.withColumn("cell", F.col("home")).join(sizes, ["label", "cell"]).withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int")).withColumn("role", F.lit(0).cast("byte"))
    # those who visit bring the cell they stand in, not their whole way
    visiting = rows.withColumn("cell", F.explode("visits")).withColumn("visits", F.lit(None).cast("array<int>")).join(sizes, ["label", "cell"])
    visiting = visiting.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("role", F.lit(1).cast("byte"))
    columns = ["label", "cell", "block", "role", "uid", "copies", "embedding", "visits", "home"]
    keys = columns[:3]
    met = standing.select(columns).unionByName(visiting.select(columns)).repartition(*keys).sortWithinPartitions(*keys, "role")
    found = met.mapInArrow(_verify(threshold), "kind byte, a long, b long")
    return materialize(found, "found")


def _verify(threshold: float):
    """Over rows sorted by cell block with standing vectors first: verified links.

    A block's standing vectors are held, visitors stream past. If a visitor q finds y, q counts y; y
    counts q here only if y does not visit q's cell itself. Of the links, those that join parts not
    yet joined in this block are given, so their number stays below that of the rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        held: list[pa.RecordBatch] = []
        state: dict | None = None

        def ready():
            rows = pa.Table.from_batches(held).combine_chunks()
            cols = {c: rows[c].combine_chunks() for c in ("uid", "copies", "embedding", "visits")}
            visits = cols["visits"].flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
            return {"uid": cols["uid"].to_numpy(), "copies": cols["copies"].to_numpy(), "x": unit(matrix(cols["embedding"])), "visits": visits, "part": np.arange(rows.num_rows), "count": np.zeros(rows.num_rows, np.int64)}

        def links(s, visitors):
            uid, copies = visitors.column("uid").to_numpy(), visitors.column("copies").to_numpy()
            x = unit(matrix(visitors.column("embedding")))
            home = visitors.column("home").to_numpy()
            near = (x @ s["x"].T >= threshold) & (uid[:, None] != s["uid"])
            rows = np.flatnonzero(near.any(axis=1))
            if not len(rows):
                return
            counts = near[rows].astype(np.int64) @ s["copies"]
            yield np.zeros(len(rows), np.int8), uid[rows], counts
            pairs = []
            for r in rows.tolist():
                hit = np.flatnonzero(near[r])
                # standing ones that would not find r
                deaf = hit[~(s["visits"][hit] == home[r]).any(axis=1)]
                s["count"][deaf] += copies[r]
                parts, first = np.unique(s["part"][hit], return_index=True)
                pairs += [(uid[r], s["uid"][hit[f]]) for f in first.tolist()]
                if len(parts) > 1:
                    s["part"][np.isin(s["part"], parts)] = parts[0]
            a, b = np.array(pairs, np.int64).T
            yield np.ones(len(a), np.int8), a, b

        def settled(s):
            some = np.flatnonzero(s["count"])
            return np.zeros(len(some), np.int8), s["uid"][some], s["count"][some]

        def batch(x):
            return pa.RecordBatch.from_arrays([pa.array(c) for c in x], ["kind", "a", "b"])

        for b in batches:
            keys = [b.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            new = np.concatenate(([True], np.any([k[1:] != k[:-1] for k in keys], axis=0))) if b.num_rows else np.zeros(0, bool)
            starts = np.flatnonzero(new).tolist()
            for lo, hi in zip(starts, [*starts[1:], b.num_rows], strict=True):
                here = tuple(k[lo] for k in keys[:3])
                if here != at:
                    if state is not None:
                        yield batch(settled(state))
                    at, held, state = here, [], None
                if keys[3][lo] == 0:
                    held.append(b.slice(lo, hi - lo))
                elif held:
                    state = state or ready()
                    for k in range(lo, hi, 1024):
                        for x in links(state, b.slice(k, min(1024, hi - k))):
                            yield batch(x)
        if state is not None:
            yield batch(settled(state))

    return work
