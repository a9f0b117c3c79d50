"""Best-fit packing of tokenised documents into sequences by a grouping genetic algorithm on islands.

Pieces are dealt into blocks; a block is packed by islands, whose elites migrate. The algorithm prefers
fewer sequences and then a fill as uneven as can be, so that what room is left gathers in few of them.
The emptiest sequences of each block are opened again, and their pieces are dealt into blocks of the next
level, until one block is left: what the division into blocks costs is packed anew, level by level.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loretable.llm.common import documents_of, materialize
from loretable.llm.word_tokens import vocabulary_path, word_tokens

#: Pieces that are packed together. A block's islands hold a few assignments of so many pieces each.
BLOCK = 4000
#: One in so many of a block's sequences, the emptiest, goes on to the next level.
OPENED = 12
#: Spread of the noise by which the orders of an island's first assignments differ.
NOISE = 0.03
#: Islands of a block, assignments on each, generations between migrations, migrations, elites that move on.
ISLANDS, POPULATION, GENERATIONS, EPOCHS, ELITES = 3, 4, 6, 2, 1


def pieces(docs: DataFrame, capacity: int = 4096, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids and one end id, cut at capacity.

    Null and empty texts have the end id alone. Only documents of more than capacity ids are cut.
    """
    path = tokenizer or vocabulary_path("word_bpe_49k.json")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = word_tokens(path)
        for b in batches:
            docs_, texts = b.column(0), b.column(1)
            for lo in range(0, b.num_rows, 300):
                coded, counts = model.encode(texts.slice(lo, 300).to_pylist())
                # one end id behind each text
                counts = np.asarray(counts) + 1
                stream = np.full(counts.sum(), end_id, "<u4")
                stream[np.delete(np.arange(len(stream)), np.cumsum(counts) - 1)] = coded
                n = -(-counts // capacity)
                doc = np.repeat(np.arange(len(counts)), n)
                piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                length = np.minimum(capacity, counts[doc] - piece * capacity)
                at = (np.cumsum(counts) - counts)[doc] + piece * capacity
                data = memoryview(stream).cast("B")
                crc = [zlib.crc32(data[4 * a : 4 * e]) for a, e in zip(at.tolist(), (at + length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [docs_.slice(lo, 300).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(piece * capacity), pa.array(length), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return documents_of(docs).mapInArrow(work, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Bins:
    """Bins under construction; best fit finds the fullest bin with room in logarithmic time."""

    def __init__(self, capacity: int):
        self.capacity, self.members, self.rooms = capacity, [], []

    def add(self, members: list[int], used: int) -> None:
        self.members.append(members)
        if used < self.capacity:
            insort(self.rooms, (self.capacity - used, len(self.members) - 1))

    def best_fit(self, item: int, size: int) -> None:
        at = bisect_left(self.rooms, (size, -1))
        if at == len(self.rooms):
            self.add([item], size)
            return
        room, k = self.rooms.pop(at)
        self.members[k].append(item)
        if room > size:
            insort(self.rooms, (room - size, k))


def fitness(bins: list[list[int]], sizes: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins are better; of as many, those whose fill is less even (mean of squared fill)."""
    return -len(bins), sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins) / max(1, len(bins))


def seeded(sizes: list[int], capacity: int, rng: np.random.Generator, noise: float) -> list[list[int]]:
    """Best fit by falling size, with the order disturbed by noise."""
    bins = Bins(capacity)
    for i in np.argsort(-np.asarray(sizes) * (1 + noise * rng.standard_normal(len(sizes))), kind="stable").tolist():
        bins.best_fit(i, sizes[i])
    return bins.members


def crossover(a: list[list[int]], b: list[list[int]], sizes: list[int], capacity: int, rng: np.random.Generator) -> list[list[int]]:
    """Injects well-filled bins of b into a whole; bins of a that share a document with them go, and
    the documents so displaced are best-fitted by falling size."""
    fill = np.array([sum(sizes[i] for i in x) for x in b])
    good = np.flatnonzero(fill >= np.quantile(fill, 0.5))
    take = rng.permutation(good)[: max(1, len(good) // 2)].tolist()
    moved = {i for k in take for i in b[k]}
    out, displaced = Bins(capacity), []
    for k in take:
        out.add(list(b[k]), int(fill[k]))
    for x in a:
        if moved.isdisjoint(x):
            out.add(list(x), sum(sizes[i] for i in x))
        else:
            displaced += [i for i in x if i not in moved]
    for i in sorted(displaced, key=lambda i: -sizes[i]):
        out.best_fit(i, sizes[i])
    return out.members


def mutate(a: list[list[int]], sizes: list[int], capacity: int, rng: np.random.Generator) -> list[list[int]]:
    """Breaks up the emptiest bin and a few others and best-fits their documents again."""
    fill = [sum(sizes[i] for i in x) for x in a]
    broken = {int(np.argmin(fill)), *rng.integers(0, len(a), max(1, len(a) // 50)).tolist()}
    out = Bins(capacity)
    for k, x in enumerate(a):
        if k not in broken:
            out.add(list(x), fill[k])
    for i in sorted((i for k in broken for i in a[k]), key=lambda i: -sizes[i]):
        out.best_fit(i, sizes[i])
    return out.members


def evolve(population: list[list[list[int]]], sizes: list[int], capacity: int, rng: np.random.Generator, generations: int) -> list[list[list[int]]]:
    """The population after some generations, best first. In each a crossover of two assignments, at
    times mutated, takes the place of the worst unless it is worse still."""
    rated = sorted(((fitness(p, sizes, capacity), p) for p in population), key=lambda x: x[0], reverse=True)
    for _ in range(generations if len(rated) > 1 else 0):
        x, y = rng.choice(len(rated), 2, replace=False).tolist()
        child = crossover(rated[x][1], rated[y][1], sizes, capacity, rng)
        if rng.random() < 0.3:
            child = mutate(child, sizes, capacity, rng)
        rated = sorted([*rated, (fitness(child, sizes, capacity), child)], key=lambda x: x[0], reverse=True)[: len(population)]
    return [p for _, p in rated]


def _assignment(bins: list[list[int]], n: int) -> np.ndarray:
    out = np.empty(n, np.int32)
    for k, x in enumerate(bins):
        out[x] = k
    return out


def _bins(assignment: np.ndarray) -> list[list[int]]:
    order = np.argsort(assignment, kind="stable")
    return [x.tolist() for x in np.split(order, np.flatnonzero(np.diff(assignment[order])) + 1)]


def pack(items: DataFrame, capacity: int = 4096, block: int = BLOCK) -> DataFrame:
    """items (key struct, length) with sequence_id and offset: few sequences of at most capacity.

    Pieces are dealt by a hash into blocks of about as many each; a block's pieces live on some
    islands, each evolving assignments of its own. After each epoch the elites of an island move to
    the next one of its block by a shuffle; at last the best island's best one is taken (of equals the
    first island's). All but its emptiest sequences are closed; the pieces of those are packed again
    with those of other blocks. Blocks have a bounded size, so no task grows with the data, and each
    level holds a small share of the one before.
    """
    closed, level = None, 0
    while True:
        n = items.count()
        blocks = max(1, -(-n // block))
        placed = materialize(_packed_blocks(items, capacity, blocks, level), "placed")
        done = placed.where("not open").select("key", "length", "sequence_id", "offset")
        closed = done if closed is None else closed.unionByName(done)
        if blocks == 1:
            return closed
        items, level = placed.where("open").select("key", "length"), level + 1


def _packed_blocks(items: DataFrame, capacity: int, blocks: int, level: int) -> DataFrame:
    """items with sequence_id, offset and open: whether their sequence goes on to the next level."""
    keyed = items.select("key", "length", F.pmod(F.xxhash64("key", F.lit(level)), F.lit(blocks)).alias("block"))
    dealt = materialize(
        keyed.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("length", "key"))).alias("items")).select("block", "items", F.col("items.length").alias("sizes")), "pieces"
    )
    elites = None
    for epoch in range(EPOCHS):
        islands = dealt.select("block", "sizes", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"))
        if elites is None:
            frame = islands.withColumn("arrived", F.array().cast("array<binary>"))
        else:
            frame = islands.join(elites.groupBy("block", "island").agg(F.collect_list("one").alias("arrived")), ["block", "island"], "left")
        elites = materialize(frame.mapInPandas(_island(capacity, epoch), "block long, island int, one binary, bins int, even double"), "elites")
        if epoch < EPOCHS - 1:
            # the best of an island stay with it and also move on to the next one
            elites = elites.select("block", F.explode(F.array("island", (F.col("island") + 1) % ISLANDS)).alias("island"), "one")
    best = elites.groupBy("block").agg(F.max_by("one", F.struct(-F.col("bins"), F.col("even"), -F.col("island"))).alias("one"))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for blk, sizes, one in zip(f["block"], f["sizes"], f["one"], strict=True):
                s, a = np.asarray(sizes, np.int64), np.frombuffer(one, np.int32)
                order = np.argsort(a, kind="stable")
                run = np.cumsum(s[order]) - s[order]
                first = np.concatenate(([True], np.diff(a[order]) != 0))
                offset = np.empty(len(s), np.int64)
                offset[order] = run - np.repeat(run[first], np.diff(np.append(np.flatnonzero(first), len(s))))
                fill = np.bincount(a, s)
                emptiest = np.zeros(len(fill), bool)
                if blocks > 1:
                    emptiest[np.argsort(fill, kind="stable")[: -(-len(fill) // OPENED)]] = True
                yield pd.DataFrame({"block": blk, "at": np.arange(len(s)), "sequence_id": (level << 56) + (int(blk) << 24) + a.astype(np.int64), "offset": offset, "open": emptiest[a]})

    placed = best.join(dealt.select("block", "sizes"), "block").mapInPandas(place, "block long, at int, sequence_id long, offset long, open boolean")
    rows = dealt.select("block", F.posexplode("items").alias("at", "item")).select("block", "at", F.col("item.key").alias("key"), F.col("item.length").alias("length"))
    return rows.join(placed, ["block", "at"]).select("key", "length", "sequence_id", "offset", "open")


def _island(capacity: int, epoch: int):
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for block, sizes, island, arrived in zip(f["block"], f["sizes"], f["island"], f["arrived"], strict=True):
                sizes = np.asarray(sizes, np.int64).tolist()
                rng = np.random.default_rng([epoch, int(block), int(island)])
                population = [_bins(np.frombuffer(x, np.int32)) for x in (() if arrived is None else sorted(arrived))]
                while len(population) < POPULATION:
                    # the first island starts with plain best fit by falling size, so none ends worse than that
                    population.append(seeded(sizes, capacity, rng, NOISE * (int(island) + len(population))))
                found = evolve(population, sizes, capacity, rng, GENERATIONS)[:ELITES]
                rated = [fitness(p, sizes, capacity) for p in found]
                yield pd.DataFrame({"block": block, "island": island, "one": [_assignment(p, len(sizes)).tobytes() for p in found], "bins": [-r[0] for r in rated], "even": [r[1] for r in rated]})

    return work


def best_fit_packing(docs: DataFrame, capacity: int = 4096, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Sequences hold at most capacity ids; offsets in them have no gaps. Null and empty texts are a
    piece of the end id alone. Repeated rows are packed as often as they stand there. An empty table
    gives an empty result. A very long text is encoded as a whole by one task and cut. Pieces of equal length
    are placed in any order; which of them stands where says nothing.
    """
    cut = materialize(pieces(docs, capacity, tokenizer, end_id).withColumn("row", F.monotonically_increasing_id()), "cut")
    items = cut.select(F.struct("row", "doc_id", "piece", "start", "ids_crc32").alias("key"), "length")
    return pack(items, capacity).select("key.doc_id", "key.piece", "key.start", "length", "key.ids_crc32", "sequence_id", "offset")
