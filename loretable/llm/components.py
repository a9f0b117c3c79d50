"""Connected components of a link table by contraction of pieces and alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loretable.llm.common import materialize, spread_join

#: Links that a task holds at once.
PIECE = 1 << 16


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for every node of these links but the smallest of each component, which is the root."""
    nodes, ids = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = ids[: len(u)], ids[len(u) :]
    label = np.arange(len(nodes))
    while (open_ := label[a] != label[b]).any():
        a, b = label[a[open_]], label[b[open_]]  # smallest nodes of what is joined so far
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while ((up := label[label]) != label).any():
            label = up
    low = label < np.arange(len(nodes))
    return nodes[low], nodes[label[low]]


def _contracted(edges: DataFrame, pieces: int) -> DataFrame:
    """edges (u, v) with the components of each piece of PIECE links made stars."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def settle() -> pa.RecordBatch:
            found = stars(*(np.concatenate([b.column(i).to_numpy() for b in held]) for i in (0, 1)))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["u", "v"])

        for b in batches:
            if n + b.num_rows > PIECE and held:
                yield settle()
                held, n = [], 0
            held.append(b)
            n += b.num_rows
        if held:
            yield settle()

    return edges.coalesce(pieces).mapInArrow(work, "u long, v long")


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node of its component.

    Each round contracts pieces of PIECE links, dealt to as many tasks as there are pieces; if there is
    one piece only, that is all. Otherwise it then replaces links by links to the smallest neighbour (large
    star: larger neighbours; small star: smaller ones). All steps are grouped minima with map-side combining and joins on
    nodes in which a node with very many links is dealt to several tasks, and the number of links
    does not grow. Rounds grow with the logarithm of the longest path. Each round is written to the
    shared folder. Null ends and self links are ignored; no links give an empty table.
    """
    edges = materialize(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u is not null and v is not null and u <> v").distinct(), "links"
    )
    before = None
    for _ in range(max_rounds):
        pieces = -(-edges.count() // PIECE) or 1
        edges = materialize(_contracted(edges, pieces).distinct() if pieces > 1 else _contracted(edges, 1), "contracted")
        if pieces == 1:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n")), "least")
        large = spread_join(both, least, "u", "n").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # every link now leads from a larger to a smaller node
        large = materialize(large, "large")
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "low")
        small = (
            spread_join(large, low, "u", "n").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v")
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        )
        edges = materialize(small, "links")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
