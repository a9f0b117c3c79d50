import math

import numpy as np
import pytest
from test_dedup import roots

from loretable.llm import embedding_dedup as e

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, uid int, cell int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, y, "x", 0, 1) for i, v, y in rows], SCHEMA).repartition(3)


def sample_rows(n=260, width=16, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        v = rng.normal(size=width)
        for _ in range(rng.integers(1, 4)):
            rows.append((len(rows), (v + rng.normal(size=width) * 0.06).astype(np.float32).tolist(), int(k % 3)))
    base = rng.normal(size=width)
    rows += [(len(rows) + j, (base + rng.normal(size=width) * 0.08).astype(np.float32).tolist(), 1) for j in range(120)]
    rows += [(len(rows) + j, base.astype(np.float32).tolist(), 1) for j in range(40)]
    rows += [(len(rows) + j, base.astype(np.float32).tolist(), 2) for j in range(3)]
    return rows


ODD = [(9001, None, 1), (9002, [0.0] * 16, 1), (9003, [math.nan] * 16, 1), (9004, [None] + [1.0] * 15, 1), (9005, [math.inf] * 16, 1), (9006, [1.0] * 16, None), (9007, [1.0] * 16, None), (9008, [], 1), (None, [3.0] * 16, 1), (9010, [1.0, 2.0], 1), (9011, [2.0, 4.0], 1)]


def expected(rows, threshold):
    good = [r for r in rows if r[2] is not None and r[1] and all(c is not None and math.isfinite(c) for c in r[1]) and any(r[1])]
    links = []
    for a in range(len(good)):
        for b in range(a + 1, len(good)):
            x, y = np.array(good[a][1]), np.array(good[b][1])
            if good[a][2] == good[b][2] and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links.append((good[a][0], good[b][0]))
    return links


@pytest.mark.parametrize("block", [e.BLOCK, 9])
def test_against_all_pairs(spark, block):
    rows = sample_rows()
    links = expected(rows, 0.93)
    got = {r.vec_id: r for r in e.near_embeddings(table(spark, rows + ODD), 0.93, block=block).collect()}
    assert len(got) == len(rows) + len(ODD)
    counts = {i: 0 for i, *_ in rows}
    for a, b in links:
        counts[a] += 1
        counts[b] += 1
    found = sum(got[i].n_links for i in counts)
    assert all(got[i].n_links <= counts[i] for i in counts) and found >= 0.98 * sum(counts.values())
    want = roots(counts, links)
    assert np.mean([got[i].component_id == want[i] for i in counts]) > 0.98
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    for i in (9001, 9002, 9003, 9004, 9005, 9006, 9007, 9008):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[9011].component_id == 9010 and got[9010].n_links == 1


def test_rare_pairs_are_found(spark):
    """Few pairs at just above the threshold in many unrelated vectors: nearly all links are found."""
    rng = np.random.default_rng(7)
    x = e.unit(rng.normal(size=(20_000, 32)))
    away = rng.normal(size=(40, 32))
    away -= (away * x[:40]).sum(axis=1, keepdims=True) * x[:40]
    near = 0.94 * x[:40] + math.sqrt(1 - 0.94**2) * e.unit(away)
    rows = [(i, v.tolist(), "one") for i, v in enumerate(np.concatenate((x, near)))]
    got = e.near_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string"), 0.93).where("n_links > 0").collect()
    assert len([r for r in got if r.vec_id in range(40) or r.vec_id >= 20_000]) >= 0.98 * 80


def test_double_precision_and_types(spark):
    """Vectors of doubles are not rounded, labels of text and truth values are compared as they are."""
    a, b = [1.0, 0.0], [0.93, math.sqrt(1 - 0.93**2)]
    near = [0.93 * (1 - 1e-9), math.sqrt(1 - (0.93 * (1 - 1e-9)) ** 2)]
    for kind, label, other in (("string", "x", "y"), ("boolean", True, False), ("double", 1.5, 2.5)):
        rows = [(1, a, label), (2, [0.93 * (1 + 1e-9), math.sqrt(1 - (0.93 * (1 + 1e-9)) ** 2)], label), (3, near, label), (4, a, other), (5, b, None)]
        got = {r.vec_id: (r.n_links, r.component_id) for r in e.near_embeddings(spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}"), 0.93).collect()}
        assert got[4] == (0, 4) and got[5] == (0, 5) and got[1] == (1, 1), (kind, got)


def test_empty_and_unusable(spark):
    assert e.near_embeddings(table(spark, []), 0.93).count() == 0
    assert e.near_embeddings(table(spark, ODD[:8]), 0.93).count() == 8


def test_visits_are_the_nearest_cells_in_order():
    rng = np.random.default_rng(1)
    x = e.unit(rng.normal(size=(300, 10)))
    grid = e.Grid(x, 7)
    a, b = grid.parts(x)
    total = (a[:, :, None] + b[:, None, :]).reshape(len(x), -1)
    for cells in (1, 5, 20, 49):
        visits = grid.visits(x, cells)
        assert np.allclose(np.take_along_axis(total, visits, 1), np.sort(total, axis=1)[:, :cells])
    assert (grid.visits(x, 1)[:, 0] == grid.own(x)).all()
    assert (grid.rank(x, grid.visits(x, 6)[:, 5]) == 6).all()


def test_cells_without_evidence(spark):
    """No query has a partner: pairs at the threshold must still find each other, not only in their own cell."""
    rng = np.random.default_rng(2)
    x = e.unit(rng.normal(size=(3000, 32)))
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    distinct = spark.createDataFrame([(i, y, v) for i, v, y in rows], "uid long, label long, embedding array<float>")
    grid = e.Grid(x, 14)
    cells = e.cells_needed(distinct, grid, len(x), 0.93, e.RECALL, queries=64, asked=128)
    assert cells > 1
    fresh = e.unit(rng.normal(size=(500, 32)))
    away = rng.normal(size=fresh.shape)
    away -= (away * fresh).sum(axis=1, keepdims=True) * fresh
    near = 0.93 * fresh + math.sqrt(1 - 0.93**2) * e.unit(away)
    ranks = np.minimum(grid.rank(fresh, grid.own(near)), grid.rank(near, grid.own(fresh)))
    assert (ranks <= 1).mean() < 0.9 < 0.97 < (ranks <= cells).mean()


def test_queries_count_alike_and_blocks_follow(spark):
    """A dense cluster does not outweigh other queries, and further blocks are asked."""
    rng = np.random.default_rng(4)
    x = e.unit(rng.normal(size=(400, 16)))
    y = e.unit(x + rng.normal(size=x.shape) * 0.07)
    dense = e.unit(x[0] + rng.normal(size=(300, 16)) * 0.001)
    every = np.concatenate((x, y, dense))
    distinct = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(every)], "uid long, label long, embedding array<float>")
    grid = e.Grid(every, 10)
    cells = e.cells_needed(distinct, grid, len(every), 0.9, 0.97, queries=8, enough=len(every))
    ranks = grid.rank(x, grid.own(y))[(x * y).sum(axis=1) >= 0.9]
    assert (ranks <= cells).mean() >= 0.95
