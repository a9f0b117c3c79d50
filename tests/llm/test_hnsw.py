import os

import numpy as np
import pytest

from loretable.llm import hnsw
from loretable.llm import queries as q

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = "vec_id long, embedding array<double>, rank int, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, 2.0) for i, v in rows], COLUMNS)


def brute(rows, asked, k):
    """(query, rank) -> (id, score) over usable rows, ties to the smaller id."""
    ok = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)}
    out = {}
    for a in asked:
        if a in ok:
            near = sorted((-float(ok[a] @ v), i) for i, v in ok.items() if i != a and len(v) == len(ok[a]))[:k]
            out |= {(a, r): (i, -s) for r, (s, i) in enumerate(near, 1)}
    return out


def test_graph_holds_its_levels_and_finds_neighbours():
    x = np.random.default_rng(3).normal(size=(3000, 24)) * np.random.default_rng(4).uniform(0.2, 3, size=(3000, 1))
    order, graph = hnsw.build(x)
    assert sorted(order) == list(range(3000)) and graph.sizes[0] == 3000 and graph.sizes == sorted(graph.sizes, reverse=True)
    for size, links in zip(graph.sizes, graph.links, strict=True):
        assert links.shape[0] == size and links.max() < size and not (links == np.arange(size)[:, None]).any()
        assert all(len(set(r[r >= 0])) == (r >= 0).sum() for r in links)
    queries = x[:200] / np.abs(x[:200]).max(axis=1, keepdims=True)
    found = graph.search(np.concatenate([queries, np.zeros((200, 1))], axis=1).astype(np.float32), 96)
    true = np.argsort(-(x[:200] @ x.T), axis=1)[:, :10]
    assert np.mean([len(set(order[f[f >= 0]][:10]) & set(t)) / 10 for f, t in zip(found, true, strict=True)]) > 0.95


@pytest.mark.parametrize("shard", [7, 4000])
def test_small_tables_equal_brute_force(spark, shard):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-4, 5, 6).tolist()) for i in range(60)]
    # copies beyond k, ties, another length, and rows that take no part
    rows += [(100 + i, [3, 3, 3, 3, 3, 3]) for i in range(30)] + [(200 + i, [1.0, i, 2.0]) for i in range(3)]
    rows += [(300, None), (301, [0] * 6), (302, [1, None, 1, 1, 1, 1]), (303, [float("nan")] * 6), (304, [float("inf"), 0, 0, 0, 0, 0]), (None, [9] * 6), (305, []), (40, rows[40][1])]
    asked = [0, 20, 40, 100, 120, 200, 300, 301, 302, 303]
    table = frame(spark, rows)
    got = hnsw.nearest_vectors(table, table.where(f"vec_id in ({', '.join(map(str, asked))})"), k=5, shard=shard, wave=3)
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got.collect()} == brute(rows, asked, 5)


def test_large_values_and_one_row(spark):
    rows = [(0, [1e150, 0.0]), (20, [1e-150, 1e-150]), (1, [5e149, 1.0])]
    table = frame(spark, rows)
    got = {(r.query_id, r["rank"]): r.vec_id for r in hnsw.nearest_vectors(table, table.where("vec_id % 20 = 0"), k=2).collect()}
    assert got == {(0, 1): 1, (0, 2): 20, (20, 1): 0, (20, 2): 1}
    assert hnsw.nearest_vectors(table.limit(0), table, k=2).count() == 0
    assert hnsw.nearest_vectors(table.where("vec_id = 0"), table.where("vec_id = 0"), k=2).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the tables")
def test_query_recall_and_scores(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in q.QUERIES["op13_nearest_neighbours"](spark, SF).collect()}
    want = brute(rows, [i for i, _ in rows if i % 20 == 0], 20)
    assert set(got) == set(want)
    vectors = {i: np.array(v, float) for i, v in rows}
    assert all(abs(s - vectors[a] @ vectors[i]) < 1e-12 for (a, _), (i, s) in got.items())
    asked = {a for a, _ in want}
    hits = [len({v[0] for k, v in got.items() if k[0] == a} & {v[0] for k, v in want.items() if k[0] == a}) / 20 for a in asked]
    assert np.mean(hits) > 0.95


def test_measured_recall(spark):
    rng = np.random.default_rng(2)
    table = frame(spark, [(i, rng.normal(size=8).tolist()) for i in range(400)])
    queries = table.where("vec_id % 20 = 0")
    found = hnsw.nearest_vectors(table, queries, k=5, shard=100)
    assert hnsw.measured_recall(table, found, queries, k=5) > 0.95
    assert hnsw.measured_recall(table, found.where("rank <= 2"), queries, k=5) < 0.5
