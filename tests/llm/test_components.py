"""Components of small and large link tables; what is written and broadcast for them is small."""

import pickle
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loretable.llm import common, components


def least_of_each(links: list[tuple[int, int]]) -> dict[int, int]:
    root = {x: x for link in links for x in link}
    for a, b in links:
        low, high = sorted((root[a], root[b]))
        root = {x: low if r == high else r for x, r in root.items()}
    return root


def mixed_links(rng) -> list[tuple[int, int]]:
    path = [(i, i + 1) for i in range(1000, 1060)]
    star = [(7, i) for i in range(2000, 2060)]
    some = [(rng.randrange(3000, 3150), rng.randrange(3000, 3150)) for _ in range(90)]
    links = path + star + [x for x in some if x[0] != x[1]]
    rng.shuffle(links)
    return links


def test_stars_of_links():
    for seed in range(50):
        links = mixed_links(random.Random(seed))
        nodes, roots = components.stars(*np.array(links).T)
        want = least_of_each(links)
        assert dict(zip(nodes.tolist(), roots.tolist(), strict=True)) == {x: r for x, r in want.items() if x != r}


@pytest.mark.parametrize("piece", [1 << 16, 40])
def test_pieces_join_the_same_nodes(spark, monkeypatch, piece):
    monkeypatch.setattr(components, "PIECE", piece)
    links = mixed_links(random.Random(3))
    got = components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == least_of_each(links)
    assert len(got) == len({x for link in links for x in link})


def test_a_small_link_table_takes_two_tables(spark, monkeypatch):
    written = []
    monkeypatch.setattr(components, "materialize", lambda df, name: written.append(name) or common.materialize(df, name))
    components.connected_components(spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long"))
    assert len(written) == 2, written


@pytest.mark.parametrize("bits", [26, 8])
@pytest.mark.parametrize("keys", [[], [3, None, 70], list(range(0, 4000, 2))])
def test_a_filter_of_few_keys_is_sent_small_and_misses_none(spark, monkeypatch, keys, bits):
    context, sent = type(spark.sparkContext), []
    broadcast = context.broadcast
    monkeypatch.setattr(context, "broadcast", lambda self, value: sent.append(len(pickle.dumps(value))) or broadcast(self, value))
    test = common.member_test(spark.createDataFrame([(k,) for k in keys], "k long"), "k", bits)
    assert len(sent) == 1 and sent[0] < 100_000
    asked = [*range(4000), None]
    got = {r.k for r in spark.createDataFrame([(k,) for k in asked], "k long").where(test(F.col("k"))).collect()}
    assert got >= set(keys)
    if bits == 26:
        assert len(got) <= len(keys) + 2
