"""Groups of texts that are alike, in and beyond a block: every link found, and no table of pairs made."""

import random

import numpy as np
import pytest

from loretable.llm import common, components, simhash


def variants(rng, n: int, length: int, changed: int, tag: str) -> list[str]:
    """Texts of one template, each with its own words in some places: two of them differ in about twice as many."""
    base = [f"{tag}{rng.randrange(5000)}" for _ in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for at in rng.sample(range(length), changed):
            words[at] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def roots_by_brute_force(texts: list[str]) -> list[int]:
    hashes = [simhash.shingle_hashes(t.encode(), 5) for t in texts]
    prints = []
    for h in hashes:
        own, mixed = [simhash.fingerprint_of(h)], h
        for _ in simhash.OTHERS:
            own.append(simhash.fingerprint_of(mixed := simhash._mixed(mixed)))
        prints.append(own)
    prints, sets, root = np.array(prints, np.uint64), [set(h.tolist()) for h in hashes], list(range(len(texts)))
    bits = lambda a, b: int(np.bitwise_count(a ^ b).sum())
    for i in range(len(texts)):
        for k in range(i):
            both = len(sets[i] & sets[k])
            if both >= 0.8 * (len(sets[i]) + len(sets[k]) - both) and bits(prints[i, :1], prints[k, :1]) <= simhash.STAGE_TAU and bits(prints[i, 1:], prints[k, 1:]) <= simhash.OTHERS_TAU:
                a, b = sorted((root[i], root[k]))
                root = [a if r == b else r for r in root]
    return root


@pytest.mark.parametrize("rows", [None, 7])
def test_groups_are_joined_as_by_brute_force(spark, monkeypatch, rows):
    if rows:
        monkeypatch.setattr(simhash, "GROUP_ROWS", rows)
    rng = random.Random(5)
    # dense (all linked), at the threshold (some linked), and alike without being linked
    texts = variants(rng, 60, 300, 2, "a") + variants(rng, 60, 300, 6, "b") + variants(rng, 40, 300, 8, "c") + [f"x{i} y z" for i in range(9)]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(r.doc_id for r in simhash.similar_dedup(docs).collect())
    want = roots_by_brute_force(texts)
    assert len(set(want)) > 40
    assert got == sorted(set(want))


def test_a_large_group_makes_no_table_of_pairs(spark, monkeypatch):
    """Texts that are alike and not linked: no table that is written grows with the square of their number."""
    written = {}

    def counted(df, name, *args):
        out = common.materialize(df, name, *args)
        written[name] = max(written.get(name, 0), out.count())
        return out

    monkeypatch.setattr(simhash, "materialize", counted)
    monkeypatch.setattr(components, "materialize", counted)
    texts = variants(random.Random(6), 300, 400, 11, "a")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert simhash.similar_dedup(docs).count() >= 290
    assert max(written.values()) <= 20 * len(texts), written
