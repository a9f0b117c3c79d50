import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loretable.llm import language_model as lm

NAMES = "doc_id long, text string, block string, n long, score string"
BLANK = {ord(c): " " for c in "\t\n\x0b\x0c\r"}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], NAMES).repartition(3)


def tokens(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "").translate(BLANK)
    return [w for w in low.split(" ") if w] + [None]


def corpus(n=150, seed=0):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeÉ") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    rows = []
    for i in range(n):
        at, text = rng.randrange(60), []
        for _ in range(rng.randint(0, 40)):
            at = (at * 7 + rng.choice([1, 1, 1, 2, 30])) % 60
            text.append(words[at] if rng.random() < 0.95 else f"new{rng.random()}")
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(text)))
    return rows + [(500, None), (501, ""), (502, " "), (503, "A b\x0bA"), (3, "twice the id")]


def plain(rows, learns, held, order, weights, types, n):
    """The same model by dictionaries: scores of all rows."""
    grams, contexts = Counter(), Counter()
    for i, t in rows:
        if not learns(i):
            continue
        x = tokens(t)
        padded = [None] * (order - 1) + x
        for p in range(len(x)):
            for k in range(1, order + 1):
                g = tuple(padded[p + order - k : p + order])
                grams[g] += 1
                contexts[k, g[:-1]] += 1
    out = []
    for i, t in rows:
        x = tokens(t)
        padded, score, base, known = [None] * (order - 1) + x, 0.0, 0.0, 0
        for p in range(len(x)):
            bucket, parts = 0, []
            for k in range(1, order + 1):
                g = tuple(padded[p + order - k : p + order])
                c = contexts[k, g[:-1]]
                parts.append(grams[g] / c if c else 0.0)
                if k > 1 and c:
                    bucket = (k - 2) * lm.BUCKETS + min(1 + int(np.log2(c)), lm.BUCKETS - 1)
            w = weights[bucket]
            score += np.log10(sum(a * b for a, b in zip(w, parts)) + w[-1] / (types + 1))
            base += np.log10((grams[(x[p],)] + 1) / (n + types + 1))
            known += grams[(x[p],)] > 0
        out.append((i, len(x), known, n, round(base, 6), round(score, 6)))
    return sorted(out)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_by_definition(spark, order, monkeypatch):
    monkeypatch.setattr(lm, "SLICE_KEYS", 300)
    caught = {}
    learn = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda *a: caught.setdefault("w", learn(*a)))
    rows = corpus()
    got = lm.score_documents(frame(spark, rows), F.col("doc_id") % 4 != 1, order, block_bytes=700).collect()
    train = [t for i, r in rows if i % 4 != 1 for t in tokens(r)]
    want = plain(rows, lambda i: i % 4 != 1, None, order, caught["w"], len(set(train)), len(train))
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got) == want
    assert np.allclose(caught["w"].sum(axis=1), 1) and (caught["w"] > 0).all()


def test_held_out_gain(spark):
    got = lm.score_documents(frame(spark, corpus(400)), F.col("doc_id") % 5 != 0, 2).where("doc_id % 5 = 0").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1] * 0.9


def test_weights_raise_the_likelihood():
    import pandas as pd

    cells = pd.DataFrame({"cell": [1, 2], "bucket": [3, 3], "n": [80, 20], "p1": [0.1 * 80, 0.01 * 20], "p2": [0.9 * 80, 0.0]})
    w = lm.learn_weights(cells, 2, 1e-4)[3]
    likelihood = lambda w: 80 * np.log(0.1 * w[0] + 0.9 * w[1] + 1e-4 * w[2]) + 20 * np.log(0.01 * w[0] + 1e-4 * w[2])
    for _ in range(200):
        other = np.abs(w + np.random.default_rng(_).normal(0, 0.05, 3))
        assert likelihood(other / other.sum()) <= likelihood(w) + 1e-3


def test_edges(spark):
    assert lm.score_documents(frame(spark, []), F.lit(True)).count() == 0
    got = lm.score_documents(frame(spark, [(None, "a b"), (2, None)]), F.lit(False)).collect()
    assert sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens) for r in got) == [(-1, 3, 0, 0), (2, 1, 0, 0)]
    assert all(np.isfinite(r.score) and r.base_score == 0 for r in got)
