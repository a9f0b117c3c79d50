"""The registered queries over the smallest tables: columns, held-out rows, thresholds, and results by brute force or SQL."""

import hashlib
import math
import os
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import xxhash
from test_dedup import roots

from loretable.llm import queries as q
from loretable.llm.word_tokens import vocabulary_path, word_tokens

sys.path.insert(0, str(Path(__file__).parents[1]))
import oracle

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the tables")


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def run(spark, name, columns):
    df = q.QUERIES[name](spark, SF)
    assert set(columns) <= set(df.columns)
    return df.collect()


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


@pytest.mark.parametrize(("name", "modulus", "held", "threshold"), [("op1_toxicity", 3, 1, 0.7), ("op9_quality", 5, 0, 0.3)])
def test_classifiers(spark, documents, name, modulus, held, threshold):
    rows = run(spark, name, ["doc_id", "held_out", "score", "predicted"])
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    for r in rows:
        assert r.held_out == (remainder(r.doc_id, modulus) == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)


LARGE = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(LARGE), reason="needs the tables")
@pytest.mark.parametrize(("name", "label", "auc", "recall", "wrong"), [("op1_toxicity", "toxic", 0.95, 0.85, 0.01), ("op9_quality", "quality", 0.98, 0.95, 0.2)])
def test_held_out_rows_are_told_apart(spark, name, label, auc, recall, wrong):
    """Floors of what the classifiers reach on rows that they did not learn from."""
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{LARGE}/labels.parquet").collect()}
    rows = [(r.score, r.predicted, truth[r.doc_id]) for r in q.QUERIES[name](spark, LARGE).where("held_out").collect() if truth.get(r.doc_id) in (0, 1)]
    ones, zeros = np.array([s for s, _, y in rows if y]), np.array([s for s, _, y in rows if not y])
    assert len(ones) > 100 and len(zeros) > 100
    assert np.mean([(ones > z).mean() + 0.5 * (ones == z).mean() for z in zeros]) > auc
    assert np.mean([p for _, p, y in rows if y]) > recall and np.mean([p for _, p, y in rows if not y]) < wrong


def test_op2(spark):
    rows = run(spark, "op2_embedding_near_dedup", ["vec_id", "n_links", "component_id", "kept"])
    vectors = {r.vec_id: (np.array(r.embedding, float), r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    ids = sorted(i for i, (v, y) in vectors.items() if y is not None and np.isfinite(v).all() and v.any())
    x = np.stack([vectors[i][0] / np.linalg.norm(vectors[i][0]) for i in ids])
    y = np.array([vectors[i][1] for i in ids])
    a, b = np.nonzero(np.triu((x @ x.T >= 0.93) & (y[:, None] == y), 1))
    links = [(ids[i], ids[j]) for i, j in zip(a.tolist(), b.tolist(), strict=True)]
    counts, want = Counter(i for pair in links for i in pair), roots(vectors, links)
    assert sorted(r.vec_id for r in rows) == sorted(vectors)
    assert sum(r.n_links for r in rows) >= 0.98 * 2 * len(links) and all(r.n_links <= counts[r.vec_id] for r in rows)
    assert np.mean([r.component_id == want[r.vec_id] for r in rows]) > 0.98 and all(r.kept == (r.vec_id == r.component_id) for r in rows)


def test_op3(spark, documents):
    rows = run(spark, "op3_language_model", ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    tokens = {i: [*re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower()), None] for i, t in documents.items()}
    counts = Counter(w for i, words in tokens.items() if remainder(i, 7) != 2 for w in words)
    n = sum(counts.values())
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    for r in rows:
        words = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (remainder(r.doc_id, 7) == 2, len(words), sum(counts[w] > 0 for w in words), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + len(counts) + 1)) for w in words), rel_tol=1e-9)
        assert r.score < 0
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_op4(spark, documents):
    rows = run(spark, "op4_token_counts", ["source", "lang", "version", "documents", "tokens"])
    got = Counter()
    for r in rows:
        got[r.version, "documents"] += r.documents
        got[r.version, "tokens"] += r.tokens
    model = word_tokens(vocabulary_path("word_bpe_49k.json")).model
    assert got["word_bpe_49k", "documents"] == got["byte_bpe_50k", "documents"] == len(documents)
    assert got["word_bpe_49k", "tokens"] == sum(len(model.encode(t, add_special_tokens=False).ids) for t in documents.values())
    assert got["words", "documents"] == sum(not t.strip(" ") for t in documents.values())
    groups, want = {(r.source, r.lang): (r.documents, r.tokens) for r in rows if r.version == "word_bpe_49k"}, Counter()
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang").collect():
        want[r.source, r.lang, 0] += 1
        want[r.source, r.lang, 1] += len(model.encode(documents[r.doc_id], add_special_tokens=False).ids)
    assert groups == {(s, x): (want[s, x, 0], want[s, x, 1]) for s, x, _ in want}


def test_op5(spark, documents):
    rows = run(spark, "op5_best_fit_packing", ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    model = word_tokens(vocabulary_path("word_bpe_49k.json")).model
    want = {}
    for i, t in documents.items():
        ids = np.array([*model.encode(t, add_special_tokens=False).ids, 1], "<u4")
        want |= {(i, k): (at, len(p := ids[at : at + 4096]), zlib.crc32(p.tobytes())) for k, at in enumerate(range(0, len(ids), 4096))}
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    used = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used[r.sequence_id]
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 4096 and len(used) <= -(-sum(used.values()) // 4096) + 1


def test_op7(spark, documents):
    rows = run(spark, "op7_simhash_near_dedup", ["doc_id", "fingerprint", "component_id"])
    fps = {}
    for i, t in documents.items():
        words = re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower())
        shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        fps[i] = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    ids = sorted(fps)
    want = roots(fps, [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (fps[a] ^ fps[b]).bit_count() <= 4])
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{fps[i]:016x}", want[i]) for i in ids}


def test_op8(spark, documents):
    import public_tokenizers
    import tiktoken

    from loretable.llm.bpe_tree import read_ranks

    model = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    rows = run(spark, "op8_byte_bpe", ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    for r in rows:
        ids = model.encode_ordinary(documents[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(documents[r.doc_id].encode()).hexdigest())


@pytest.mark.parametrize("name", sorted(q.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    assert not oracle.difference(spark, SF, name, q.QUERIES[name], q.ORACLE_SQL[name])
