import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loretable.llm import simhash
from loretable.llm.components import connected_components
from loretable.llm.exact_dedup import exact_dedup, exact_groups

SCHEMA = "doc_id long, text string, lang string, source string, keep_id string, h int, fp string"
BLANK = " \t\n\x0b\x0c\r"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", "x", 1, "y") for i, t in rows], SCHEMA).repartition(3)


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def expected_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault("".join(c for c in t or "" if c not in BLANK), []).append((-len(t or ""), i))
    out = []
    for i, t in rows:
        norm = "".join(c for c in t or "" if c not in BLANK)
        keep = min(groups[norm])[1]
        out.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out)


ROWS = [(1, "a b"), (2, "ab"), (3, "a  b"), (4, None), (5, ""), (6, " \n"), (7, " "), (8, "x" * 50_000), (9, "x" * 50_000), (10, "é"), (11, "é"), (12, "a\x0bb\x0c")]


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(spark, weak):
    """With a hash of one letter, groups hold colliding texts that only the bytes tell apart."""
    rows = ROWS + [(20 + i, random.Random(i).choice(["p q", "pq", "q  p", "qp", "r"])) for i in range(40)]
    got = exact_groups(frame(spark, rows), *([lambda c: F.substring(F.md5(c), 1, 1)] if weak else []))
    assert sorted(map(tuple, got.collect())) == expected_exact(rows)


def test_exact_dedup_keeps_columns(spark):
    got = exact_dedup(frame(spark, ROWS + [(1, "a b")]))
    assert got.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
    assert sorted(r.doc_id for r in got.collect()) == sorted({r[1] for r in expected_exact(ROWS)})


def test_empty_tables(spark):
    assert exact_groups(frame(spark, [])).count() == 0
    assert exact_dedup(frame(spark, [])).count() == 0
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_null_ids(spark):
    got = exact_groups(frame(spark, [(None, "a"), (3, "a"), (None, "b")])).collect()
    assert sorted((r.doc_id or -1, r.keep_id or -1, r.kept) for r in got) == [(-1, -1, True), (-1, 3, False), (3, 3, True)]


@pytest.mark.parametrize("dedup", [exact_dedup, simhash.near_dedup])
def test_null_and_repeated_ids_lose_no_text(spark, dedup):
    """Rows go by id and text: a null or repeated id of which one text is a copy keeps its others."""
    text = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abcdef"}
    rows = [(3, text["a"]), (None, text["a"]), (None, text["b"]), (None, text["c"]), (7, text["d"]), (7, text["a"]), (7, text["e"]), (8, text["f"]), (8, text["f"])]
    rows += [(None, text["c"])]
    got = dedup(frame(spark, rows)).collect()
    want = [(3, text["a"]), (7, text["d"]), (7, text["e"]), (8, text["f"]), (None, text["b"]), (None, text["c"])]
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(want, key=str)


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    links = [x for x in links if x[0] is not None and x[0] != x[1]]
    nodes = {x for pair in links for x in pair}
    assert got == roots(nodes, links)


def plain_fingerprint(text, n):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").translate({ord(c): " " for c in BLANK}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdéÀ") for _ in range(rng.randint(1, 5)))
    rows = [(100, None), (101, ""), (102, " \t"), (103, "Ab"), (104, "aB  "), (105, "one two three"), (106, "ONE  two\nthree")]
    for i in range(30):
        base = [word() for _ in range(rng.randint(3, 120))]
        for k in range(rng.randint(1, 5)):
            copy = [word() if rng.random() < 0.015 * k else w for w in base]
            rows.append((200 + 10 * i + k, " ".join(copy)))
    return rows


@pytest.mark.parametrize("block", [simhash.BLOCK, 7])
def test_near_duplicates_against_all_pairs(spark, block, monkeypatch):
    """Also with buckets dealt into tiny blocks, and groups compared node by node."""
    if block == 7:
        monkeypatch.setattr(simhash.near_links, "__defaults__", (4, 7))
    rows = near_texts()
    fps = {i: plain_fingerprint(t, 4) for i, t in rows}
    want = roots(fps, [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 4])
    got = simhash.near_duplicates(frame(spark, rows), shingle=4, tau=4).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{fps[i]:016x}", want[i]) for i in fps}
    stay = simhash.near_dedup(frame(spark, rows), shingle=4, tau=4)
    assert sorted(r.doc_id for r in stay.collect()) == sorted(set(want.values()))


@pytest.mark.parametrize(("m", "tau"), [(3, 4), (4, 4), (2, 3), (5, 4), (1, 1)])
def test_general_pigeonhole_links(spark, m, tau, monkeypatch):
    """Any allotment with sum(t + 1) = tau + 1 connects the same fingerprints, dense clusters too."""
    rng = np.random.default_rng(m)
    centres = rng.integers(0, 2**63, 4, np.uint64)
    fps = {int(c) for c in centres}
    for c in centres.tolist():
        for _ in range(60):
            fps.add(c ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)))
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    bits = simhash.correlated_parts(np.array(sorted(fps), np.uint64), m)
    spare = tau + 1 - m
    parts = [simhash.Part(p, spare if i == 0 else 0) for i, p in enumerate(bits)]
    monkeypatch.setattr(simhash, "allot", lambda *_: parts)
    got = connected_components(simhash.near_links(spark.createDataFrame([(s,) for s in signed], "fp long"), tau, 16))
    want = roots(signed, [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= tau])
    got = {r.node: r.root for r in got.collect()}
    assert {s: got.get(s, s) for s in signed} == want


def test_allotment_rule():
    rng = np.random.default_rng(0)
    sample = rng.integers(0, 2**63, 500, np.uint64)
    for n in (10, 10**5, 10**9):
        parts = simhash.allot(sample, n, 4)
        bits = [b for p in parts for b in p.bits]
        assert len(bits) == len(set(bits)) and sum(p.threshold + 1 for p in parts) == 5
