"""SimHash near-duplicates: fingerprints of word shingles, linked by the general pigeonhole rule.

If the 64 bits are split into parts with thresholds t_i (t_i >= -1) and sum(t_i + 1) = tau + 1,
two fingerprints at tau or fewer differing bits differ in at most t_i bits in some part i. So it is
enough to look up, part by part, the values within t_i bits. Parts are formed of correlated bits;
thresholds are allotted by dynamic programming on candidate counts estimated from a sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loretable.llm.common import documents_of, materialize, member_test, share_of, spread_join, without
from loretable.llm.components import connected_components

#: Fingerprints read to the driver to choose parts and thresholds. They only steer speed, not results.
SAMPLE = 2000
#: Rows of a bucket that one task holds at once; larger buckets are dealt into blocks.
BLOCK = 4096
#: Groups up to this size are compared all at once, larger ones node by node.
SMALL = 16
#: The pipeline's stage: bits within which texts become candidates, the Jaccard similarity of near copies,
#: and with how many of its nearest candidates a text is compared at once (16 times as many in each further step).
STAGE_TAU, SIMILAR, NEAREST = 14, 0.8, 16
#: Texts and shingles of a group of candidates that one task compares; larger groups are dealt into blocks.
GROUP_ROWS, GROUP_SHINGLES = 1024, 1 << 19
#: Further fingerprints of candidates, and bits in which they may differ together: of their 448 bits texts that met by
#: chance differ in 224 on average, those with a similarity of 0.8 in 65 (one in 200 in over 86), of 0.7 in 84, of 0.6 in 100.
OTHERS, OTHERS_TAU = [f"more{k}" for k in range(7)], 86


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of words, in order; of all words if they are fewer; none of a blank text."""
    words = text.lower().split()  # bytes: lowers A-Z only, splits at [\x20\x09-\x0D]
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    h64 = xxhash.xxh64_intdigest
    return np.array([h64(joined[s:e], 42) for s, e in zip(starts[: -shingle + 1 or None].tolist(), ends[shingle - 1 :].tolist(), strict=True)], np.uint64)


def text_key(text: Column) -> Column:
    """What tells whole texts apart in tables that do not hold them."""
    return F.sha2(text, 256)


def fingerprint_of(hashes: np.ndarray) -> int:
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, shingle: int) -> int:
    """64 bits: bit i is set if it is set in over half of the shingles' XXH64 (seed 42)."""
    return fingerprint_of(shingle_hashes(text, shingle))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(docs: DataFrame, shingle: int = 5, keyed: bool = False) -> DataFrame:
    """(doc_id, fp) with fp as a signed long; null and empty texts have fp 0.

    keyed: the text's key, further fingerprints (of the same hashes, mixed) and the number of its distinct
    shingles too.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps, others, sizes = [], [], []
            for text in b.column(1):
                hashes = shingle_hashes(text.as_py().encode(), shingle)
                fps.append(fingerprint_of(hashes))
                if keyed:
                    mixed = hashes
                    for _ in OTHERS:
                        others.append(fingerprint_of(mixed := _mixed(mixed)))
                    sizes.append(len(np.unique(hashes)))
            columns = [b.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))]
            if keyed:
                further = np.array(others, np.uint64).view(np.int64).reshape(-1, len(OTHERS))
                columns += [b.column(2), *map(pa.array, further.T.copy()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", "key", *OTHERS, "n"][: len(columns)])

    texts = documents_of(docs)
    return texts.withColumn("key", text_key(F.col("text"))).mapInArrow(work, f"doc_id long, fp long, key string, {', '.join(f'{c} long' for c in OTHERS)}, n long") if keyed else texts.mapInArrow(work, "doc_id long, fp long")


@dataclass(frozen=True)
class Part:
    bits: tuple[int, ...]
    threshold: int


def _values(fps: np.ndarray, bits: tuple[int, ...]) -> np.ndarray:
    """The bits of a part, packed into the low end of a word."""
    out = np.zeros(len(fps), np.uint64)
    for k, b in enumerate(bits):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def correlated_parts(sample: np.ndarray, m: int) -> list[tuple[int, ...]]:
    """64 bits in m parts of nearly equal width, each grown from a bit by its strongest correlations."""
    x = ((sample[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(float)
    x = x - x.mean(axis=0) if len(x) else np.zeros((1, 64))
    size = np.sqrt((x * x).sum(axis=0))
    c = np.abs(x.T @ x) / np.maximum(np.outer(size, size), 1e-12)  # 0 for bits that never change
    np.fill_diagonal(c, 0)
    free, parts = set(range(64)), []
    for i in range(m):
        width = (64 - 64 * i // m) - (64 - 64 * (i + 1) // m)
        part = [max(sorted(free), key=lambda b: c[b, sorted(free)].sum())]
        free.discard(part[0])
        while len(part) < width:
            part.append(max(sorted(free), key=lambda b: c[b, part].sum()))
            free.discard(part[-1])
        parts.append(tuple(sorted(part)))
    return parts


def allot(sample: np.ndarray, n: int, tau: int, emit_cost: float = 40.0) -> list[Part]:
    """Parts and thresholds of the least estimated cost for n fingerprints.

    The cost of threshold t in a part: pairs that meet in it (estimated from the sample's pairs, with
    the share under independent even bits as the floor) plus what is emitted to find them. For each
    number of parts a dynamic programme splits sum(t_i + 1) = tau + 1; the cheapest of all wins.
    """
    a, b = sample[: len(sample) // 2], sample[len(sample) // 2 :]
    best: tuple[float, list[Part]] | None = None
    for m in range(1, tau + 2):
        bits = correlated_parts(sample, m)
        cost = []  # cost[i][s] for s = t + 1
        for part in bits:
            mask = np.uint64(sum(1 << x for x in part))
            near = np.zeros(tau + 2)
            for row in a:
                d = np.bincount(np.bitwise_count((b ^ row) & mask), minlength=65)[: tau + 1]
                near[1:] += d
            share = np.cumsum(near) / max(1, len(a) * len(b))
            ball = np.cumsum([0] + [comb(len(part), k) for k in range(tau + 1)])
            share = np.maximum(share, ball / 2.0 ** len(part))
            share[0] = 0
            emit = np.where(np.arange(tau + 2) == 0, 0, 1 + (ball - 1) / 2)
            cost.append(share * n * n / 2 + emit * n * emit_cost)
        table = {0: (0.0, [])}
        for c in cost:
            table = {
                total: min(((v + c[s], [*ts, s - 1]) for used, (v, ts) in table.items() if (s := total - used) >= 0 and s <= tau + 1), key=lambda x: x[0])
                for total in range(tau + 2)
            }
        v, ts = table[tau + 1]
        if best is None or v < best[0]:
            best = v, [Part(p, t) for p, t in zip(bits, ts, strict=True) if t >= 0]
    return best[1]


def _emit(parts: list[Part]):
    """(part, key, right, fp and what else is given): each fingerprint under its own value, and as a right one near it.

    Of two values at most t bits apart only the smaller emits, towards the larger: each pair of
    values meets once.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns])
            for lo in range(0, b.num_rows, 20_000):
                own = every[:, lo : lo + 20_000]
                for i, p in enumerate(parts):
                    v = _values(own[0].view(np.uint64), p.bits)
                    yield _rows(i, v, np.zeros(len(v), np.int8), own)
                    for r in range(1, p.threshold + 1):
                        for flip in combinations(range(len(p.bits)), r):
                            w = v ^ np.uint64(sum(1 << f for f in flip))
                            up = w > v
                            yield _rows(i, w[up], np.ones(up.sum(), np.int8), own[:, up])

    return work


def _rows(part: int, key: np.ndarray, right: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), part, np.int8)), pa.array(key.view(np.int64)), pa.array(right), *map(pa.array, own)], ["part", "key", "right", "fp", "node", *OTHERS][: 3 + len(own)])


def group_links(fp: np.ndarray, right: np.ndarray, within: bool, tau: int, further: tuple[np.ndarray, ...] = ()) -> list[tuple[int, int]]:
    """Links (places of rows) that join what is linked in one group, in which left rows stand first: left with
    left (if within) and left with right. further: further fingerprints, which must agree in OTHERS_TAU bits too.

    Walks the left ones breadth first, each compared with all not yet reached, so the number of
    links stays below the number of rows however dense the group is.
    """
    n = int((right == 0).sum())

    def near(rows: np.ndarray, at: int) -> np.ndarray:
        hit = rows[np.bitwise_count(fp[rows] ^ fp[at]) <= tau]
        return hit[apart([x[hit] for x in further], [x[at] for x in further]) <= OTHERS_TAU] if further and len(hit) else hit

    label, every = np.full(n, -1, np.int64), np.arange(n)
    out = []
    if within:
        todo = every
        while len(todo):
            front, todo = [int(todo[0])], todo[1:]
            root = label[front[0]] = front[0]
            while front and len(todo):
                at = front.pop()
                found = near(todo, at)
                if len(found):
                    label[found] = root
                    out += [(at, x) for x in found.tolist()]
                    front += found.tolist()
                    todo = todo[label[todo] < 0]
    else:
        label = every.copy()
    for x in range(n, len(fp)):
        hit = near(every, x)
        if len(hit):
            # what these are linked to, they share from now on
            roots = np.unique(label[hit])
            out += [(int(hit[np.argmax(label[hit] == r)]), x) for r in roots]
            if len(roots) > 1:
                label[np.isin(label, roots)] = roots[0]
    return out


def apart(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Bits in which several fingerprints differ together."""
    return sum((np.bitwise_count(x ^ y).astype(np.int64) for x, y in zip(a, b, strict=True)), 0)


def _compare(tau: int):
    """Over rows sorted by group with left ones first: links found in each group (a, b).

    A group is held up to its BLOCK of left rows; right ones are streamed past it. Links are those of
    fingerprints, or where rows have a node and further fingerprints too, those of nodes.
    """

    def pack(ends: np.ndarray, i, j) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ends[np.asarray(x, np.int64)].view(np.int64)) for x in (i, j)], ["a", "b"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def settle(part, key, bi, bj, right, fp, *extra):
            """All groups in these rows, each whole or a left block with some of its right ones."""
            ends, further = (extra[0], extra[1:]) if extra else (fp, ())
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (part[1:] != part[:-1]) | (bi[1:] != bi[:-1]) | (bj[1:] != bj[:-1])))
            starts = np.flatnonzero(new)
            sizes = np.diff(np.concatenate((starts, [len(key)])))
            gid = np.repeat(np.arange(len(starts)), sizes)
            small = (sizes <= SMALL)[gid]
            k, r, f, g, w, e = key[small], right[small], fp[small], gid[small], (bi == bj)[small], ends[small]
            others = [x[small] for x in further]
            for d in range(1, SMALL):
                if len(k) <= d:
                    break
                ok = (g[d:] == g[:-d]) & (r[:-d] == 0) & ((r[d:] != 0) | w[d:])
                i = np.flatnonzero(ok)
                i = i[np.bitwise_count(f[i] ^ f[i + d]) <= tau]
                if further:
                    i = i[apart([o[i] for o in others], [o[i + d] for o in others]) <= OTHERS_TAU]
                if len(i):
                    yield pack(e, i, i + d)
            for at in np.flatnonzero(sizes > SMALL):
                s = slice(starts[at], starts[at] + sizes[at])
                if right[s][0] == 0:
                    found = group_links(fp[s], right[s], bool(bi[s][0] == bj[s][0]), tau, tuple(x[s] for x in further))
                    if found:
                        yield pack(ends[s], *zip(*found, strict=True))

        for b in batches:
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(b.num_columns)]
            cols[5:] = [c.astype(np.int64).view(np.uint64) for c in cols[5:]]
            if held:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            part, key, bi, bj = cols[:4]
            last = (part == part[-1]) & (key == key[-1]) & (bi == bi[-1]) & (bj == bj[-1])
            start = int(np.argmax(last)) if last.any() else len(key)
            tail = [c[start:] for c in cols]
            if len(tail[0]) > 4 * BLOCK:
                # one long group: settle it so far, keep its left rows for what is still to come
                yield from settle(*cols)
                left = tail[4] == 0
                held = [c[left] for c in tail]
                if not left.any():
                    held = [c[-1:] for c in tail]
            else:
                if start:
                    yield from settle(*[c[:start] for c in cols])
                held = tail
        if held:
            yield from settle(*held)

    return work


def near_links(fps: DataFrame, tau: int = 4, block: int = BLOCK) -> DataFrame:
    """(a, b): links among distinct fingerprints (column fp) that differ in at most tau bits.

    Enough of them that everything within tau bits is connected, and none beyond tau bits.
    """
    return _met(fps.select("fp"), tau, block).mapInArrow(_compare(tau), "a long, b long")


def near_nodes(nodes: DataFrame, tau: int, block: int = BLOCK) -> DataFrame:
    """(a, b): links among nodes (fp, node, OTHERS) whose fingerprints differ in at most tau bits, and in at
    most OTHERS_TAU in the further ones; enough of them, as in near_links, so a dense group gives a
    number of links that is linear in its size.
    """
    return _met(nodes.select("fp", "node", *OTHERS), tau, block, emit_cost=300.0).mapInArrow(_compare(tau), "a long, b long")


def _met(fps: DataFrame, tau: int, block: int, emit_cost: float = 40.0) -> DataFrame:
    """Rows for _compare, sorted by group: part, key, two block numbers, right, fp (and node and further
    fingerprints, if given)."""
    n = fps.count()
    sample = fps.select("fp").where(share_of("fp", SAMPLE / max(n, 1), 3)).toPandas()["fp"]
    parts = allot(np.random.default_rng(0).permutation(np.sort(sample.to_numpy(np.int64))).view(np.uint64), n, tau, emit_cost)
    given = fps.columns
    shape = "part byte, key long, right byte, " + ", ".join(f"{c} long" for c in given)
    rows = fps.mapInArrow(_emit(parts), shape)

    # Buckets beyond a block are dealt into blocks by a hash; every two of its blocks meet in a task of their own.
    held = fps.select("fp").mapInArrow(_emit([Part(p.bits, 0) for p in parts]), "part byte, key long, right byte, fp long")
    hot = materialize(held.groupBy("part", "key").agg(F.count("*").alias("size")).where(F.col("size") > block).select("part", "key", F.ceil(F.col("size") / block).cast("int").alias("blocks")), "hot")
    if hot.isEmpty():
        dealt = rows.select("part", "key", F.lit(0).alias("bi"), F.lit(0).alias("bj"), "right", *given)
    else:
        mine = F.pmod(F.xxhash64("node" if "node" in given else "fp"), F.col("blocks")).cast("int")
        every = rows.join(hot, ["part", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("mine", mine).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        right = F.col("right") == 1
        dealt = every.select(
            "part", "key",
            F.when(right, F.col("j")).otherwise(F.least("mine", "j")).alias("bi"),
            F.when(right, F.col("j")).otherwise(F.greatest("mine", "j")).alias("bj"),
            F.when(right | (F.col("mine") > F.col("j")), F.lit(1)).otherwise(F.lit(0)).cast("byte").alias("right"),
            *given,
        )
    keys = ["part", "key", "bi", "bj"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "right")


def near_duplicates(docs: DataFrame, shingle: int = 5, tau: int = 4) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id reachable over links of at most tau differing bits. Equal
    fingerprints are linked (those of empty and null texts too: zero); they are joined into one before
    any search, so a large group of copies costs one row. Repeated doc_ids give repeated rows. Null
    doc_ids keep their row and never name a component unless it holds nothing else. An empty table
    gives an empty result. A very long text is one pass in one task, which holds it and its shingles' hashes.
    """
    fps = materialize(fingerprints(docs, shingle), "fingerprints")
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "distinct")
    roots = connected_components(near_links(distinct.select("fp"), tau))
    joined = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = materialize(joined.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n")), "named")
    classes = materialize(spread_join(joined.select("fp", "root", "copies"), named, "root", "n").select("fp", "component_id", "copies"), "classes")
    return spread_join(fps, classes, "fp", "copies").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, shingle: int = 5, tau: int = 4) -> DataFrame:
    """The documents that stay, one row of each component (the smallest doc_id), with all their columns.

    Rows are decided by doc_id and text, so null and repeated doc_ids lose no text.
    """
    fps = materialize(fingerprints(docs, shingle, keyed=True), "fingerprints")
    roots = connected_components(near_links(materialize(fps.select("fp").distinct(), "distinct"), tau))
    return _one_of_each(docs, fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))


def _one_of_each(docs: DataFrame, rooted: DataFrame) -> DataFrame:
    """The row of docs with the smallest (doc_id, key) of each root; rooted: doc_id, key, root."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    rows = materialize(rooted.select("doc_id", "key", order.alias("order"), "root"), "rooted")
    best = materialize(rows.groupBy("root").agg(F.min("order").alias("best"), F.count("*").alias("n")), "best")
    return without(docs, spread_join(rows, best, "root", "n").select("doc_id", "key", F.col("order").eqNullSafe(F.col("best")).alias("kept")), text_key)


def _shingle_sets(docs: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """(node, words): sorted distinct shingle hashes of the texts of nodes (key, node)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 128):  # sets are larger than their texts
                part = b.slice(lo, 128)
                sets = [np.unique(shingle_hashes(t, shingle)).tobytes() for t in part.column(1).cast(pa.large_binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["node", "words"])

    maybe = member_test(nodes, "key")
    # of texts that stand there several times one is taken, so that no set is made twice
    texts = documents_of(docs).select(text_key(F.col("text")).alias("key"), "text").where(maybe(F.col("key"))).join(nodes, "key")
    return texts.groupBy("node").agg(F.min("text").alias("text")).mapInArrow(work, "node long, words binary")


def unite(prints: list[np.ndarray], sets: list[np.ndarray], label: np.ndarray, left: int, tau: int, similarity: float) -> list[tuple[int, int]]:
    """Links of labels of rows with similar sets: of each row with those before it, or if left is given, of
    those from there on with those before it.

    prints: fingerprints and further ones, which say what is a candidate. Rows of one label are joined
    already; what is linked has one label from then on. So each link joins two labels, and rows that
    belong together are hardly compared.
    """
    sizes = np.array([len(x) for x in sets])
    ends = np.cumsum(sizes)
    distinct, ids = np.unique(np.concatenate(sets), return_inverse=True)
    of = lambda k: ids[ends[k] - sizes[k] : ends[k]]
    label, mark, out = label.copy(), np.zeros(len(distinct), bool), []
    for i in range(left or 1, len(sets)):
        rows = np.flatnonzero(label[: left or i] != label[i])
        bits = np.bitwise_count(prints[0][rows] ^ prints[0][i])
        ok = (bits <= tau) & (np.minimum(sizes[rows], sizes[i]) >= similarity * np.maximum(sizes[rows], sizes[i]))
        rows, bits = rows[ok], bits[ok]
        if not len(rows):
            continue
        ok = apart([p[rows] for p in prints[1:]], [p[i] for p in prints[1:]]) <= OTHERS_TAU
        rows = rows[ok][np.argsort(bits[ok], kind="stable")]
        mark[of(i)] = True
        step = NEAREST
        while len(rows):
            both = np.fromiter((np.count_nonzero(mark[of(k)]) for k in rows[:step]), np.int64, len(rows[:step]))
            hit = rows[:step][both >= similarity * (sizes[i] + sizes[rows[:step]] - both)]
            for r in np.unique(label[hit]).tolist():
                out.append((int(label[i]), r))
                label[label == r] = label[i]
            rows = rows[step:]
            rows = rows[label[rows] != label[i]]
            step *= NEAREST
        mark[of(i)] = False
    return out


def _united(rows: DataFrame, keys: list[str], tau: int, similarity: float) -> DataFrame:
    """(a, b): links of roots found in each group of keys; rows: words, root, right, fp and further ones."""

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by([("right", "ascending"), ("node", "ascending")])
        column = lambda c: table.column(c).to_numpy()
        left, found = int((column("right") == 0).sum()), []
        if table.num_rows > 1:
            prints = [column(c).astype(np.int64).view(np.uint64) for c in ("fp", *OTHERS)]
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("words")]
            if left:
                found = unite(prints, sets, column("root"), left if left < len(sets) else 0, tau, similarity)
        a, b = np.array(found, np.int64).reshape(-1, 2).T
        return pa.table({"a": a, "b": b})

    return rows.select(*keys, "right", "node", "root", "fp", *OTHERS, "words").groupBy(*keys).applyInArrow(work, "a long, b long")


def _blocks(rows: str, shingles: str) -> Column:
    return F.ceil(F.greatest(F.col(rows) / GROUP_ROWS, F.col(shingles) / GROUP_SHINGLES)).cast("long")


def _dealt(blocks: str, seed: int) -> Column:
    return F.pmod(F.xxhash64("node", F.lit(seed)), F.col(blocks))


def _meeting(big: DataFrame, roots: DataFrame) -> tuple[DataFrame, list[str]] | None:
    """Rows of big groups dealt so that all of different roots meet, and the keys of what meets.

    Roots of more rows than a block have blocks of their own, which do not meet each other; the other rows of a group
    share blocks. Of two blocks that meet the second one's rows are right. None: nothing has to meet.
    """
    big = materialize(big.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "big")
    parts = big.groupBy("cluster", "root").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    parts = materialize(parts.withColumn("slot", F.when(_blocks("rows", "shingles") > 1, F.col("root")).otherwise(-1 - F.col("cluster"))), "parts")
    slots = parts.groupBy("slot").agg(F.min("cluster").alias("cluster"), F.sum("rows").alias("rows"), F.sum("shingles").alias("shingles"))
    slots = materialize(slots.withColumn("blocks", _blocks("rows", "shingles")), "slots")
    each = slots.select("cluster", "slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    a, b = each.toDF("cluster", "slot", "block"), each.toDF("cluster", "slot2", "block2")
    shared = F.col("slot") < 0
    earlier = (F.col("slot") < F.col("slot2")) | (F.col("slot") == F.col("slot2")) & shared & (F.col("block") <= F.col("block2"))
    meets = materialize(a.join(b, "cluster").where(earlier).drop("cluster"), "meets")
    if not meets.head(1):
        return None
    rows = spread_join(big, parts.select("root", "slot", "rows"), "root", "rows").drop("rows", "blocks")
    rows = spread_join(rows, slots.select("slot", "blocks", "rows"), "slot", "rows").withColumn("block", _dealt("blocks", 2)).drop("rows")
    first = rows.join(meets, ["slot", "block"]).withColumn("right", F.lit(0))
    second = rows.withColumnsRenamed({"slot": "slot2", "block": "block2"}).join(meets.where("slot <> slot2 or block <> block2"), ["slot2", "block2"]).withColumn("right", F.lit(1))
    return first.unionByName(second), ["slot", "block", "slot2", "block2"]


def _similar_roots(docs: DataFrame, nodes: DataFrame, shingle: int, tau: int, similarity: float) -> DataFrame:
    """(node, root) for nodes that are linked to others.

    Candidates are joined to groups first. Each group is compared where its rows stand, so no table of
    pairs is made. A group of several blocks is compared within its blocks, dealt anew and compared once
    more, which joins what is dense; then all its rows that have different roots meet.
    """
    groups = connected_components(near_nodes(nodes.where("n > 0"), tau)).toDF("node", "cluster")
    asked = materialize(nodes.join(groups, "node"), "asked")
    sizes = materialize(asked.groupBy("cluster").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles")).withColumn("blocks", _blocks("rows", "shingles")), "sizes")
    sets = _shingle_sets(docs, asked.select("key", "node"), shingle)
    held = materialize(sets.join(spread_join(asked.drop("key"), sizes.drop("shingles"), "cluster", "rows").drop("rows"), "node"), "held")
    once = lambda rows, seed: rows.withColumns({"right": F.lit(0), "block": _dealt("blocks", seed)})
    links = materialize(_united(once(held.withColumn("root", F.col("node")), 0), ["cluster", "block"], tau, similarity), "links")
    roots = connected_components(links)
    if not sizes.where("blocks > 1").head(1):
        return roots
    big = held.where("blocks > 1")
    again = once(big.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), 1)
    links = links.unionByName(materialize(_united(again, ["cluster", "block"], tau, similarity), "links"))
    roots = connected_components(links)
    left = _meeting(big, roots)
    if left is None:
        return roots
    return connected_components(links.unionByName(materialize(_united(*left, tau, similarity), "links")))


def similar_dedup(docs: DataFrame, shingle: int = 5, tau: int = STAGE_TAU, similarity: float = SIMILAR) -> DataFrame:
    """One document of each group of near copies stays (the smallest doc_id), with all its columns.

    Candidates are texts whose fingerprints differ in at most tau bits (and further ones in OTHERS_TAU);
    linked are those whose sets of word shingles have a Jaccard similarity of at least similarity,
    computed in full. Equal texts are one node. Candidates are grouped and compared in their groups; no
    candidate pair goes untested that could join two components. Texts without words have no shingles:
    they are alike as equal texts only. Null and repeated doc_ids, empty tables and columns of any
    name: as in near_dedup.
    """
    fps = materialize(fingerprints(docs, shingle, keyed=True), "fingerprints")
    nodes = fps.groupBy("key").agg(F.min(F.struct("fp", *OTHERS, "n")).alias("r")).select("key", "r.*").withColumn("node", F.monotonically_increasing_id())
    nodes = materialize(nodes, "nodes")
    roots = _similar_roots(docs, nodes, shingle, tau, similarity)
    rooted = fps.select("doc_id", "key").join(nodes.select("key", "node"), "key").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return _one_of_each(docs, rooted)
