"""Language-model scores by deleted interpolation of n-gram estimates.

Texts are tokenised once, in blocks of some megabytes, into a table that holds each block's words by
hash and its texts as places in them. Counting is a shuffle: every block sends each of its distinct
n-grams once, as sorted hashes with counts packed by slice of the hash space; a slice's task adds up
all blocks' counts and sends each block the totals of the n-grams that it asked for. So what moves is
a few bytes per distinct n-gram of a block (with blocks and slices so small that a slice has one
n-gram of a block, a row each), and no task holds more than a slice or a block.

p(w | h) = sum over orders k of weight[k, bucket] * c(h_k, w) / c(h_k), down to a uniform share, where
the bucket is the frequency of the longest context seen. The weights are learned by expectation-
maximisation on held-out texts, of which the counts leave out all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loretable.llm.common import documents_of, materialize

#: Bytes of text in a block, and distinct n-grams that a slice takes in from all blocks on average.
BLOCK_BYTES, SLICE_KEYS = 8_000_000, 1_500_000
#: Blocks whose answers a task brings together.
BLOCKS_AT_ONCE = 4
#: Every so many-th learning text is held out while the weights are learned.
HELD_EVERY = 10
#: Buckets of context frequency: 0, then powers of two.
BUCKETS = 18
#: Rounds of expectation-maximisation at most, and the gain per token that ends them.
ROUNDS, GAIN = 60, 1e-6
END = 0x9E3779B97F4A7C15  # stands for the end of a text

LEARN, HELD, SCORE = 0, 1, 2  # texts that count; texts that count, but not for the weights; texts scored only
TOKENS = "block long, role byte, doc_ids binary, null_ids binary, lens binary, words binary, seq binary"


def _tokenise(block_bytes: int):
    """Blocks of texts of one role: ids, lengths, distinct word hashes, and each token's place in them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        open_: dict[int, dict] = {}

        def close(role: int) -> pa.RecordBatch:
            nonlocal number
            b = open_.pop(role)
            words = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in b["places"]), np.uint64, len(b["places"]))
            words[words == END] = 0  # that hash is kept for the end
            block, number = (task << 32) + number, number + 1
            seq = np.concatenate([np.empty(0, np.int32), *b["seq"]])
            row = [block, role, np.array(b["ids"], np.int64), np.array(b["null"], np.int8), np.array(b["lens"], np.int32), words, np.ascontiguousarray(seq.view(np.uint8).reshape(-1, 4).T)]
            kinds = [pa.int64(), pa.int8()] + [pa.binary()] * 5
            return pa.RecordBatch.from_arrays([pa.array([x.tobytes() if isinstance(x, np.ndarray) else x], k) for x, k in zip(row, kinds, strict=True)], [c.split()[0] for c in TOKENS.split(", ")])

        for batch in batches:
            for doc, text, role in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                b = open_.setdefault(role, {"ids": [], "null": [], "lens": [], "seq": [], "places": {}, "bytes": 0})
                raw = text.as_py().encode()
                words = raw.lower().split()
                places = b["places"]
                for w in set(words).difference(places):
                    places[w] = len(places)
                b["seq"].append(np.fromiter(map(places.__getitem__, words), np.int32, len(words)))
                b["ids"].append(0 if doc is None else doc)
                b["null"].append(doc is None)
                b["lens"].append(len(words))
                b["bytes"] += len(raw)
                if b["bytes"] >= block_bytes:
                    yield close(role)
        for role in list(open_):
            yield close(role)

    return work


class Block:
    """A block's n-grams: tokens as hashes, with an end after each text."""

    def __init__(self, row):
        self.role = row.role
        self.lens = np.frombuffer(row.lens, np.int32).astype(np.int64)
        words, seq = np.frombuffer(row.words, np.uint64), np.ascontiguousarray(np.frombuffer(row.seq, np.uint8).reshape(4, -1).T).view(np.int32).ravel()
        n = self.lens + 1
        self.ends = np.cumsum(n) - 1
        self.tokens = np.full(n.sum(), END, np.uint64)
        inside = np.ones(len(self.tokens), bool)
        inside[self.ends] = False
        self.tokens[inside] = words[seq]
        self.first = np.zeros(len(self.tokens), bool)
        self.first[self.ends - self.lens] = True

    def grams(self, order: int) -> np.ndarray:
        """For each token the hash of the n-gram that it ends; before a text stand ends of texts."""
        out, context = _mix(self.tokens), self.tokens
        for _ in range(order - 1):
            context = np.concatenate(([np.uint64(END)], context[:-1]))
            context[self.first] = np.uint64(END)
            out = _mix(out * np.uint64(0x9FB21C651E98DF25) + context)
        return out

    def asked(self, order: int) -> np.ndarray:
        """Its n-grams, and for each text the context of that length at its start."""
        return np.concatenate((self.grams(order), np.full(len(self.ends), START[order])))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


#: The context at the start of a text, by its length: it is no n-gram of the text before.
START = {k: np.uint64(0xA0761D6478BD642F + k) for k in range(1, 5)}

ASK = "slice int, block long, keys binary, counts binary, held binary"


def _ask(order: int, slices: int):
    """Each block's distinct n-grams of an order with their counts in it, one row per slice of hashes
    that has any."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for row in f.itertuples():
                keys, n = np.unique(Block(row).asked(order), return_counts=True)
                counts, held = (n if row.role != SCORE else n * 0), (n if row.role == HELD else n * 0)
                part = (keys >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)
                cut = np.flatnonzero(np.diff(part, prepend=np.uint64(2**64 - 1), append=np.uint64(2**64 - 1)))
                yield pd.DataFrame([(int(part[a]), row.block, _pack(keys[a:z]), _thin(counts[a:z]), _thin(held[a:z])) for a, z in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)], columns=[c.split()[0] for c in ASK.split(", ")])

    return work


def _pack(keys: np.ndarray) -> bytes:
    """Sorted hashes as differences, byte plane by byte plane: upper planes are zeros and compress away."""
    return np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


def _thin(counts: np.ndarray) -> bytes:
    """Counts as bytes; those of 255 and more follow as whole numbers."""
    big = counts >= 255
    return np.where(big, 255, counts).astype(np.uint8).tobytes() + counts[big].astype("<u4").tobytes()


def _thick(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, "<u4", offset=n)
    return out


#: For block -1, distinct and total are a slice's sums; else distinct is the number of n-grams answered.
ANSWER = "block long, gram_order int, slice int, counts binary, held binary, distinct long, total long"


def _answer(order: int):
    def work(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("block")
        keys = [_unpack(k) for k in f["keys"]]
        distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        totals = []
        for c in ("counts", "held"):
            values = np.concatenate([_thick(x, len(k)) for x, k in zip(f[c], keys, strict=True)])
            totals.append(np.bincount(inverse, values, minlength=len(distinct)).astype(np.int64))
        cuts = np.split(inverse, np.cumsum([len(k) for k in keys])[:-1])
        real = (totals[0] > 0) & (distinct != START[order])
        rows = [(b, order, int(f["slice"].iloc[0]), _thin(totals[0][i]), _thin(totals[1][i]), len(i), 0) for b, i in zip(f["block"], cuts, strict=True)]
        rows.append((-1, order, int(f["slice"].iloc[0]), b"", b"", int(real.sum()), int(totals[0][real].sum())))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in ANSWER.split(", ")])

    return work


def counted(blocks: DataFrame, order: int, keys: int) -> DataFrame:
    """Totals of the n-grams of one order, for each block those it asked for (block -1: sums)."""
    slices = max(1, -(-keys // SLICE_KEYS))
    asked = blocks.select("block", "role", "lens", "words", "seq").mapInPandas(_ask(order, slices), ASK)
    # as many partitions as slices, so that what a task reads does not grow with the input
    return asked.repartition(slices, "slice").groupBy("slice").applyInPandas(_answer(order), ANSWER)


def _totals(b: Block, answers: list, order: int):
    """For each token the total and held-out total of the n-gram it ends; both of the start of a text."""
    keys, inverse = np.unique(b.asked(order), return_inverse=True)
    parts = sorted(answers, key=lambda a: a["slice"])
    counts, held = (np.concatenate([_thick(a[c], a["distinct"]) for a in parts]) for c in ("counts", "held"))
    start = np.searchsorted(keys, START[order])
    inverse = inverse[: len(b.tokens)]
    return counts[inverse], held[inverse], (counts[start], held[start])


def _estimates(b: Block, answers: dict[int, list], total: int, order: int, without_held: bool, held_total: int):
    """(bucket, estimates): for each token its bucket and the maximum-likelihood estimate of each order."""
    got = {k: _totals(b, answers[k], k) for k in range(1, order + 1)}
    pick = lambda c, h: c - h if without_held else c
    n = total - held_total if without_held else total
    estimates = [pick(*got[1][:2]) / max(n, 1)]
    bucket = np.zeros(len(b.tokens), np.int64)
    for k in range(2, order + 1):
        count = pick(*got[k][:2])
        below = pick(*got[k - 1][:2])
        context = np.concatenate(([0], below[:-1]))
        context[b.first] = pick(*got[k - 1][2])
        estimates.append(np.where(context > 0, count / np.maximum(context, 1), 0.0))
        level = np.minimum(1 + np.floor(np.log2(np.maximum(context, 1))).astype(np.int64), BUCKETS - 1)
        bucket = np.where(context > 0, (k - 2) * BUCKETS + level, bucket)
    return bucket, estimates, got[1][0]


#: Steps per factor of two in which estimates are gathered for learning the weights.
FINE = 4


def _gather(order: int, total: int, held_total: int):
    """Held-out tokens by bucket and finely by their estimates: how many, and the estimates' sums."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for row in f.itertuples():
                b = Block(row)
                bucket, estimates, _ = _estimates(b, _by_order(row.answers), total, order, True, held_total)
                cell = bucket
                for p in estimates:
                    level = np.where(p > 0, 1 + np.clip(np.floor(-np.log2(np.maximum(p, 1e-300)) * FINE), 0, 50 * FINE - 1).astype(np.int64), 0)
                    cell = cell * (50 * FINE + 1) + level
                cells, inverse = np.unique(cell, return_inverse=True)
                first = np.zeros(len(cells), np.int64)
                first[inverse] = bucket
                sums = [np.bincount(inverse, p, minlength=len(cells)) for p in estimates]
                yield pd.DataFrame({"cell": cells, "bucket": first, "n": np.bincount(inverse, minlength=len(cells)), **{f"p{k + 1}": s for k, s in enumerate(sums)}})

    return work


def _by_order(answers) -> dict[int, list]:
    out: dict[int, list] = {}
    for a in answers:
        out.setdefault(a["gram_order"], []).append(a)
    return out


def learn_weights(cells: pd.DataFrame, order: int, uniform: float) -> np.ndarray:
    """(buckets, order + 1) mixture weights of orders 1.. and the uniform share, by EM.

    Each bucket's weights are its own; buckets without held-out tokens take those of all tokens.
    """
    size = max(1, (order - 1) * BUCKETS)
    p = np.column_stack([cells[f"p{k}"] / cells["n"] for k in range(1, order + 1)] + [np.full(len(cells), uniform)])
    n, bucket = cells["n"].to_numpy(float), cells["bucket"].to_numpy(np.int64)

    def em(rows: np.ndarray) -> np.ndarray:
        w = np.full(order + 1, 1 / (order + 1))
        last = -np.inf
        for _ in range(ROUNDS):
            mixed = p[rows] @ w
            gain = float(n[rows] @ np.log(np.maximum(mixed, 1e-300))) / n[rows].sum()
            w = ((p[rows] * w) * (n[rows] / np.maximum(mixed, 1e-300))[:, None]).sum(axis=0)
            w = np.maximum(w / w.sum(), 1e-9)
            w /= w.sum()
            if gain - last < GAIN:
                break
            last = gain
        return w

    if not len(n):
        return np.tile(np.append(np.full(order, 0.9 / order), 0.1), (size, 1))
    out = np.tile(em(np.arange(len(n))), (size, 1))
    for k in np.unique(bucket):
        out[k] = em(np.flatnonzero(bucket == k))
    return out


def _score(order: int, total: int, types: int, weights: np.ndarray):
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for row in f.itertuples():
                b = Block(row)
                bucket, estimates, counts = _estimates(b, _by_order(row.answers), total, order, False, 0)
                w = weights[bucket]
                p = w[:, -1] / (types + 1)
                for k, x in enumerate(estimates):
                    p += w[:, k] * x
                start = b.ends - b.lens
                base = np.log10(counts + 1.0) - np.log10(total + types + 1.0)
                null = np.frombuffer(row.null_ids, np.int8).astype(bool)
                ids = np.frombuffer(row.doc_ids, np.int64)
                yield pd.DataFrame({
                    "doc_id": pd.array(ids, "Int64") if not null.any() else pd.array([pd.NA if z else i for i, z in zip(ids.tolist(), null.tolist(), strict=True)], "Int64"),
                    "n_tokens": b.lens + 1, "n_known": np.add.reduceat((counts > 0).astype(np.int64), start), "train_tokens": total,
                    "base_score": np.add.reduceat(base, start), "score": np.add.reduceat(np.log10(p), start),
                })

    return work


def score_documents(docs: DataFrame, learns: Column, order: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score for every whole text.

    Tokens: words between [\\x20\\x09-\\x0D], A-Z lowered, and an end. learns: the documents that the
    counts come from. base_score adds one to each unigram count, with one more type for all unknown
    words; score is the interpolated model's log10 probability. Null and empty texts are an end alone.
    Repeated rows count and are returned as often as they stand there. An empty table gives an empty
    result; without a learning text every estimate is the uniform share.
    """
    held = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(13)), F.lit(HELD_EVERY)) == 0
    role = F.when(~F.coalesce(learns, F.lit(False)), SCORE).when(held, HELD).otherwise(LEARN).cast("byte")
    rows = documents_of(docs).select("doc_id", "text", role.alias("role"))
    blocks = materialize(rows.mapInArrow(_tokenise(block_bytes), TOKENS), "tokens", compression="zstd")
    known = blocks.agg(
        F.sum(F.when(F.col("role") == HELD, F.length("seq") / 4 + F.length("lens") / 4)), F.sum(F.length("seq") / 4 + F.length("lens") / 4), F.sum(F.length("words") / 8 + 2)
    ).first()
    held_total, tokens, words = (int(x or 0) for x in known)
    sizes = [words, *[tokens] * (order - 1)]
    answers = None
    for k, keys in zip(range(1, order + 1), sizes, strict=True):
        found = counted(blocks, k, keys)
        answers = found if answers is None else answers.unionByName(found)
    answers = materialize(answers, "totals")
    sums = answers.where((F.col("block") == -1) & (F.col("gram_order") == 1)).agg(F.sum("distinct"), F.sum("total")).first()
    types, total = int(sums[0] or 0), int(sums[1] or 0)

    number = blocks.count()
    tasks = max(1, -(-number // BLOCKS_AT_ONCE))
    gathered = answers.where("block >= 0").repartition(tasks, "block").groupBy("block").agg(F.collect_list(F.struct("gram_order", "slice", "counts", "held", "distinct")).alias("answers"))
    full = blocks.repartition(tasks, "block").join(gathered, "block")
    cells = full.where(F.col("role") == HELD).mapInPandas(_gather(order, total, held_total), "cell long, bucket long, n long, " + ", ".join(f"p{k} double" for k in range(1, order + 1)))
    sums = [F.sum(f"p{k}").alias(f"p{k}") for k in range(1, order + 1)]
    learned = cells.groupBy("cell").agg(F.first("bucket").alias("bucket"), F.sum("n").alias("n"), *sums).toPandas().sort_values("cell")
    weights = learn_weights(learned, order, 1 / (types + 1))
    return full.mapInPandas(_score(order, total, types, weights), "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
