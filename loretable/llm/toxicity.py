"""Toxic passages by maximum-scoring segments of token log-odds with Dirichlet priors.

Fit: document counts of tokens in toxic and clean labelled texts. The log-odds of a word take the
estimate of its beginnings as their Dirichlet prior (whole word <- first 8 <- 7 ... <- 3 characters
<- all words), so that a rare form is judged by its stem, and are drawn towards zero by their standard
error, so that what was seen by chance in a few toxic texts weighs little. Score: one linear scan finds all maximal
segments of positive sum; a segment's score S in n tokens is calibrated by extreme-value statistics
(expected number of such segments in clean text: E = K n exp(-lambda S)), and the evidence of all
significant segments of a document is combined into one probability by a logistic fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loretable.llm.common import documents_of, labelled_sample, materialize, share_of

#: Labelled rows that a model is fitted on at most, chosen by a hash of the id, and the share of them
#: that calibrates (the others give the counts).
SAMPLE_ROWS, CALIBRATION = 15_000, 0.3
#: Lengths of the beginnings that serve as priors, and the strength of each prior in documents.
STEMS, STRENGTH = (8, 7, 6, 5, 4, 3), 8.0
#: Standard errors by which log-odds are drawn towards zero.
CAUTION = 2.0
#: Counts that a task holds before it gives them out.
HELD_COUNTS = 300_000
#: Min-hashes by which near copies in the sample are found.
SKETCH = 4
#: Documents of the sample that a token must occur in to have an estimate of its own.
LEAST_DOCUMENTS = 4
#: Each token loses so many times the mean gain of tokens in clean text, and at least so much, so that
#: clean text drifts downwards.
DRIFT, LEAST_DRIFT = 2.0, 0.005
#: Tokens within which a repeated word's gain shrinks.
NEAR = 8
#: A segment is significant if fewer than so many like it are expected in clean text of its length.
SIGNIFICANT = 0.05
PUNCTUATION = b".,;:!?\"'()[]{}*%#$&|<>-_"


@dataclass
class ToxicityModel:
    """A fitted model; its tables are bounded by the sample it was fitted on."""

    words: dict[bytes, float] = field(default_factory=dict)
    stems: dict[bytes, float] = field(default_factory=dict)
    drift: float = LEAST_DRIFT
    scale: float = 1.0  # lambda
    log_k: float = 0.0  # log K
    weights: tuple[float, float, float] = (-2.0, 1.0, 0.0)


class Scores(dict):
    """Word as it stands in the lower-cased text -> score; unknown words are derived once."""

    LIMIT = 150_000

    def __init__(self, model: ToxicityModel):
        super().__init__()
        self.model = model

    def __missing__(self, raw: bytes) -> float:
        word = raw.strip(PUNCTUATION)
        value = self.model.words.get(word)
        if value is None:
            text = word.decode("utf-8", "replace")
            value = next((v for n in STEMS if len(text) >= n and (v := self.model.stems.get(text[:n].encode())) is not None), 0.0)
        if len(self) >= self.LIMIT:
            self.clear()
        self[raw] = value = value - self.model.drift
        return value


def token_scores(words: list[bytes], scores: Scores) -> np.ndarray:
    """The score of each token; a gain counts in full, and by a half, a third and so on if the same word stood
    within the NEAR tokens before, so that one word repeated over and over is no passage, while a passage that
    comes again further on counts like the first one."""
    out = np.fromiter(map(scores.__getitem__, words), float, len(words))
    last: dict[bytes, tuple[int, int]] = {}
    drift = scores.model.drift
    for i in np.flatnonzero(out > 0).tolist():
        at, k = last.get(words[i], (-NEAR - 1, 0))
        k = k + 1 if i - at <= NEAR else 1
        last[words[i]] = i, k
        if k > 1:
            out[i] = (out[i] + drift) / k - drift
    return out


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, sum), left to right, in linear time.

    Runs of one sign count as one number first. Candidates are kept with the cumulative sums before
    their left and after their right end; a new one joins all back to the nearest candidate that
    starts lower, if that one ends lower too.
    """
    positive = scores > 0
    if not positive.any():
        return []
    edge = np.concatenate(([0], np.flatnonzero(positive[1:] != positive[:-1]) + 1))
    sums = np.add.reduceat(scores, edge)
    ends = np.append(edge[1:], len(scores))
    out: list[list[float]] = []  # [low, high, start, end, index of the nearest candidate that starts lower]
    total = 0.0
    for s, a, b in zip(sums.tolist(), edge.tolist(), ends.tolist(), strict=True):
        before, total = total, total + s
        if s <= 0:
            continue
        new = [before, total, a, b, -1]
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][0] >= new[0]:
                j = out[j][4]
            if j < 0 or out[j][1] >= new[1]:
                new[4] = j
                out.append(new)
                break
            new[0], new[2] = out[j][0], out[j][2]
            del out[j:]
    return [(int(a), int(b), hi - lo) for lo, hi, a, b, _ in out]


def evidence(model: ToxicityModel, found: list[tuple[int, int, float]], n: int) -> tuple[float, float]:
    """(strongest, sum) of -log E over the significant segments of n tokens; (0, 0) if there is none.

    The strongest counts even where it is not significant.
    """
    if not found:
        return 0.0, 0.0
    s = np.array([x[2] for x in found]) * model.scale - model.log_k - np.log(max(n, 1))
    return float(max(s.max(), 0.0)), float(s[s > -np.log(SIGNIFICANT)].sum())


def probability(model: ToxicityModel, strongest: float, total: float) -> float:
    a, b, c = model.weights
    return float(1 / (1 + np.exp(-np.clip(a + b * np.log1p(strongest) + c * np.log1p(total), -30, 30))))


def _counted(sample: DataFrame) -> DataFrame:
    """(kind, token, y, n): in how many texts of each label each word and each beginning occurs."""

    def rows(counts: dict[tuple, int]) -> pa.RecordBatch:
        kind, token, y = zip(*counts, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(token, pa.binary()), pa.array(y, pa.int32()), pa.array(list(counts.values()), pa.int64())], ["kind", "token", "y", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, int] = {}
        for b in batches:
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = {w.strip(PUNCTUATION) for w in text.lower().encode().split()}
                decoded = [w.decode("utf-8", "replace") for w in words]
                for w in words:
                    counts[0, w, y] = counts.get((0, w, y), 0) + 1
                for n in STEMS:
                    for w in {x[:n] for x in decoded if len(x) >= n}:
                        key = (n, w.encode(), y)
                        counts[key] = counts.get(key, 0) + 1
                if len(counts) > HELD_COUNTS:
                    yield rows(counts)
                    counts = {}
        if counts:
            yield rows(counts)

    return sample.select("text", "y").mapInArrow(work, "kind int, token binary, y int, n long")


def _apart(sample: DataFrame) -> DataFrame:
    """sample without all but one of near copies of one label: of texts with that label that agree in any of
    a few min-hashes of their word triples, the smallest doc_id stays. A group of copies says no more than
    one text; near copies of different labels all stay, as they say what makes the difference."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b.column(2).to_pylist():
                words = text.lower().encode().split()
                triples = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
                out.append([min(xxhash.xxh3_64_intdigest(t, seed) for t in triples) for seed in range(SKETCH)])
            columns = np.array(out, np.uint64).reshape(-1, SKETCH).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:2], *[pa.array(c) for c in columns.T]], ["doc_id", "y", *[f"m{k}" for k in range(SKETCH)]])

    names = [f"m{k}" for k in range(SKETCH)]
    rows = sample.select("doc_id", "y", "text").mapInArrow(work, "doc_id long, y int, " + ", ".join(f"{m} long" for m in names))
    for m in names:
        rows = rows.groupBy("y", m).agg(F.min(F.struct("doc_id", *[n for n in names if n != m])).alias("r")).select("y", m, "r.*")
    ids = materialize(rows.select("doc_id"), "apart")
    # as many ids as the sample has rows at most
    return sample.join(F.broadcast(ids), "doc_id", "left_semi")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """A model from the labelled rows of docs, at most about sample_rows of them.

    Near copies of one label count once. Without rows of both labels (so with empty tables too) the model
    scores every text alike, below one half.
    """
    sample = _apart(materialize(labelled_sample(docs, labels, label, sample_rows), "labelled"))
    part = share_of("doc_id", CALIBRATION, 11)
    sample = materialize(sample.select("text", "y", part.alias("calibrates")), "sample")
    counting, calibrating = sample.where("not calibrates"), sample.where("calibrates")
    sizes = {r.y: r["count"] for r in counting.groupBy("y").count().collect()}
    model = ToxicityModel()
    if not sizes.get(0) or not sizes.get(1):
        return model
    prior = sizes[1] / (sizes[0] + sizes[1])
    counts = _counted(counting).groupBy("kind", "token").agg(F.sum(F.col("n") * F.col("y")).alias("t"), F.sum("n").alias("n")).where(F.col("n") >= LEAST_DOCUMENTS).toPandas()
    tables: dict[int, dict[bytes, float]] = {}
    for kind in (*STEMS[::-1], 0):  # shorter beginnings first, whole words last
        rows, target = counts[counts["kind"] == kind], model.stems if kind else model.words
        here: dict[bytes, float] = {}
        for token, t, n in zip(map(bytes, rows["token"]), rows["t"].tolist(), rows["n"].tolist(), strict=True):
            text = token.decode("utf-8", "replace")
            mean = next((tables[k][s] for k in STEMS if k in tables and len(text) >= k and (s := text[:k].encode()) in tables[k]), prior)
            a, b = t + STRENGTH * mean, n - t + STRENGTH * (1 - mean)
            here[token] = a / (a + b)
            a, b = a + 0.5, b + 0.5
            odds = np.log(a / b) - np.log(prior / (1 - prior))
            target[token] = float(np.sign(odds) * max(0.0, abs(odds) - CAUTION * np.sqrt(1 / a + 1 / b)))
        if kind:
            tables[kind] = here
    del counts, tables

    gains = calibrating.where("y = 0").select("text").mapInArrow(_gains(sample, model), "n long, gain double").agg(F.sum("gain"), F.sum("n")).first()
    model.drift = max(LEAST_DRIFT, DRIFT * gains[0] / gains[1]) if gains[1] else LEAST_DRIFT
    rows = calibrating.select("y", "text").mapInArrow(_strongest(sample, model), "y int, n long, best double").toPandas()
    clean = rows[(rows["y"] == 0) & (rows["n"] > 0)]
    x = clean["best"].to_numpy()
    if len(x) > 20 and x.std() > 0:
        # Gumbel by moments: the mean of -log E is then that of the standard distribution
        model.scale = float(np.pi / np.sqrt(6) / x.std())
        model.log_k = float((model.scale * x - np.log(clean["n"].to_numpy())).mean() - np.euler_gamma)
    # two numbers a text come back, however long it is
    pairs = calibrating.select("y", "text").mapInArrow(_evidence(sample, model), "y int, strongest double, total double").toPandas()
    if 0 < pairs["y"].sum() < len(pairs):
        model.weights = _logistic(np.log1p(pairs[["strongest", "total"]].to_numpy()), pairs["y"].to_numpy(float))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 40) -> tuple[float, float, float]:
    """Weights of a logistic regression with an intercept, by Newton steps. A rare label's rows weigh more, by the
    root of how much rarer they are, as missing a toxic text costs more than doubting a clean one."""
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(x.shape[1])
    keep = ridge * np.diag([0.01] + [1.0] * (x.shape[1] - 1))
    cost = np.where(y == 1, np.sqrt((y == 0).sum() / (y == 1).sum()), 1.0)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (cost * p * (1 - p))[:, None]).T @ x + keep + 1e-9 * np.eye(len(w)), x.T @ (cost * (p - y)) + keep @ w)
    return tuple(w.tolist())


def _gains(df: DataFrame, model: ToxicityModel):
    shared = df.sparkSession.sparkContext.broadcast(replace(model, drift=0.0))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(shared.value)
        for b in batches:
            n, gain = 0, 0.0
            for text in b.column(0).to_pylist():
                words = text.lower().encode().split()
                n += len(words)
                gain += float(np.maximum(token_scores(words, scores), 0).sum())
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([gain], pa.float64())], ["n", "gain"])

    return work


def _strongest(df: DataFrame, model: ToxicityModel):
    """(y, n, best): a text's tokens and the sum of its strongest segment."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(shared.value)
        for b in batches:
            n, best = [], []
            for text in b.column(1).to_pylist():
                words = text.lower().encode().split()
                n.append(len(words))
                best.append(max((x[2] for x in segments(token_scores(words, scores))), default=0.0))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(best, pa.float64())], ["y", "n", "best"])

    return work


def _evidence(df: DataFrame, model: ToxicityModel):
    """(y, strongest, total): a text's evidence by the calibrated model."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, scores = shared.value, Scores(shared.value)
        for b in batches:
            words = [t.lower().encode().split() for t in b.column(1).to_pylist()]
            pairs = np.array([evidence(m, segments(token_scores(w, scores)), len(w)) for w in words]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["y", "strongest", "total"])

    return work


PASSAGES = "array<struct<start:int,end:int,score:double,e_value:double>>"


def score(docs: DataFrame, model: ToxicityModel, passages: bool = False) -> DataFrame:
    """doc_id, score in [0, 1], and if asked for the significant passages as token ranges.

    Reads whole texts, of any length in one scan each; null and empty ones have no segment and the lowest
    score. Repeated rows and null ids give a row each; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        scores = Scores(m)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())]))
        for b in batches:
            out, spans = [], []
            for text in b.column(1).to_pylist():
                words = text.lower().encode().split()
                found = segments(token_scores(words, scores))
                out.append(probability(m, *evidence(m, found, len(words))))
                if passages:
                    rated = [(a, z, s, float(len(words) * np.exp(m.log_k - m.scale * s))) for a, z, s in found]
                    spans.append([dict(zip(("start", "end", "score", "e_value"), r, strict=True)) for r in rated if r[3] < SIGNIFICANT])
            columns = [b.column(0), pa.array(out, pa.float64())] + ([pa.array(spans, kind)] if passages else [])
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "passages"][: len(columns)])

    return documents_of(docs).mapInArrow(work, "doc_id long, score double" + f", passages {PASSAGES}" * passages)


def not_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """The rows of docs, all columns, whose score is below the threshold; nothing is shuffled. Null and empty
    texts stay, repeated rows stay or go alike, an empty table stays empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def keep(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m, scores = shared.value, Scores(shared.value)
        for texts in batches:
            out = []
            for text in texts:
                words = (text or "").lower().encode().split()
                found = segments(token_scores(words, scores))
                out.append(probability(m, *evidence(m, found, len(words))) < threshold)
            yield pd.Series(out, dtype=bool)

    return docs.where(keep("text"))
