"""Quality classifier: a byte-level convolutional network in numpy.

A document's bytes are embedded, convolved with learned filters in steps of a few bytes, rectified
and max-pooled in overlapping chunks that cover the whole document. The largest and the mean
activation of each filter over all chunks are combined into one probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loretable.llm.common import documents_of, labelled_sample

#: Labelled rows that the network is trained on at most, chosen by a hash of the id, and the bytes
#: that whole texts of them may hold together in the driver. Where all of them do not fit, texts of
#: more than 1 / LONG of these bytes come last.
SAMPLE_ROWS, SAMPLE_BYTES, LONG = 4000, 24_000_000, 64
#: Bytes per step, steps that a filter spans, size of a byte's embedding, filters.
STEP, SPAN, EMBED, FILTERS = 4, 3, 8, 24
#: Steps of a pooling cell; cells of a chunk, and cells from one chunk to the next (the rest overlaps).
CELL, CHUNK, HOP = 16, 8, 6
#: Documents of a training step, passes over the sample, learning rate.
BATCH, PASSES, RATE = 32, 9, 0.01
#: Bytes convolved at once; bounds memory for very long texts.
AT_ONCE = 1 << 20


@dataclass
class QualityModel:
    embed: np.ndarray  # (256, EMBED)
    filters: np.ndarray  # (SPAN, STEP * EMBED, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    dense: np.ndarray  # (2 * FILTERS + 1,)

    @staticmethod
    def fresh(rng: np.random.Generator) -> QualityModel:
        return QualityModel(
            rng.normal(0, 0.5, (256, EMBED)).astype(np.float32), rng.normal(0, (2 / (SPAN * STEP * EMBED)) ** 0.5, (SPAN, STEP * EMBED, FILTERS)).astype(np.float32),
            np.zeros(FILTERS, np.float32), np.append(rng.normal(0, 0.1, 2 * FILTERS), 0).astype(np.float32),
        )


def padded(text: bytes) -> np.ndarray:
    """Bytes with zeros in front and behind, so that each byte stands in SPAN windows; whole cells."""
    lead = STEP * (SPAN - 1)
    steps = -(-max(len(text), 1) // STEP) + SPAN - 1
    steps = -(-steps // CELL) * CELL
    out = np.zeros(lead + steps * STEP, np.uint8)
    out[lead : lead + len(text)] = np.frombuffer(text, np.uint8)
    return out


def activations(m: QualityModel, data: np.ndarray) -> np.ndarray:
    """(steps, FILTERS) before rectifying, for bytes padded as above."""
    rows = m.embed[data].reshape(-1, STEP * EMBED)
    wide = rows @ m.filters.transpose(1, 0, 2).reshape(STEP * EMBED, -1)
    n = len(rows) - SPAN + 1
    out = wide[:n, :FILTERS] + m.bias
    for k in range(1, SPAN):
        out += wide[k : n + k, k * FILTERS : (k + 1) * FILTERS]
    return out


def chunk_starts(cells: int) -> np.ndarray:
    """First cell of each chunk; the last chunk reaches the end."""
    return np.append(np.arange(0, max(1, cells - CHUNK), HOP), max(0, cells - CHUNK)) if cells > CHUNK else np.zeros(1, np.int64)


def pooled_cells(m: QualityModel, data: np.ndarray) -> np.ndarray:
    """(cells, FILTERS): the largest activation in each cell."""
    lead, size = STEP * (SPAN - 1), AT_ONCE // (STEP * CELL) * STEP * CELL
    parts = [activations(m, data[at : at + size + lead]) for at in range(0, len(data) - lead, size)]
    return np.concatenate([p.reshape(-1, CELL, FILTERS).max(axis=1) for p in parts])


def chunks_of(cells: np.ndarray) -> np.ndarray:
    starts = chunk_starts(len(cells))
    out = cells[starts]
    for k in range(1, min(CHUNK, len(cells))):
        out = np.maximum(out, cells[starts + k])
    return np.maximum(out, 0)


def predict(m: QualityModel, text: bytes) -> float:
    """Probability of label 1 for one whole text."""
    chunks = chunks_of(pooled_cells(m, padded(text)))
    z = float(chunks.max(axis=0) @ m.dense[:FILTERS] + chunks.mean(axis=0) @ m.dense[FILTERS:-1] + m.dense[-1])
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(texts: list[bytes], y: np.ndarray, seed: int = 0) -> QualityModel:
    """Fits the network by Adam on the log loss. Gradients reach filters at pooled maxima only."""
    rng = np.random.default_rng(seed)
    m = QualityModel.fresh(rng)
    data = [padded(t) for t in texts]
    params = [m.embed, m.filters, m.bias, m.dense]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step, steps = 0, PASSES * -(-len(texts) // BATCH)
    for _ in range(PASSES):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), BATCH):
            step += 1
            grads = _gradients(m, [data[i] for i in order[lo : lo + BATCH]], y[order[lo : lo + BATCH]])
            rate = RATE * (1 - step / (steps + 1))
            for p, g, a, b in zip(params, grads, first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return m


def _gradients(m: QualityModel, batch: list[np.ndarray], y: np.ndarray) -> list[np.ndarray]:
    lead = STEP * (SPAN - 1)
    table = np.zeros((SPAN * STEP, 256, FILTERS), np.float32)  # by place in the window, byte, filter
    bias, dense = np.zeros(FILTERS, np.float32), np.zeros_like(m.dense)
    places, bases, weights = [], [], []
    flat = np.concatenate(batch)
    base = 0
    for data, label in zip(batch, y, strict=True):
        act = activations(m, data)
        cells = act.reshape(-1, CELL, FILTERS)
        where = cells.argmax(axis=1)
        top = np.take_along_axis(cells, where[:, None], axis=1)[:, 0]
        starts = chunk_starts(len(top))
        index = np.minimum(starts[:, None] + np.arange(CHUNK), len(top) - 1)
        inside = top[index]  # chunk, cell, filter
        best = inside.argmax(axis=1)
        chunks = np.take_along_axis(inside, best[:, None], axis=1)[:, 0]
        live = chunks > 0
        chunks = np.maximum(chunks, 0)
        high = chunks.argmax(axis=0)
        feats = np.concatenate((chunks.max(axis=0), chunks.mean(axis=0), [1.0])).astype(np.float32)
        d = (1 / (1 + np.exp(-np.clip(feats @ m.dense, -30, 30))) - label) / len(batch)
        dense += d * feats
        g = np.broadcast_to(d * m.dense[FILTERS:-1] / len(chunks), chunks.shape).copy()
        g[high, np.arange(FILTERS)] += d * m.dense[:FILTERS]
        g *= live
        cell = np.take_along_axis(index, best, axis=1)
        places.append(cell * CELL + where[cell, np.arange(FILTERS)])
        weights.append(g)
        bases.append(np.full(len(g), base))
        base += len(data)
    place = np.concatenate(places) * STEP + np.concatenate(bases)[:, None]
    weight = np.concatenate(weights)
    bias += weight.sum(axis=0)
    columns = np.broadcast_to(np.arange(FILTERS), place.shape).ravel()
    for k in range(SPAN * STEP):
        key = flat[place + k].ravel().astype(np.int64) * FILTERS + columns
        table[k] = np.bincount(key, weight.ravel(), minlength=256 * FILTERS).reshape(256, FILTERS)
    w = m.filters.reshape(SPAN * STEP, EMBED, FILTERS)
    filters = np.einsum("be,kbf->kef", m.embed, table).reshape(m.filters.shape)
    embed = np.einsum("kbf,kef->be", table, w)
    return [embed, filters, bias, dense]


def within(sizes: np.ndarray, y: np.ndarray, room: int) -> np.ndarray:
    """Which texts to train on, of those given in hash order, so that their bytes fit the room.

    All, if they fit. Else each label first takes its share of the room by rows from texts that are
    not long, then all others in turn; a text too long for what is left is passed over alone.
    """
    take = np.zeros(len(sizes), bool)
    left = {k: room * (y == k).sum() / max(1, len(y)) for k in (0, 1)}
    for i in np.flatnonzero(sizes <= room // LONG):
        if sizes[i] <= left[int(y[i])]:
            take[i] = True
            left[int(y[i])] -= sizes[i]
    rest = room - sizes[take].sum()
    for i in (*np.flatnonzero(~take & (sizes <= room // LONG)), *np.flatnonzero(sizes > room // LONG)):
        if sizes[i] <= rest:
            take[i] = True
            rest -= sizes[i]
    return take


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> QualityModel | None:
    """A network trained on the labelled rows of docs, at most about sample_rows of them.

    Their whole texts hold at most sample_bytes (UTF-8) together; which ones are read is chosen from
    ids and lengths, in the order of a hash. None without rows of both labels (that fit): every text
    then scores one half.
    """
    labelled = labelled_sample(docs, labels, label, sample_rows).withColumn("key", F.xxhash64("doc_id", "text"))
    sizes = labelled.select("key", F.octet_length("text").alias("size"), "y").distinct().toPandas().sort_values(["key", "size"])
    chosen = sizes["key"][within(sizes["size"].to_numpy(np.int64), sizes["y"].to_numpy(), sample_bytes)]
    if len(chosen) < len(sizes):
        labelled = labelled.join(F.broadcast(docs.sparkSession.createDataFrame([(int(k),) for k in chosen], "key long")), "key", "left_semi")
    one = labelled.dropDuplicates(["key"]) if labelled.count() > len(chosen) else labelled
    rows = one.select("doc_id", F.encode("text", "UTF-8").alias("text"), "y").toPandas().sort_values("doc_id")
    texts, y = [bytes(t) for t in rows["text"]], rows["y"].to_numpy(np.float32)
    return train(texts, y) if len(y) and 0 < y.sum() < len(y) else None


def score(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """doc_id, score in [0, 1]: the probability of label 1 for each whole text (null: empty).

    Long texts are convolved piece by piece in bounded memory; of equal activations in a cell either gives
    the same maximum. Repeated rows and null ids give a row each; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            out = [0.5 if m is None else predict(m, t) for t in b.column(1).cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.float64())], ["doc_id", "score"])

    return documents_of(docs).mapInArrow(work, "doc_id long, score double")


def good(docs: DataFrame, model: QualityModel | None, threshold: float = 0.3) -> DataFrame:
    """The rows of docs, all columns, that score at least the threshold; nothing is shuffled. Null texts are
    scored as empty ones, repeated rows stay or go alike, an empty table stays empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def keep(texts: pd.Series) -> pd.Series:
        m = shared.value
        return pd.Series([m is None or predict(m, (t or "").encode()) >= threshold for t in texts], dtype=bool)

    return docs.where(keep("text"))
