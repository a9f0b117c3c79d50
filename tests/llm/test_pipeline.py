import importlib
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from test_classifiers import toxic_rows

import corpus_pipeline
from loretable.llm.common import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "kept", "score"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows, labels = toxic_rows(400)
    quality = {i: 1 for i, _ in rows}
    for i in range(1000, 1120):
        rows.append((i, " | ".join(rows[i % 400][1].split())))
        quality[i] = 0
    rows += [(2000 + k, rows[1][1].replace(" ", "  ")) for k in range(3)] + [(3000, None), (3001, ""), (1, rows[1][1])]
    docs = {"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "lang": ["en"] * len(rows), "source": [None] * len(rows), "n_chars": [1] * len(rows), "kept": ["x"] * len(rows), "score": [0.5] * len(rows)}
    pq.write_table(pa.table(docs, schema=pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64()), ("kept", pa.string()), ("score", pa.float64())])), path / "documents.parquet")
    toxic = dict(labels)
    pq.write_table(pa.table({"doc_id": list(quality), "quality": list(quality.values()), "toxic": [toxic.get(i, 0) for i in quality]}), path / "labels.parquet")
    return path, rows, toxic, quality


def test_stages(spark, folder):
    path, rows, toxic, quality = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    ids = {0: {r.doc_id for r in docs.collect()}}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1], 1):
        docs = materialize(stage(spark, docs, str(path)), "test")
        assert docs.columns == COLUMNS, name
        ids[k] = {r.doc_id for r in docs.collect()}
        assert ids[k] <= ids[k - 1]
    bad = {i for i, y in toxic.items() if y}
    assert len(bad & ids[1]) < 0.05 * len(bad) and len(ids[1]) > 0.9 * (len(ids[0]) - len(bad))
    low = {i for i, y in quality.items() if not y}
    assert len(low & ids[2]) < 0.05 * len(low) and len(ids[1] - ids[2] - low) < 0.05 * len(ids[1])
    assert len(ids[3] & {1, 2000, 2001, 2002}) <= 1 and len(ids[3] & {3000, 3001}) <= 1
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(path)).toPandas()
    assert set(packed.doc_id) == ids[4]


def test_run(spark, folder):
    got = corpus_pipeline.run(spark, str(folder[0]))
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.count() > 200


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality classifier", "exact dedup", "simhash near-dedup", "best-fit packing"]
    entry = importlib.import_module("__spark_entry__")
    assert {f"op{n}_" for n in range(1, 14)} == {k.split("_")[0] + "_" for k in entry.queries() if k.startswith("op")}
    assert "pipeline" in entry.queries()


def test_simhash_stage_finds_planted_near_copies(spark):
    """Copies at a similarity of 0.8 to 0.95 go; texts that are less alike stay, null and repeated ids too."""
    rng = random.Random(11)
    shingles = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    rows, copies = [], []
    for i in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(150, 600))]
        copy = list(words)
        aim = rng.uniform(0.81, 0.95)
        while True:
            next_ = list(copy)
            next_[rng.randrange(len(copy))] = f"n{rng.randrange(5000)}"
            a, b = shingles(words), shingles(next_)
            if len(a & b) / len(a | b) < aim:
                break
            copy = next_
        rows += [(i, " ".join(words)), (1000 + i, " ".join(copy))]
        copies.append(1000 + i)
        # half of it is new: stays
        rows.append((2000 + i, " ".join(words[: len(words) // 2] + [f"h{rng.randrange(5000)}" for _ in range(len(words) // 2)])))
    rows += [(None, "one text"), (None, "another text"), (5, "a second text of one id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.STAGES[3][1](spark, docs, "").collect()
    left = {r.doc_id for r in got}
    assert set(range(60)) <= left and set(range(2000, 2060)) <= left
    assert sum(c in left for c in copies) <= 3
    assert sum(r.doc_id is None for r in got) == 2 and sum(r.doc_id == 5 for r in got) == 2


def test_columns_of_any_name_and_ids_of_any_kind(spark):
    """Exact and near stages keep columns whose names are used inside, and lose no text for its id."""
    names = ["_id", "_maybe", "_drop", "_row", "_key", "_salt", "h", "key", "root", "node", "a.b", "kept"]
    texts = [(1, "same  text"), (5, "same text"), (5, "unique words that occur once"), (2, "A b"), (2, "B c"), (None, "C d"), (None, "D e"), (None, "C d"), (7, None), (8, "")]
    docs = spark.createDataFrame([(i, t, *range(len(names))) for i, t in texts], "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names))
    exact = corpus_pipeline.STAGES[2][1](spark, docs, "")
    left = [{"same  text", "unique words that occur once", "A b", "B c", "C d", "D e"}, {(r.doc_id, r.text) for r in exact.collect()}]
    assert {t for _, t in left[1] if t} == left[0] and len(left[1]) == 7 and exact.count() == 7
    near = corpus_pipeline.STAGES[3][1](spark, docs, "")
    assert exact.columns == near.columns == docs.columns and {r.text for r in near.collect() if r.text} >= {"unique words that occur once", "A b", "B c", "C d", "D e"}
    for stage in corpus_pipeline.STAGES[2:4]:
        assert stage[1](spark, docs.limit(0), "").count() == 0
