import random
import zlib

import numpy as np
import pandas as pd
import pytest

from loretable.llm import packing
from loretable.llm.word_tokens import vocabulary_path, word_tokens

NAMES = "doc_id long, text string, sequence_id string, length string, key string, block string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in rows], NAMES).repartition(3)


def library(text):
    model = word_tokens(vocabulary_path("word_bpe_49k.json")).model
    return model.encode(text, add_special_tokens=False).ids


def test_word_tokens_equal_library():
    rng = random.Random(1)
    letters = ["abAZé'sÄ09½µß´ \t \u0085\x1c.,!!?llre'́Σς中文🙂İİ<|endoftext|>ﬁaaaa", "abAZé'sÄ09½µß´ \t \u0085\x1c\x00.,!!?llre'tvmd\n\xa0ŉĀª"]
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(0, 60))) for _ in range(500) for a in letters]
    texts += ["", "'", "'s", "x'", "'l", "it'", "a" * 5000, "ab " * 3000, "<|startoftext|> x"]
    ids, counts = word_tokens(vocabulary_path("word_bpe_49k.json")).encode(texts)
    for text, got in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert got.tolist() == library(text), text


def test_word_tokens_forget(monkeypatch):
    from loretable.llm import word_tokens as module

    monkeypatch.setattr(module, "REMEMBERED", 50)
    monkeypatch.setattr(module, "AT_ONCE", 300)
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 6))) for _ in range(30)) for _ in range(40)]
    ids, counts = module.WordTokens(vocabulary_path("word_bpe_49k.json")).encode(texts)
    for text, got in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert got.tolist() == library(text)


@pytest.mark.parametrize("capacity", [16, 4096])
def test_packing(spark, capacity):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "beta,", "Gamma", "9x"]) for _ in range(rng.randint(0, 40)))) for i in range(200)]
    rows += [(900, None), (901, ""), (902, "long " * 9000), (5, rows[5][1]), (None, "no id")]
    got = packing.best_fit_packing(frame(spark, rows), capacity, end_id=1).toPandas()
    want = []
    for i, t in rows:
        ids = np.array([*library(t or ""), 1], "<u4")
        want += [(-1 if i is None else i, k, at, len(p := ids[at : at + capacity]), zlib.crc32(p.tobytes())) for k, at in enumerate(range(0, len(ids), capacity))]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(got[columns].fillna(-1).astype(int).itertuples(index=False, name=None)) == sorted(want)
    packed = got.sort_values(["sequence_id", "offset"])
    total = packed.groupby("sequence_id").length.cumsum()
    assert (total - packed.length == packed.offset).all() and total.max() <= capacity
    assert got.sequence_id.nunique() <= -(-got.length.sum() // capacity) * 1.05 + 1


def test_packing_empty(spark):
    assert packing.best_fit_packing(frame(spark, [])).count() == 0


def test_genetic_steps_keep_every_item():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 70, 300).tolist()
    population = [packing.seeded(sizes, 100, rng, 0.3) for _ in range(4)]
    best = max(packing.fitness(p, sizes, 100) for p in population)
    for child in [packing.crossover(population[0], population[1], sizes, 100, rng), packing.mutate(population[2], sizes, 100, rng), packing.evolve(population, sizes, 100, rng, 20)[0]]:
        assert sorted(i for b in child for i in b) == list(range(300))
        assert max(sum(sizes[i] for i in b) for b in child) <= 100
    assert packing.fitness(packing.evolve(population, sizes, 100, rng, 20)[0], sizes, 100) >= best


def best_fit_decreasing(sizes, capacity):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fits = [k for k, room in enumerate(rooms) if room >= s]
        k = min(fits, key=lambda k: rooms[k]) if fits else len(rooms)
        rooms[k:k + 1] = [(rooms[k] if fits else capacity) - s]
    return len(rooms)


def test_search_beats_its_seeds(spark, monkeypatch):
    """Crossover and migration run; over many blocks the count is that of best fit over the whole table, or less."""
    rng = random.Random(3)
    sizes = [rng.randint(20, 60) for _ in range(900)]
    items = spark.createDataFrame([((i,), s) for i, s in enumerate(sizes)], "key struct<id:int>, length long")
    got = packing.pack(items, 100, block=150).toPandas()
    assert sorted(got.length) == sorted(sizes) and got.sequence_id.nunique() <= best_fit_decreasing(sizes, 100)
    # in one task: children come about, and elites that arrive take part
    calls = []
    whole = packing.crossover
    monkeypatch.setattr(packing, "crossover", lambda *x: calls.append(1) or whole(*x))
    frame = pd.DataFrame({"block": [0], "island": [1], "sizes": [np.array(sizes[:150])], "arrived": [[]]})
    one = next(packing._island(100, 0)(iter([frame])))
    assert len(calls) == packing.GENERATIONS
    elite = packing._assignment(packing.seeded(sizes[:150], 100, np.random.default_rng(0), 0.0), 150).tobytes()
    frame["arrived"] = [[elite, one["one"][0]]]
    two = next(packing._island(100, 1)(iter([frame])))
    assert two["bins"][0] <= min(one["bins"][0], len(packing._bins(np.frombuffer(elite, np.int32)))) and len(calls) == 2 * packing.GENERATIONS


def test_shared_hash_goes_through_the_library():
    from loretable.llm.word_tokens import WordTokens

    model = WordTokens(vocabulary_path("word_bpe_49k.json"))
    model.weights[0][:] = 2  # all words of equal letters in any order share a hash
    ids, counts = model.encode(["abc cab bca", "bac 12"])
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [library("abc cab bca"), library("bac 12")]


def test_blocks_and_islands(spark):
    rng = random.Random(9)
    items = [((i,), rng.randint(1, 60)) for i in range(500)]
    got = packing.pack(spark.createDataFrame(items, "key struct<id:int>, length long"), 100, block=60).toPandas()
    assert sorted(r["id"] if isinstance(r, dict) else r[0] for r in got.key) == list(range(500))
    packed = got.sort_values(["sequence_id", "offset"])
    total = packed.groupby("sequence_id").length.cumsum()
    assert (total - packed.length == packed.offset).all() and total.max() <= 100
