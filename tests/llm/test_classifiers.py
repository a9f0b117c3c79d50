import random

import numpy as np

from loretable.llm import quality, toxicity

NAMES = "doc_id long, text string, score double, held_out string, y int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 0.1, "h", 9) for i, t in rows], NAMES).repartition(3)


def word(rng):
    return "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))


def best_segments(x):
    """All maximal scoring segments by their definition: split at the best one, recursively."""
    best = max(((sum(x[a:b]), a - b, a, b) for a in range(len(x)) for b in range(a + 1, len(x) + 1)), default=(0,))
    top = [(a, b) for a in range(len(x)) for b in range(a + 1, len(x) + 1) if sum(x[a:b]) == best[0]]
    if best[0] <= 0:
        return []
    a, b = min(top, key=lambda s: (s[1] - s[0], s[0]))
    return best_segments(x[:a]) + [(a, b, best[0], )] + [(p + b, q + b, s) for p, q, s in best_segments(x[b:])]


def test_segments_by_definition():
    rng = random.Random(1)
    for _ in range(400):
        x = [rng.choice([-1, 1]) * (2.0 ** -rng.randint(3, 40) + rng.randint(0, 5)) for _ in range(rng.randint(0, 14))]
        got = [(a, b, round(s, 6)) for a, b, s in toxicity.segments(np.array(x))]
        assert got == [(a, b, round(s, 6)) for a, b, s in best_segments(x)], x


def toxic_rows(n, start=0):
    rng = random.Random(start + 7)
    rows, labels = [], []
    for i in range(start, start + n):
        words = [word(rng) for _ in range(rng.randint(5, 80))]
        bad = i % 4 == 0
        if bad:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["Vile,", "nasty", "foulish" + word(rng)]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_rows(600)
    table = spark.createDataFrame([(i, y, "extra") for i, y in labels] + [(5, None, ""), (None, 1, ""), (8, 1, "")], "doc_id long, toxic int, text string")
    model = toxicity.fit(frame(spark, rows), table)
    fresh, truth = toxic_rows(300, 10_000)
    odd = [(1, None), (2, ""), (3, "é" * 100_000), (None, "nasty"), (4, "nasty " * 30_000)]
    got = {r.doc_id: r.score for r in toxicity.score(frame(spark, fresh + odd), model).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == 305
    right = [(got[i] >= 0.7) == bool(y) for i, y in truth]
    assert np.mean(right) > 0.95
    assert got[1] == got[2] < 0.5
    spans = toxicity.score(frame(spark, [(1, "aaa bbb vile nasty vile ccc")]), model, passages=True).first().passages
    assert spans and spans[0].start >= 1 and spans[0].end <= 5
    kept = {r.doc_id for r in toxicity.not_toxic(frame(spark, fresh), model).collect()}
    assert kept == {i for i, _ in fresh if got[i] < 0.7}


def test_every_copy_of_a_passage_is_found(spark):
    """The same passage at the start, in the middle and at the end scores alike; one word over and over is no passage."""
    passage = "vile nasty foul grim mean base"
    model = toxicity.ToxicityModel(words={w.encode(): 1.2 for w in passage.split()}, drift=0.05, log_k=-3.0)
    clean = " ".join(f"word{i}" for i in range(200))
    texts = [(1, f"{passage} {clean} {passage} {clean} {passage}"), (2, f"{clean} {passage} {clean}"), (3, f"{clean} " + "vile " * 200 + clean), (4, clean)]
    spans = {r.doc_id: r.passages for r in toxicity.score(frame(spark, texts), model, passages=True).collect()}
    assert [(p.start, p.end) for p in spans[1]] == [(0, 6), (206, 212), (412, 418)] and len({round(p.score, 9) for p in spans[1]}) == 1
    assert [(p.start, p.end) for p in spans[2]] == [(200, 206)] and round(spans[2][0].score, 9) == round(spans[1][0].score, 9)
    assert spans[4] == [] and sum(p.score for p in spans[3]) < 3 * spans[2][0].score


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(frame(spark, [(1, "a")]), none)
    assert toxicity.score(frame(spark, [(1, "a b"), (2, None)]), model).where("score < 0.5").count() == 2
    assert toxicity.score(frame(spark, []), model).count() == 0


def quality_rows(n, start=0):
    rng = random.Random(start + 5)
    rows = []
    for i in range(start, start + n):
        words = [word(rng) for _ in range(rng.randint(5, 120))]
        bad = i % 3 == 0
        rows.append((i, (" | " if bad else " ").join(words), int(not bad)))
    return rows


def test_quality(spark):
    rows = quality_rows(500)
    labels = spark.createDataFrame([(i, y, 3) for i, _, y in rows] + [(None, 1, 0), (2, None, 0)], "doc_id long, quality int, n long")
    model = quality.fit(frame(spark, [r[:2] for r in rows]), labels)
    fresh = quality_rows(200, 5000)
    odd = [(1, None), (2, ""), (3, "x"), (4, "é |" * 60_000), (None, "x y")]
    got = {r.doc_id: r.score for r in quality.score(frame(spark, [r[:2] for r in fresh] + odd), model).collect()}
    assert len(got) == 205 and all(0 <= s <= 1 for s in got.values())
    assert np.mean([(got[i] >= 0.3) == bool(y) for i, _, y in fresh]) > 0.95
    assert got[1] == got[2]
    kept = {r.doc_id for r in quality.good(frame(spark, [r[:2] for r in fresh]), model).collect()}
    assert kept == {i for i, _, _ in fresh if got[i] >= 0.3}


def test_quality_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(frame(spark, [(1, "a")]), none)
    assert model is None and [r.score for r in quality.score(frame(spark, [(1, "a")]), model).collect()] == [0.5]
    assert quality.score(frame(spark, []), model).count() == 0


def test_quality_with_a_huge_labelled_text(spark):
    """A text beyond the bound, or nearly all of it, at the smallest id leaves the others to train on."""
    rows = quality_rows(300, 10)
    for huge in (70_000, 59_000):
        table = spark.createDataFrame([(1, 1), *((i, y) for i, _, y in rows)], "doc_id long, quality int")
        model = quality.fit(frame(spark, [(1, "x " * (huge // 2)), *(r[:2] for r in rows)]), table, sample_bytes=60_000)
        assert model is not None
        fresh = quality_rows(60, 5000)
        assert np.mean([(quality.predict(model, t.encode()) >= 0.3) == bool(y) for _, t, y in fresh]) > 0.9


def test_training_texts_within_the_bound():
    sizes, y = np.array([900, 5, 10, 12, 900, 3, 15, 14]), np.array([0, 1, 0, 1, 1, 0, 1, 0])
    for room in (0, 40, 640, 1000, 5000):
        take = quality.within(sizes, y, room)
        assert sizes[take].sum() <= room and (take.all() if room == 5000 else True)
    assert quality.within(sizes, y, 930).tolist() == [False, True, True, True, False, True, True, True]


def test_network_covers_every_byte_and_matches_plain_loops(monkeypatch):
    m = quality.QualityModel.fresh(np.random.default_rng(1))
    text = bytes(np.random.default_rng(2).integers(1, 256, 5000, dtype=np.uint8))
    data = quality.padded(text)
    act = quality.activations(m, data)
    for p in (0, 7, len(act) - 1):
        window = m.embed[data[p * quality.STEP : (p + quality.SPAN) * quality.STEP]].reshape(quality.SPAN, -1)
        assert np.allclose(act[p], np.einsum("ke,kef->f", window, m.filters) + m.bias, atol=1e-4)
    whole = quality.predict(m, text)
    monkeypatch.setattr(quality, "AT_ONCE", quality.STEP * quality.CELL * 3)
    assert abs(quality.predict(m, text) - whole) < 1e-6
    for cells in range(1, 60):
        covered = {c for s in quality.chunk_starts(cells) for c in range(s, min(s + quality.CHUNK, cells))}
        assert covered == set(range(cells))


def test_gradients_match_differences():
    rng = np.random.default_rng(3)
    m = quality.QualityModel.fresh(rng)
    for name in ("embed", "filters", "bias", "dense"):
        setattr(m, name, getattr(m, name).astype(np.float64))
    texts = [bytes(rng.integers(97, 110, n, dtype=np.uint8)) for n in (5, 700, 1500)]
    y = np.array([0.0, 1.0, 1.0])

    def loss():
        return -np.mean([np.log(p if t else 1 - p) for t, p in zip(y, [quality.predict(m, t) for t in texts], strict=True)])

    grads = quality._gradients(m, [quality.padded(t) for t in texts], y)
    for p, g in zip([m.embed, m.filters, m.bias, m.dense], grads, strict=True):
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in p.shape)
            if p is m.embed:
                at = (int(rng.integers(97, 110)), at[1])
            was = p[at]
            p[at] = was + 1e-6
            up = loss()
            p[at] = was - 1e-6
            down = loss()
            p[at] = was
            assert abs((up - down) / 2e-6 - g[at]) < 1e-4
