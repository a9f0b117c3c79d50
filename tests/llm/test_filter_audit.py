import random
from collections import Counter
from itertools import permutations

import pytest

from loretable.llm import filter_audit as fa

COLUMNS = "doc_id long, text string, lang string, kept long, part string"
WORDS = [f"w{i}" for i in range(150)]


def text(kind):
    return {
        "good": " ".join(WORDS), "short": "few words", "same": "word " * 120, "loud": " ".join(w.upper() * 3 for w in WORDS), "junk": " ".join(WORDS) + " #", "bad": "A$ " * 20, "empty": "", "null": None, "blank": " \t\n",
    }[kind]


def brute(rows, labels):
    """All measures, by going through the rows for each order."""
    texts, least = [(i, t or "", lang or "") for i, t, lang in rows], {}
    for i, t, _ in texts:
        if i is not None:
            least[t] = min(i, least.get(t, i))
    good, toxic = {d for d, q, _ in labels if q == 1 and d is not None}, {d for d, _, x in labels if x == 1 and d is not None}
    fails = []
    for i, t, lang in texts:
        words = t.encode().split()
        bad = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), "D": any(c in "#$%&*|" for c in t), "E": i is not None and least[t] < i}
        fails.append((i, lang, {k for k, v in bad.items() if v}))
    out = {}
    for part in {lang for _, lang, _ in fails}:
        mine, shapley = [f for f in fails if f[1] == part], Counter()
        for order in permutations("ABCDE"):
            for i, _, f in mine:
                if first := next((x for x in order if x in f), None):
                    shapley[first] += 1
        for order in permutations("ABCDE"):
            for k, x in enumerate(order):
                earlier = set(order[:k])
                gone = [f for f in mine if x in f[2] and not f[2] & earlier]
                out[part, "".join(order), k + 1] = (
                    sum(not f[2] & (earlier | {x}) for f in mine), len(gone), sum(x in f[2] and bool(f[2] & earlier) for f in mine), sum(f[2] == {x} for f in mine), sum(f[0] in good for f in gone), sum(f[0] in toxic for f in gone), shapley[x],
                )
    return out


def result(audit):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in audit.collect()}


def write(spark, path, rows, files=1):
    spark.createDataFrame([(i, t, lang, 1, "x") for i, t, lang in rows], COLUMNS).repartition(files).write.mode("append").parquet(path)


@pytest.mark.parametrize("batches", [1, 3])
def test_equals_brute_force_over_many_files(spark, tmp_path, batches):
    rng = random.Random(batches)
    kinds = ["good", "short", "same", "loud", "junk", "bad", "empty", "null", "blank"]
    rows = [(i, text(rng.choice(kinds)) if rng.random() < 0.6 else f"{text('good')} {rng.randrange(12)}", rng.choice(["en", "de", None])) for i in rng.sample(range(1000), 90)]
    rows += rows[:5] + [(None, text("good"), "en"), (None, text("short"), None)]
    labels = [(i, rng.choice((0, 1, None)), rng.choice((0, 1, None))) for i, _, _ in rows[:60] if i is not None] + [(rows[0][0], 1, 1), (None, 1, 1)]
    path = f"{tmp_path}/documents.parquet"
    write(spark, path, rows, 6)
    got = result(fa.filter_audit(spark, path, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), batches=batches, page_bytes=2000))
    assert got == brute(rows, labels)


def test_later_files_with_smaller_ids_take_masks_back(spark, tmp_path):
    path, state = f"{tmp_path}/documents.parquet", str(tmp_path / "state")
    labels = [(10, 1, 0), (3, 0, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = [(10, text("good"), "en"), (11, text("good"), "de"), (10, text("good"), "de")]
    write(spark, path, rows)
    first = fa.part_counters(spark, path, frame, state=state)
    assert {(r.part, r["mask"]): r.rows for r in first.collect()} == {("en", 0): 1, ("de", 0): 1, ("de", 16): 1}
    more = [(3, text("good"), "fr"), (12, text("good"), "fr")]
    write(spark, path, more)
    counters = fa.part_counters(spark, path, frame, state=state)
    assert {(r.part, r["mask"]): (r.rows, r.good, r.toxic) for r in counters.collect()} == {("en", 16): (1, 1, 0), ("de", 16): (2, 1, 0), ("fr", 0): (1, 0, 1), ("fr", 16): (1, 0, 0)}
    assert result(fa.interactions(counters)) == brute(rows + more, labels)
    changes = spark.read.parquet(f"{state}/changes").where("rows < 0").collect()
    assert {(r.part, r["mask"]) for r in changes} == {("en", 0), ("de", 0)}


def test_empty_table(spark, tmp_path):
    path = f"{tmp_path}/documents.parquet"
    write(spark, path, [])
    assert fa.filter_audit(spark, path, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
