import hashlib
import random
import re

import numpy as np
import pytest

from loretable.llm import fill_in_middle as fim

FIXED = ("<P>", "<S>", "<M>")


def expected(i, text):
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    n, digest = len(units), hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in FIXED) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return n, "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


@pytest.mark.parametrize("window", [1, 3, 64, 1 << 20])
def test_scatter_and_gather_equal_the_definition(monkeypatch, window):
    monkeypatch.setattr(fim, "WINDOW", window)
    rng = random.Random(window)
    for _ in range(25):
        texts = ["".join(rng.choice("aB <P>SMé中😀\n1") for _ in range(rng.choice((0, 1, 2, 5, 40)))) for _ in range(rng.randrange(12))]
        raw = [t.encode() for t in texts]
        data, bounds = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])
        want = [expected(i, t) for i, t in enumerate(texts)]
        h = np.array([[int(hashlib.sha256(f"1:{i}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in (0, 1)] for i in range(len(texts))], np.int64).reshape(-1, 2)
        form = np.array([fim.FORMS.index(w[1]) for w in want], np.int32)
        out, ends, n, prefix, middle = fim.scatter(data, bounds, form, h[:, 0], h[:, 1])
        assert [out[a:z].tobytes().decode() for a, z in zip(ends, ends[1:], strict=False)] == [w[4] for w in want]
        assert n.tolist() == [w[0] for w in want]
        assert [(prefix[i], middle[i]) for i, w in enumerate(want) if w[2] is not None] == [w[2:4] for w in want if w[2] is not None]
        back, again = fim.gather(out, ends, form)
        assert back.tobytes() == data.tobytes() and (again == bounds).all()


def test_rows_with_nulls_repeats_marks_and_clashing_columns(spark):
    long = "Wort für Wort, 一字一字。 " * 60_000
    rows = [(1, "one two  three\n4"), (2, None), (3, ""), (4, "a <P> b"), (5, long), (5, long), (None, "no id"), (7, "aaaa"), (8, "é")] + [(100 + i, f"text {i} with words, more words") for i in range(60)]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, form string, output string")
    got = fim.restored(fim.fill_in_middle(docs)).collect()
    assert len(got) == len(rows)
    seen = {r.doc_id: r for r in got}
    for i, t in rows:
        r, want = seen[i], expected(i, t or "")
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) == (*want, t or "")
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.restored(fim.fill_in_middle(docs.limit(0))).count() == 0


def test_outputs_that_miss_a_mark_are_an_error():
    data = np.frombuffer(b"<P>a<S>b", np.uint8)
    with pytest.raises(ValueError):
        fim.gather(data, np.array([0, len(data)]), np.array([fim.PSM]))
