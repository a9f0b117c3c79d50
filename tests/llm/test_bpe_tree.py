import hashlib
import random

import pytest

from loretable.llm import bpe_tree

NAMES = "doc_id long, text string, ids string, n_tokens int, bytes string"
LETTERS = "aA bB'sé  \n\t\r\x0b\x1c\x85\xa0  12½ ,.!?-中文🙂é‍　"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "a", 1, "c") for i, t in rows], NAMES).repartition(3)


@pytest.fixture(scope="module")
def tree():
    return bpe_tree.codec(*bpe_tree.vocabulary())


@pytest.fixture(scope="module")
def model(tree):
    """The library, with the same ranks and pattern."""
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=bpe_tree.vocabulary()[1], mergeable_ranks=tree.ranks, special_tokens={})


@pytest.mark.parametrize("leaf", [1, 2, 7, 50])
def test_tree_equals_whole(tree, model, leaf, monkeypatch):
    monkeypatch.setattr(bpe_tree, "WINDOW", 1)
    rng = random.Random(leaf)
    for _ in range(1500):
        text = "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 80)))
        ids = tree.encode(text, leaf)
        assert ids == model.encode_ordinary(text), repr(text)
        assert tree.decode(ids) == text.encode()


def test_join_is_associative(tree):
    rng = random.Random(8)
    for _ in range(300):
        a, b, c = ("".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 30))) for _ in range(3))
        ea, eb, ec = (tree.leaf(x) for x in (a, b, c))
        left = tree.join(a + b, tree.join(a, ea, b, eb), c, ec)
        assert left == tree.join(a, ea, b + c, tree.join(b, eb, c, ec)) == tree.leaf(a + b + c)


def test_long_texts(tree, model):
    rng = random.Random(5)
    blind = "".join(rng.choice("abcdeé") for _ in range(30_000))
    for text in ("word " * 20_000, "x" * 40_000, " " * 50_000, "it's 12 " * 9000 + "\n" * 30_000, blind, "ab" * 10_000 + "1234" * 5000, "中文字" * 8000 + "。" + "語" * 9000, "'" * 9000 + "ll" * 9000):
        assert tree.encode(text) == model.encode_ordinary(text)


def test_round_trip(spark, tree, model):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 300)))) for i in range(60)] + [(100, None), (101, ""), (None, "x"), (3, "again")]
    got = bpe_tree.round_trip(frame(spark, rows), leaf=40).collect()
    want = []
    for i, t in rows:
        ids = model.encode_ordinary(t or "")
        want.append((i if i is not None else -1, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == sorted(want)
    texts = {r.doc_id: bytes(r.bytes).decode() for r in bpe_tree.decode_ids(bpe_tree.encode_texts(frame(spark, rows[:60]), leaf=16)).collect()}
    assert texts == dict(rows[:60])
    assert bpe_tree.round_trip(frame(spark, [])).count() == 0


def test_merges_inside_a_match(tree, model):
    """Halves of one match are joined by windows of ids; both ways of merging agree with the library."""
    rng = random.Random(6)
    for _ in range(2000):
        word = "".join(rng.choice(["tion", "the", "a", "b", "ing", "é", "x", "s"]) for _ in range(rng.randint(1, 60)))
        data = word.encode()
        want = model.encode_ordinary(word)
        assert tree.match(data) == want
        if len(want) > 1:
            assert tree.merged(data) == tree._merged_by_heap(data) == want
            cut = rng.randint(1, len(data) - 1)
            assert tree.glued(tree.merged(data[:cut]), tree.merged(data[cut:])) == want


def test_all_characters(tree, model):
    """Characters of Unicode in each neighbourhood are split and merged as by the library."""
    at = [*range(0xD800), *range(0xE000, 0x24000, 3), *range(0x24000, 0x110000, 501)]
    for lo in range(0, len(at), 4000):
        for form in ("a{0}a1{0}1 {0} !{0}!{0}\n", "{0}'s{0}{0}  {0}"):
            text = "".join(form.format(chr(c)) for c in at[lo : lo + 4000])
            assert tree.encode(text) == model.encode_ordinary(text)
    tree.known.clear()


def test_every_text_beyond_a_leaf_is_joined(tree, monkeypatch):
    joined = []
    whole = bpe_tree.TreeCodec.join
    monkeypatch.setattr(bpe_tree.TreeCodec, "join", lambda self, *x: joined.append(1) or whole(self, *x))
    tree.encode("some words of a text " * 250)
    assert len(joined) >= 5
