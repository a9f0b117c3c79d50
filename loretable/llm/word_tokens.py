"""Tokenising with a public word vocabulary, many words at once in numpy.

The vocabulary lower-cases, drops white space, splits text into runs of letters, single digits, runs
of other characters and a few contractions, and merges byte pairs inside each of these parts. Parts
are found for some megabytes of text at once by comparing neighbouring character classes; each
distinct part is merged once and remembered by its hash (should two parts share one, their texts go
through the tokenizers library). Texts with characters that may compose or change their length in
lower case (from U+0130) go through it too.
"""

from __future__ import annotations

import json
from functools import cache, cached_property

import numpy as np

#: Characters of text handled at once, and distinct parts remembered; both bound memory, not results.
AT_ONCE, REMEMBERED = 500_000, 200_000
#: Longest part merged here; texts with longer ones go to the library.
LONGEST = 2000
#: Below this code point, lower-casing is one to one and characters are their own composed form.
PLAIN = 0x130
SPACE, LETTER, DIGIT, OTHER = range(4)


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _classes() -> np.ndarray:
    out = np.full(PLAIN, OTHER, np.uint8)
    for c in map(chr, range(PLAIN)):
        if c.isalpha():
            out[ord(c)] = LETTER
        elif c.isnumeric():
            out[ord(c)] = DIGIT
        elif c.isspace() and not "\x1c" <= c <= "\x1f":
            out[ord(c)] = SPACE
    return out


CLASS = _classes()
LOWER = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 else c for c in range(PLAIN)], np.uint16)


class Merges:
    """Byte-pair merging of many words at once: in each round every word merges its earliest pair."""

    NONE = np.int32(2**31 - 1)

    def __init__(self, model: dict):
        vocab = model["vocab"]
        shown = _byte_names()
        end = model["end_of_word_suffix"]
        self.inner = np.array([vocab[c] for c in shown], np.int32)
        self.last = np.array([vocab[c + end] for c in shown], np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = np.array([vocab[a] << 16 | vocab[b] for a, b in pairs], np.int64)
        # an open hash table: key and rank, free slots hold key -1
        self.mask = (1 << 18) - 1
        self.keys, self.ranks = np.full(self.mask + 1, -1, np.int64), np.full(self.mask + 1, self.NONE, np.int32)
        todo = np.arange(len(keys))
        at = self._slot(keys)
        while len(todo):
            free = self.keys[at[todo]] < 0
            slots, first = np.unique(at[todo[free]], return_index=True)
            put = todo[free][first]
            self.keys[slots], self.ranks[slots] = keys[put], put
            todo = np.setdiff1d(todo, put)
            taken = todo[self.keys[at[todo]] != keys[todo]]
            at[taken] = (at[taken] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * 0x9E3779B1 >> 14) & self.mask

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 16 | b
        at = self._slot(key)
        found = self.keys[at]
        out = np.where(found == key, self.ranks[at], self.NONE)
        open_ = np.flatnonzero((found != key) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            found = self.keys[at[open_]]
            hit = found == key[open_]
            out[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def encode(self, flat: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words (their bytes one after the other, and their lengths): ids, and how many each."""
        sym = self.inner[flat]
        ends = np.cumsum(lens)
        sym[ends - 1] = self.last[flat[ends - 1]]
        word = np.repeat(np.arange(len(lens)), lens)
        ready: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            rank = np.full(len(sym), self.NONE, np.int32)
            inside = np.flatnonzero(word[1:] == word[:-1])
            rank[inside] = self.rank(sym[inside], sym[inside + 1])
            least = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.append(starts, len(sym)))
            done = least == self.NONE
            if done.any():
                flags = np.repeat(done, counts)
                ready.append((word[flags], sym[flags]))
                sym, word, rank, counts, least = sym[~flags], word[~flags], rank[~flags], counts[~done], least[~done]
            at = np.flatnonzero(rank == np.repeat(least, counts))
            # of overlapping pairs (a run of one symbol) every other one, from the left
            fresh = np.concatenate(([True], np.diff(at) != 1))[: len(at)]
            at = at[(at - np.maximum.accumulate(np.where(fresh, at, 0))) % 2 == 0]
            sym[at] = self.made[rank[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, word = sym[keep], word[keep]
        words, ids = (np.concatenate(x) for x in zip(*ready, strict=True)) if ready else (np.empty(0, np.int64), np.empty(0, np.int32))
        return ids[np.argsort(words, kind="stable")], np.bincount(words, minlength=len(lens))


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The positions starts[i] .. starts[i] + lens[i] - 1 of all i, one after the other."""
    return np.arange(lens.sum(), dtype=np.int32) + np.repeat((starts - np.cumsum(lens) + lens).astype(np.int32), lens)


def _byte_names() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [b if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b else None for b in range(256)]
    spare = iter(range(256, 512))
    return [chr(next(spare) if b is None else b) for b in shown]


class SharedHash(Exception):
    """Two parts of one hash: their texts go through the library."""


class WordTokens:
    """Texts to the vocabulary's ids."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            self.merges = Merges(json.load(f)["model"])
        self.weights = np.random.default_rng(0).integers(1, 2**63, (2, LONGEST), np.uint64) * np.uint64(2) + np.uint64(1)
        self._forget()

    def _forget(self) -> None:
        self.known = np.empty(0, np.uint64)  # sorted hashes of parts
        self.check = np.empty(0, np.uint64)  # their second hashes
        self.at, self.size = np.empty(0, np.int64), np.empty(0, np.int64)  # where their ids are
        self.pool, self.used = np.empty(1 << 16, np.uint16), 0

    @cached_property
    def model(self):
        """The library's tokenizer, loaded when a text first needs it."""
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(self.path)
        model.encode_special_tokens = True
        return model

    def _library(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, one text after the other, and how many each text has."""
        ids: list[np.ndarray] = []
        counts = np.zeros(len(texts), np.int64)
        at = 0
        while at < len(texts):
            size, to = 0, at
            while to < len(texts) and (to == at or size + len(texts[to]) <= AT_ONCE):
                size += len(texts[to])
                to += 1
            got, n = self._some(texts[at:to])
            ids.append(got)
            counts[at:to] = n
            at = to
        return np.concatenate(ids) if ids else np.empty(0, "<u4"), counts

    def _some(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        odd: set[int] = set()
        chars = np.frombuffer("\n".join(texts).encode("utf-16-le", "surrogatepass"), "<u2")
        if len(chars) and chars.max() >= PLAIN:
            odd = {k for k, t in enumerate(texts) if not t.isascii() and max(t) >= chr(PLAIN)}
            chars = np.frombuffer("\n".join(["" if k in odd else t for k, t in enumerate(texts)]).encode("utf-16-le"), "<u2")
        low = LOWER[chars]
        kind = CLASS[chars]
        start, part = self._parts(low, kind)
        lens = np.diff(start, append=len(low))
        hashes = self._hash(low, start, lens)[part]
        start, lens = start[part], lens[part]
        lengths = np.fromiter((0 if k in odd else len(t) for k, t in enumerate(texts)), np.int64, len(texts)) + 1
        text_of = np.searchsorted(np.cumsum(lengths), start, "right")
        if len(lens) and lens.max() > LONGEST:
            long_ = set(text_of[lens > LONGEST].tolist())
            odd |= long_
            keep = ~np.isin(text_of, list(long_))
            start, lens, text_of, hashes = start[keep], lens[keep], text_of[keep], hashes[keep]
        try:
            ids, sizes = self._look_up(low, start, lens, hashes)
        except SharedHash:
            every = [self._library(t) for t in texts]
            return np.concatenate(every), np.array([len(x) for x in every], np.int64)
        counts = np.bincount(text_of, sizes, minlength=len(texts)).astype(np.int64)
        if odd:
            cuts = np.split(ids, np.cumsum(counts)[:-1])
            for k in odd:
                cuts[k] = self._library(texts[k])
                counts[k] = len(cuts[k])
            ids = np.concatenate(cuts)
        return ids.astype("<u4"), counts

    @staticmethod
    def _parts(low: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where runs start, and which of them are parts (and not white space)."""
        if not len(low):
            return np.empty(0, np.int64), np.empty(0, bool)
        fresh = np.empty(len(low), bool)
        fresh[0] = True
        np.not_equal(kind[1:], kind[:-1], out=fresh[1:])
        fresh |= kind == DIGIT
        # contractions: a single ' before s, t, m, d, re, ve, ll takes these letters along
        quote = np.flatnonzero((low[:-1] == ord("'")) & fresh[:-1] & (kind[1:] == LETTER))
        after = low[np.minimum(quote + 1, len(low) - 1)]
        then = np.where(kind[np.minimum(quote + 2, len(low) - 1)] == LETTER, low[np.minimum(quote + 2, len(low) - 1)], 0)
        then[quote + 2 >= len(low)] = 0
        one = np.isin(after, [ord(c) for c in "stmd"])
        two = np.isin(after, [ord("r"), ord("v")]) & (then == ord("e")) | (after == ord("l")) & (then == ord("l"))
        for q, n in ((quote[one], 2), (quote[two], 3)):
            fresh[q + 1] = False
            next_ = q + n
            next_ = next_[next_ < len(low)]
            fresh[next_[kind[next_] == LETTER]] = True
        start = np.flatnonzero(fresh)
        return start, kind[start] != SPACE

    def _hash(self, low: np.ndarray, start: np.ndarray, lens: np.ndarray, which: int = 0) -> np.ndarray:
        """A multilinear hash of each run: the sum of its characters' codes times random odd weights."""
        if not len(start):
            return np.empty(0, np.uint64)
        within = np.arange(len(low), dtype=np.int32) - np.repeat(start.astype(np.int32), lens)
        code = self.weights[which].take(within, mode="clip")
        code *= low + np.uint16(1)
        return np.add.reduceat(code, start)

    def _look_up(self, low: np.ndarray, start: np.ndarray, lens: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(start):
            return np.empty(0, np.uint16), np.empty(0, np.int64)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        own_start, own_lens = start, lens
        start, lens = start[first], lens[first]
        # equal hashes must agree in length and in a second hash too, also with what is remembered
        edges = np.cumsum(lens) - lens
        check = self._hash(low[ragged(start, lens)], edges, lens, 1)
        again = self._hash(low[ragged(own_start, own_lens)], np.cumsum(own_lens) - own_lens, own_lens, 1)
        if not (np.array_equal(lens[inverse], own_lens) and np.array_equal(check[inverse], again)):
            raise SharedHash
        where = np.searchsorted(self.known, distinct)
        old = np.zeros(len(distinct), bool)
        inside = where < len(self.known)
        old[inside] = (self.known[where[inside]] == distinct[inside]) & (self.check[where[inside]] == check[inside])
        if not old.all():
            if len(self.known) + (~old).sum() > REMEMBERED:
                self._forget()
                old[:] = False
            self._learn(low, distinct[~old], check[~old], start[~old], lens[~old])
            where = np.searchsorted(self.known, distinct)
        place, size = self.at[where][inverse], self.size[where][inverse]
        return self.pool[ragged(place, size)], size

    def _learn(self, low: np.ndarray, hashes: np.ndarray, checks: np.ndarray, start: np.ndarray, lens: np.ndarray) -> None:
        chars = low[ragged(start, lens)]
        width = np.where(chars < 0x80, 1, 2)
        flat = np.frombuffer(chars.astype("<u2").tobytes().decode("utf-16-le").encode(), np.uint8)
        ids, size = self.merges.encode(flat, np.add.reduceat(width, np.cumsum(lens) - lens))
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate((self.pool[: self.used], np.empty(2 * (self.used + len(ids)), np.uint16)))
        self.pool[self.used : self.used + len(ids)] = ids
        at = self.used + np.cumsum(size) - size
        self.used += len(ids)
        to = np.searchsorted(self.known, hashes)
        self.known, self.check = np.insert(self.known, to, hashes), np.insert(self.check, to, checks)
        self.at, self.size = np.insert(self.at, to, at), np.insert(self.size, to, size)


@cache
def word_tokens(path: str) -> WordTokens:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordTokens(path)
