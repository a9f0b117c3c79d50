"""Byte-level BPE by tree reduction: halves are encoded apart and joined at their boundary.

Encoded texts form a monoid. A text is halved down to small leaves; a leaf is cut into the pattern's
matches, and each match is merged by rank here. Joining two encoded texts re-encodes a window around
their boundary and keeps all ids outside it, which two rules prove right:

* Between texts: the pattern never matches across a place where a run of letters or of digits ends, nor
  where a run of other visible characters ends (but for an apostrophe before a letter), and it decides
  on no match before such a place by what comes after the next character. So ids up to the last such place of the left text
  and from the first one of the right text on stand in the joined text too. The window between these
  places grows until it reaches them.
* Inside a match: a row of ids is the encoding of its bytes if each two neighbours are the encoding of
  theirs (the first merge across any seam would take place in that pair alone too). So halves of a
  match are joined by merging a window of the ids next to the seam, which grows until its first and last
  id go with the ids outside.

Decoding is the homomorphism back: bytes of ids are concatenated.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loretable.llm.common import documents_of

#: Characters of a leaf, and of the first window on each side of a boundary.
LEAF, WINDOW = 512, 32
#: Bytes that are merged directly; longer matches are built of them as a tree. Bytes of parts that are remembered.
SHORT, KEPT = 4, 12
#: Matches, parts of matches, and pairs of ids that a task remembers; bounds memory, not results.
REMEMBERED = 500_000
#: Places between two characters of which the first surely ends a match.
STABLE = r"(?:(?<=\p{L})[^\p{L}]|(?<=\p{N})[^\p{N}]|(?<=[^\s\p{L}\p{N}'\x1c-\x1f\x85])[\s\p{L}\p{N}]|(?<=')[\s\p{N}])"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}


class Remembered(dict):
    """Values of a function, computed once each; forgets all when full."""

    def __init__(self, function):
        super().__init__()
        self.function = function

    def __missing__(self, key):
        value = self.function(key)
        if len(self) >= REMEMBERED:
            self.clear()
        self[key] = value
        return value


def _newer_characters(pattern: str, ranks: dict[bytes, int]) -> str:
    """Characters (as ranges of a set) that are letters or digits here, but not yet so for the library that
    ids must agree with: its tables of Unicode are older. It is asked about those that are new."""
    import regex
    import tiktoken

    model = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    every = "".join(map(chr, (*range(0x80, 0xD800), *range(0xE000, 0x110000))))
    new = [c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn"]
    after = model.encode_ordinary("a's")[-1]  # 's is a match after a letter, but not after another mark
    odd = [ord(c) for c in new if model.encode_ordinary(f"{c}'s")[-1] != after]
    ranges: list[list[int]] = []
    for c in odd:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(f"{chr(a)}-{chr(z)}" for a, z in ranges)


class TreeCodec:
    """Encodes and decodes with a rank file and a splitting pattern, without special tokens."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex

        self.ranks = read_ranks(ranks_path)
        self.pieces = [b""] * (max(self.ranks.values()) + 1)
        for b, i in self.ranks.items():
            self.pieces[i] = b
        self.sizes = [len(p) for p in self.pieces]
        self.names = [str(i) for i in range(len(self.pieces))]
        odd = _newer_characters(pattern, self.ranks)
        self.plain = regex.compile(pattern).findall
        # with a set of characters taken out of letters and digits
        strict = lambda p: re.sub(r"\\p\{[LN]\}", lambda m: f"[{m[0]}--[{odd}]]", p) if odd else p
        self.strict = regex.compile(strict(pattern), regex.V1).findall
        self.is_odd = regex.compile(f"[{odd or chr(0xE000)}]").search
        self.first_stable = regex.compile(strict(STABLE), regex.V1).search
        self.last_stable = regex.compile("(?r)" + strict(STABLE), regex.V1).search
        self.known = Remembered(lambda match: self.match(match.encode()))
        self.parts = Remembered(self.tree)
        self.pairs = Remembered(lambda pair: self.merged(self.pieces[pair[0]] + self.pieces[pair[1]]))

    def encode(self, text: str, leaf: int = LEAF) -> list[int]:
        """Ids of the whole text: a balanced tree over leaves of at most leaf characters."""
        if len(text) <= leaf:
            return self.leaf(text)
        half = len(text) // 2
        left, right = text[:half], text[half:]
        return self.join(left, self.encode(left, leaf), right, self.encode(right, leaf))

    def matches(self, text: str) -> list[str]:
        return self.plain(text) if text.isascii() or not self.is_odd(text) else self.strict(text)

    def leaf(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.known.__getitem__, self.matches(text))))

    def join(self, left: str, left_ids: list[int], right: str, right_ids: list[int]) -> list[int]:
        """Ids of left + right from the ids of both."""
        p, q = self._before(left), self._after(right)
        tail, head = left[p:], right[:q]
        i, j = self._ids_from_end(left_ids, len(tail.encode())), self._ids_from_start(right_ids, len(head.encode()))
        if len(tail) + len(head) <= 4 * WINDOW or any(len(self.matches(x)) != 1 for x in (tail, head, tail + head)):
            between = self.leaf(tail + head)
        else:  # one long match, cut by the boundary
            between = self.glued(left_ids[i:], right_ids[:j])
        return left_ids[:i] + between + right_ids[j:]

    def _before(self, text: str) -> int:
        """The last place in the text where a match surely ends; 0 if there is none."""
        width = WINDOW
        while True:
            start = max(0, len(text) - width)
            found = self.last_stable(text, start)
            if found or not start:
                return found.start() if found else 0
            width *= 2

    def _after(self, text: str) -> int:
        """The first place in the text where a match surely ends; its length if there is none."""
        width = WINDOW
        while True:
            found = self.first_stable(text, 0, width)
            if found or width >= len(text):
                return found.start() if found else len(text)
            width *= 2

    def _ids_from_end(self, ids: list[int], size: int) -> int:
        """Where in ids the last size bytes begin; an id begins there."""
        at = len(ids)
        while size > 0:
            at -= 1
            size -= self.sizes[ids[at]]
        return at

    def _ids_from_start(self, ids: list[int], size: int) -> int:
        at = 0
        while size > 0:
            size -= self.sizes[ids[at]]
            at += 1
        return at

    def match(self, data: bytes) -> list[int]:
        """Ids of one match of the pattern: its own id if it has one, else a tree over short parts."""
        whole = self.ranks.get(data)
        return self.tree(data) if whole is None else [whole]

    def tree(self, data: bytes) -> list[int]:
        if len(data) <= SHORT:
            return self.merged(data)
        half = len(data) // 2
        of = self.parts.__getitem__ if half < KEPT else self.tree
        return self.glued(of(data[:half]), of(data[half:]))

    def fits(self, a: int, b: int) -> bool:
        """Whether two ids are the encoding of their bytes."""
        return self.pairs[a, b] == [a, b]

    def glued(self, left: list[int], right: list[int]) -> list[int]:
        """The merged bytes of left and right, both merged apart."""
        window, width = self.pairs[left[-1], right[0]], 1
        if window == [left[-1], right[0]]:
            return left + right
        while True:
            i, j = max(0, len(left) - width), min(len(right), width)
            if width > 1:
                window = self.merged(self.decode(left[i:] + right[:j]))
            if (not i or self.fits(left[i - 1], window[0])) and (j == len(right) or self.fits(window[-1], right[j])):
                return left[:i] + window + right[j:]
            width *= 2

    def merged(self, data: bytes) -> list[int]:
        """Merges neighbours of the lowest rank, the leftmost first, until none can be merged."""
        ranks = self.ranks
        if len(data) > 64:
            return self._merged_by_heap(data)
        parts = [data[k : k + 1] for k in range(len(data))]
        none = len(self.pieces)
        after = [ranks.get(data[k : k + 2], none) for k in range(len(data) - 1)]
        while after:
            least = min(after)
            if least == none:
                break
            k = after.index(least)
            parts[k] += parts.pop(k + 1)
            del after[k]
            if k < len(after):
                after[k] = ranks.get(parts[k] + parts[k + 1], none)
            if k:
                after[k - 1] = ranks.get(parts[k - 1] + parts[k], none)
        return [ranks[p] for p in parts]

    def _merged_by_heap(self, data: bytes) -> list[int]:
        """The same in n log n steps, for long windows."""
        n, ranks = len(data), self.ranks
        ends, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k, 2) for k in range(n - 1) if (r := ranks.get(data[k : k + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, k, size = heapq.heappop(heap)
            nxt = after[k]
            if not alive[k] or nxt >= n or ends[nxt] - k != size:
                continue
            alive[nxt] = False
            ends[k], after[k] = ends[nxt], after[nxt]
            if after[k] < n:
                before[after[k]] = k
            for a in (before[k], k):
                if a >= 0 and after[a] < n and (r := ranks.get(data[a : ends[after[a]]])) is not None:
                    heapq.heappush(heap, (r, a, ends[after[a]] - a))
        return [ranks[data[k : ends[k]]] for k in range(n) if alive[k]]

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the ids: concatenation is the join of decoded texts."""
        return b"".join(map(self.pieces.__getitem__, ids))


@cache
def codec(ranks_path: str, pattern: str) -> TreeCodec:
    return TreeCodec(ranks_path, pattern)


def vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def encode_texts(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None, leaf: int = LEAF) -> DataFrame:
    """doc_id and ids of every whole text. Null texts count as empty and have no ids."""
    default = vocabulary()
    path, pat = ranks_path or default[0], pattern or default[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = codec(path, pat)
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                ids = [np.array(tree.encode(t, leaf), np.int32) for t in part.column(1).to_pylist()]
                offsets = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(offsets, np.concatenate(ids))], ["doc_id", "ids"])

    return documents_of(docs).mapInArrow(work, "doc_id long, ids array<int>")


def decode_ids(coded: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and the bytes that its ids stand for (null ids: no bytes)."""
    default = vocabulary()
    path, pat = ranks_path or default[0], pattern or default[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = codec(path, pat)
        for b in batches:
            texts = [tree.decode(i or []) for i in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.binary())], ["doc_id", "bytes"])

    return coded.select("doc_id", "ids").mapInArrow(work, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None, leaf: int = LEAF) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256.

    Encodes each whole text by the tree (leaf: characters of a leaf) and decodes the ids again in the
    same task, so neither ids nor bytes are moved. Null texts count as empty; repeated rows give repeated rows; an empty table an empty result.
    A very long text is one task's work, leaf by leaf; its ids are held as it is joined.
    """
    default = vocabulary()
    path, pat = ranks_path or default[0], pattern or default[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = codec(path, pat)
        sha, name = hashlib.sha256, tree.names.__getitem__
        for b in batches:
            n, coded, decoded = [], [], []
            for text in b.column(1):
                ids = tree.encode(text.as_py(), leaf)
                n.append(len(ids))
                coded.append(sha(",".join(map(name, ids)).encode()).hexdigest())
                decoded.append(sha(tree.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(coded), pa.array(decoded)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return documents_of(docs).mapInArrow(work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
