"""Fill-in-middle transformation: every byte of a batch of texts gets its place by a shift, and goes back by its inverse.

A batch's texts are one run of bytes. Cuts are found by a scan of token starts; a difference array over
the bytes holds where the shift to the output changes, its cumulative sum is each byte's shift, and one
numpy scatter writes all outputs of the batch. The way back finds the marks in the outputs alone and
gathers by the inverse shifts. All of it runs in windows of WINDOW bytes, so a very long text needs
little more than itself and its output.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loretable.llm.common import documents_of

# Marks before prefix, suffix and middle, and the shares (of 100) of changed texts and of those with the suffix in front.
MARKS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
CHANGED, SUFFIX_FIRST = 90, 20
MARK = 3
#: Bytes that are handled at once, and bytes of texts in one batch of outputs (a longer text is one batch).
WINDOW, BATCH = 1 << 20, 1 << 25
PLAIN, PSM, SPM = 0, 1, 2
FORMS = ("plain", "psm", "spm")


def draws(key: Column) -> list[Column]:
    """The first four groups of eight digits of the key's sha256 as numbers."""
    digest = F.sha2(key, 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def token_starts(window: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Whether a byte starts a token `[A-Za-z]+|[^A-Za-z]`; before: the byte in front of each, 0 where a text starts."""
    letter = ((window | 32) - 97) < 26
    after_letter = ((before | 32) - 97) < 26
    return (((window & 0xC0) != 0x80) & ~(letter & after_letter)).astype(bool)


def windows(size: int) -> Iterator[tuple[int, int]]:
    return ((lo, min(lo + WINDOW, size)) for lo in range(0, size, WINDOW))


class Scan:
    """Counts of token starts and code points up to any text's bounds, and up to any token."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds
        self.tokens, self.chars = self._at_bounds()

    def _flags(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        window = self.data[lo:hi]
        before = np.empty_like(window)
        before[1:] = window[:-1]
        before[0] = self.data[lo - 1] if lo else 0
        first = self.bounds[np.searchsorted(self.bounds, lo) : np.searchsorted(self.bounds, hi)] - lo
        before[first] = 0
        return token_starts(window, before), (window & 0xC0) != 0x80

    def _at_bounds(self) -> tuple[np.ndarray, np.ndarray]:
        tokens, chars = np.zeros(len(self.bounds), np.int64), np.zeros(len(self.bounds), np.int64)
        t = c = 0
        for lo, hi in windows(len(self.data)):
            starts, leads = self._flags(lo, hi)
            a, b = np.searchsorted(self.bounds, lo), np.searchsorted(self.bounds, hi)
            at = self.bounds[a:b] - lo
            for out, flags, base in ((tokens, starts, t), (chars, leads, c)):
                out[a:b] = base + np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[at]
            t, c = t + int(starts.sum()), c + int(leads.sum())
        end = np.searchsorted(self.bounds, len(self.data))
        tokens[end:], chars[end:] = t, c
        return tokens, chars

    def places(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte and code-point places of the tokens with these numbers (ascending; the number of all: the end)."""
        at, chars = np.full(len(ranks), len(self.data), np.int64), np.full(len(ranks), self.chars[-1], np.int64)
        t = c = 0
        for lo, hi in windows(len(self.data)):
            starts, leads = self._flags(lo, hi)
            found = np.flatnonzero(starts)
            a, b = np.searchsorted(ranks, t), np.searchsorted(ranks, t + len(found))
            if b > a:
                here = found[ranks[a:b] - t]
                at[a:b] = lo + here
                chars[a:b] = c + np.concatenate(([0], np.cumsum(leads, dtype=np.int64)))[here]
            t, c = t + len(found), c + int(leads.sum())
        return at, chars


def shifts(at: np.ndarray, shift: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(lo, hi, shift of each place) by windows, from the places where runs start (ascending) and their shifts.

    Where several runs start at one place all but the last are empty, so their changes add up to its shift.
    """
    change = np.diff(shift, prepend=0)
    total = np.concatenate(([0], np.cumsum(change)))
    for lo, hi in windows(size):
        a, b = np.searchsorted(at, lo), np.searchsorted(at, hi)
        difference = np.zeros(hi - lo, np.int64)
        np.add.at(difference, at[a:b] - lo, change[a:b])
        yield lo, hi, total[a] + np.cumsum(difference)


def scatter(data: np.ndarray, bounds: np.ndarray, form: np.ndarray, h1: np.ndarray, h2: np.ndarray):
    """Outputs (bytes, bounds), and n, prefix_chars, middle_chars of each text."""
    scan = Scan(data, bounds)
    n = np.diff(scan.tokens)
    cuts = np.sort(np.stack([h1 % (n + 1), h2 % (n + 1)], axis=1), axis=1)
    cuts[form == PLAIN] = n[form == PLAIN, None]
    at, chars = scan.places((scan.tokens[:-1, None] + cuts).ravel())
    at, chars = at.reshape(-1, 2), chars.reshape(-1, 2)
    prefix, middle, suffix = at[:, 0] - bounds[:-1], at[:, 1] - at[:, 0], bounds[1:] - at[:, 1]
    changed, turned = form != PLAIN, form == SPM
    ends = np.concatenate(([0], np.cumsum(np.diff(bounds) + 3 * MARK * changed)))
    start = ends[:-1]
    first = np.where(turned, start + MARK + suffix, start)  # the prefix's mark
    second = np.where(turned, start, start + MARK + prefix)  # the suffix's
    third = start + 2 * MARK + prefix + suffix  # the middle's
    to = np.stack([first, third, second], axis=1) + MARK * changed[:, None]
    to[~changed] = start[~changed, None]
    runs = np.stack([bounds[:-1], at[:, 0], at[:, 1]], axis=1)
    out = np.empty(int(ends[-1]), np.uint8)
    for lo, hi, shift in shifts(runs.ravel(), (to - runs).ravel(), len(data)):
        out[np.arange(lo, hi) + shift] = data[lo:hi]
    for mark, place in zip(MARKS.values(), (first, second, third), strict=True):
        for i, byte in enumerate(mark.encode()):
            out[place[changed] + i] = byte
    return out, ends, n, chars[:, 0] - scan.chars[:-1], chars[:, 1] - chars[:, 0]


def marks_in(data: np.ndarray) -> np.ndarray:
    """Places of all marks, by windows."""
    found = []
    middle = np.zeros(256, bool)
    middle[[ord(m[1]) for m in MARKS.values()]] = True
    for lo, hi in windows(len(data)):
        w = data[lo : min(hi + MARK - 1, len(data))]
        if len(w) >= MARK:
            found.append(lo + np.flatnonzero((w[:-2] == ord("<")) & middle[w[1:-1]] & (w[2:] == ord(">"))))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def gather(data: np.ndarray, bounds: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts (bytes, bounds) back from outputs and forms alone."""
    changed = form != PLAIN
    at = marks_in(data)
    text = np.searchsorted(bounds, at, side="right") - 1
    at = at[changed[text] & (at + MARK <= bounds[text + 1])]
    if len(at) != 3 * changed.sum():
        raise ValueError("an output does not hold each mark once")
    marks = at.reshape(-1, 3)
    length = np.diff(bounds) - 3 * MARK * changed
    ends = np.concatenate(([0], np.cumsum(length)))
    source = np.repeat(bounds[:-1, None], 3, axis=1)  # where prefix, middle and suffix stand
    to = np.stack([ends[:-1], ends[1:], ends[1:]], axis=1)
    turned = (form == SPM)[changed]
    parts = np.stack([marks[:, 1] - marks[:, 0], marks[:, 2] - marks[:, 1]], axis=1) - MARK  # lengths of the two in front
    prefix, suffix = np.where(turned, parts[:, 1], parts[:, 0]), np.where(turned, parts[:, 0], parts[:, 1])
    source[changed] = np.stack([np.where(turned, marks[:, 1], marks[:, 0]), marks[:, 2], np.where(turned, marks[:, 0], marks[:, 1])], axis=1) + MARK
    to[changed] = np.stack([ends[:-1][changed], ends[:-1][changed] + prefix, ends[1:][changed] - suffix], axis=1)
    out = np.empty(int(ends[-1]), np.uint8)
    # runs past a plain text's end are empty; the next text's first run starts there and comes last
    for lo, hi, shift in shifts(to.ravel(), (source - to).ravel(), len(out)):
        out[lo:hi] = data[np.arange(lo, hi) + shift]
    return out, ends


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts without nulls, and the texts' bounds."""
    _, offsets, data = texts.buffers()
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    bounds = np.frombuffer(offsets, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, bounds - bounds[0]


def _texts(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data))


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most BATCH bytes of texts each, or one text."""
    if not batch.num_rows:
        return
    _, bounds = _bytes(batch.column(column))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + BATCH, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def fill_in_middle(docs: DataFrame, seed: int = 1) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): every whole text cut in three and put together anew.

    n: tokens `[A-Za-z]+|[^A-Za-z]`. Cuts and form follow from the digest of `seed:doc_id`. Texts that are empty
    (null counts as empty) or hold a mark stay plain, as does a share of the others; their prefix_chars and
    middle_chars are null. A null doc_id counts as the empty text in the digest. Repeated rows give repeated
    rows, other columns are not read, an empty table gives an empty result. Nothing is shuffled.
    """
    h1, h2, h3, h4 = draws(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    marked = (F.col("text") == "") | F.greatest(*[F.contains("text", F.lit(m)) for m in MARKS.values()])
    form = F.when(marked | (h3 % 100 >= CHANGED), PLAIN).when(h4 % 100 < SUFFIX_FIRST, SPM).otherwise(PSM)
    rows = documents_of(docs).select("doc_id", "text", form.alias("form"), h1.alias("h1"), h2.alias("h2"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 1):
                data, bounds = _bytes(part.column(1))
                kind, a, b = (part.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
                out, ends, n, prefix, middle = scatter(data, bounds, kind, a, b)
                plain = kind == PLAIN
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n), pa.array(np.array(FORMS)[kind]), pa.array(prefix, mask=plain), pa.array(middle, mask=plain), _texts(out, ends)],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return rows.mapInArrow(work, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(outputs: DataFrame) -> DataFrame:
    """outputs with a column restored: the exact text, from output and form alone. Null outputs count as empty and plain."""
    known = F.col("output").isNotNull() & F.col("form").isin("psm", "spm")
    rows = outputs.withColumns({"_output": F.coalesce("output", F.lit("")), "_form": F.when(known & (F.col("form") == "spm"), SPM).when(known, PSM).otherwise(PLAIN)})
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in outputs.schema] + ["restored string"])
    columns = len(outputs.columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, columns):
                data, bounds = _bytes(part.column(columns))
                texts = _texts(*gather(data, bounds, part.column(columns + 1).to_numpy(zero_copy_only=False)))
                yield pa.RecordBatch.from_arrays([*part.columns[:columns], texts], [*part.schema.names[:columns], "restored"])

    return rows.mapInArrow(work, schema)


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents
), d AS (
  SELECT doc_id, text, units, len(units) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM t
), c AS (
  SELECT doc_id, text, units, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d
), s AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:], '') AS s FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM s
"""
