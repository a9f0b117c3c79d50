"""Splitting documents into chunks: by chapter titles, paragraphs and sentence ends, packed greedily."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loretable.functions.text import strip
from loretable.schemas import CHUNKS

MAX_CHARS = 4900
# Title forms, hints and sentence ends that chunk tables are made with.
TITLES = (
    "第[零一二三四五六七八九十百千万\\d]+[章节回卷篇部]", "Chapter\\s*\\d+", "卷[零一二三四五六七八九十百千万\\d]+", "楔子|序章|序言|前言|引子",
    "番外.{0,20}", "尾声|终章|后记|后序", "上篇|下篇|上卷|下卷|中卷", "第[零一二三四五六七八九十百千万\\d]+话",
)
WHOLE_HINT, FRONT_HINT = "正文", "前言"
SENTENCE_ENDS = "。！？!?…"
PARAGRAPH_GAP = "\\n{2,}"
PROBE, LOOK_BACK, HINT_CHARS = 50, 200, 40


def limited(raw: DataFrame, limit_chars: int | None = None, limit_lines: int | None = None) -> DataFrame:
    """The first lines (ends kept) or else the first characters of each text; at most one limit."""
    if limit_chars is not None and limit_lines is not None:
        raise ValueError("only one limit can hold")
    if limit_lines is not None:
        kept = F.slice(F.split("text", "(?<=\\n)"), 1, limit_lines) if limit_lines else F.array()
        return raw.withColumn("text", F.array_join(kept, ""))
    return raw if limit_chars is None else raw.withColumn("text", F.substring("text", 1, limit_chars))


def sections(raw: DataFrame, titles: str | None = None) -> DataFrame:
    """(…, section, hint, section_text): texts cut before each line that starts with a title."""
    pattern = titles or "|".join(TITLES)
    starts = f"(?mdU)(?=^(?:{pattern}))"
    cut = raw.select("*", F.posexplode(F.split("text", starts, -1)).alias("section", "section_text")).where("section_text <> '' or section > 0 or text = ''")
    headed = F.col("section_text").rlike(f"(?dU)\\A(?:{pattern})")
    first_line = F.substring(strip(F.split("section_text", "[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]")[0]), 1, HINT_CHARS)
    whole = ~F.col("text").rlike(f"(?mdU)^(?:{pattern})")
    return cut.withColumn("hint", F.when(whole, WHOLE_HINT).when(headed, first_line).otherwise(FRONT_HINT)).where("section_text <> ''")


def paragraphs(text: Column, gap: str = PARAGRAPH_GAP) -> Column:
    return F.filter(F.transform(F.split(text, gap), strip), lambda p: p != "")


def packed_sentences(text: str, most: int, ends: str = SENTENCE_ENDS) -> list[str]:
    """A text cut at the last sentence end within reach (most characters) of the cut before, or at full reach if none is."""
    stops = [m.end() for m in re.finditer(f"[{re.escape(ends)}]", text)] + [len(text)]
    cuts = [0]
    while cuts[-1] < len(text):
        reach = cuts[-1] + most
        stop = stops[bisect_right(stops, reach) - 1] if stops[0] <= reach else 0
        cuts.append(stop if stop > cuts[-1] else reach)
    return [text[a:z] for a, z in pairwise(cuts)]


def packed_paragraphs(parts: list[str], most: int, ends: str = SENTENCE_ENDS) -> list[str]:
    """Paragraphs of one section in the longest runs that hold most characters with their joints (a line end each);
    a longer paragraph is cut by sentences."""
    total = [0, *accumulate(len(p) + 1 for p in parts)]
    out: list[str] = []
    first = 0
    while first < len(parts):
        after = bisect_right(total, total[first] + most + 1) - 1
        out += ["\n".join(parts[first:after])] if after > first else packed_sentences(parts[first], most, ends)
        first = max(after, first + 1)
    return out


def located(text: str, parts: list[str]) -> list[tuple[int, int]]:
    """Approximate places of consecutive parts: where their beginnings are found, a bit before the last end at the earliest."""
    out, cursor = [], 0
    for p in parts:
        at = text.find(p[:PROBE], max(0, cursor - LOOK_BACK))
        start = cursor if at < 0 else at
        cursor = start + len(p)
        out.append((start, cursor))
    return out


def chunked(text: str, title: re.Pattern, starts: re.Pattern, gap: re.Pattern, most: int, ends: str) -> tuple[list[str], list[str]]:
    """Hints and texts of one document's chunks."""
    cuts = [m.start() for m in starts.finditer(text) if m.start()]
    cut = [text[a:z] for a, z in zip([0, *cuts], [*cuts, len(text)], strict=True) if a < z]
    titled = [bool(title.match(s)) for s in cut]
    hints, made = [], []
    for s, is_titled in zip(cut, titled, strict=True):
        hint = s.splitlines()[0].strip()[:HINT_CHARS] if is_titled else WHOLE_HINT if not any(titled) else FRONT_HINT
        parts = packed_paragraphs([p for x in gap.split(s) if (p := x.strip())], most, ends)
        made += parts
        hints += [hint] * len(parts)
    return hints, made


def chunk_documents(raw: DataFrame, most: int = MAX_CHARS, titles: str | None = None, gap: str = PARAGRAPH_GAP, ends: str = SENTENCE_ENDS) -> DataFrame:
    """The chunk table of raw(source_name, source_file, text).

    Packing and locating run through a document from its start, so each document is cut, packed and
    located by one function in Arrow batches: its text goes to the worker once, chunks come back.
    Null and blank texts give no chunk.
    """
    forms = f"(?:{titles or '|'.join(TITLES)})"
    columns = [c.split()[0] for c in CHUNKS.split(", ")]
    kinds = {"chunk_idx": pa.int32(), "char_start": pa.int64(), "char_end": pa.int64()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        title, starts, gaps = re.compile(forms), re.compile(f"(?m)^(?={forms})"), re.compile(gap)
        for b in batches:
            for lo in range(0, b.num_rows, 200):
                out: list[tuple] = []
                for name, file, text in zip(*[c.to_pylist() for c in b.slice(lo, 200).columns], strict=True):
                    hints, made = chunked(text, title, starts, gaps, most, ends)
                    out += [(f"{name}_{i:04d}", name, i, file, h, a, z, c) for i, (h, c, (a, z)) in enumerate(zip(hints, made, located(text, made), strict=True), 1)]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kinds.get(c, pa.string())) for k, c in enumerate(columns)], columns)

    return raw.where("text is not null").select("source_name", "source_file", "text").mapInArrow(work, CHUNKS)


def register_sql(spark: SparkSession, name: str = "chunk_text", titles: str | None = None, gap: str = PARAGRAPH_GAP, ends: str = SENTENCE_ENDS) -> None:
    """A table function for SQL: SELECT … FROM texts t, LATERAL chunk_text(t.text, 4900), with the columns chunk_idx,
    chapter_hint, char_start, char_end, text. It gives the chunks that chunk_documents gives; null texts give none."""
    forms = f"(?:{titles or '|'.join(TITLES)})"

    class ChunkText:
        def __init__(self) -> None:
            self.title, self.starts, self.gaps = re.compile(forms), re.compile(f"(?m)^(?={forms})"), re.compile(gap)

        def eval(self, text: str, most: int) -> Iterator[tuple]:
            hints, made = chunked(text or "", self.title, self.starts, self.gaps, most, ends)
            for i, (hint, chunk, (start, end)) in enumerate(zip(hints, made, located(text or "", made), strict=True), 1):
                yield i, hint, start, end, chunk

    spark.udtf.register(name, F.udtf(ChunkText, returnType="chunk_idx int, chapter_hint string, char_start bigint, char_end bigint, text string"))


def run_summary(raw: DataFrame, chunks: DataFrame, encoding: str = "encoding", limit_chars: int | None = None, limit_lines: int | None = None) -> DataFrame:
    """Per source: encoding, characters in all and within the limits, the limits, chunks, first and last chunk id."""
    per = chunks.groupBy("source_name").agg(F.count("*").alias("chunk_count"), F.min_by("chunk_id", "chunk_idx").alias("first_chunk"), F.max_by("chunk_id", "chunk_idx").alias("last_chunk"))
    texts = raw.withColumn("_total", F.length("text")).transform(limited, limit_chars, limit_lines).groupBy("source_name")
    sums = texts.agg(F.max(encoding).alias("encoding"), F.sum("_total").alias("total_chars"), F.sum(F.length("text")).alias("processed_chars"))
    limits = [F.lit(x).cast("int").alias(n) for n, x in (("limit_chars", limit_chars), ("limit_lines", limit_lines))]
    return sums.join(per, "source_name", "left").select("source_name", "encoding", "total_chars", "processed_chars", *limits, F.coalesce("chunk_count", F.lit(0)).alias("chunk_count"), "first_chunk", "last_chunk")
