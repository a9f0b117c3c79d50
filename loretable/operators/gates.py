"""Which chunks are sent to a model: structural gate, resume by log, paging, log rows, run summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loretable.functions.text import is_blank, lines, strip
from loretable.operators.ranks import page, page_after  # noqa: F401
from loretable.schemas import DONE_STATUSES

LEAST_CHARS = 200
# Title forms of the gate (they differ from those of the chunker).
GATE_TITLES = (
    "第[零一二三四五六七八九十百千万\\d]+[章节回卷篇部幕]", "Chapter\\s*\\d+", "卷[零一二三四五六七八九十百千万\\d]+", "第[零一二三四五六七八九十百千万\\d]+话",
    "楔子|序章|序言|前言|引子|番外|尾声|终章|后记|后序", "上篇|下篇|上卷|下卷|中卷",
)


def structural_reason(text: Column, least: int = LEAST_CHARS, titles: str | None = None) -> Column:
    """Why a chunk is structural, or null: too short, or one or two lines that start with a title."""
    body = strip(text)
    rows = lines(body)
    titled = (F.size(rows) <= 2) & (F.size(rows) > 0) & rows[0].rlike(f"(?U)\\A(?:{titles or '|'.join(GATE_TITLES)})")
    return F.when(F.length(body) < least, F.format_string(f"too_short (%d chars < {least})", F.length(body))).when(
        titled, F.format_string("title_pattern (%d lines, first='%s')", F.size(rows), F.substring(rows[0], 1, 30))
    )


def gated(chunks: DataFrame, least: int = LEAST_CHARS, titles: str | None = None) -> DataFrame:
    """chunks with structural_reason (null: goes on)."""
    return chunks.withColumn("structural_reason", structural_reason(F.coalesce("text", F.lit("")), least, titles))


def done_ids(log: DataFrame) -> DataFrame:
    """Chunks with a finished row; a later failure does not undo it."""
    return log.where(F.col("status").isin(*DONE_STATUSES)).select("chunk_id").distinct()


def pending(chunks: DataFrame, log: DataFrame) -> DataFrame:
    """Chunks with text that are not done."""
    return chunks.where(~is_blank("text")).join(done_ids(log), "chunk_id", "left_anti")


def log_rows(results: DataFrame, ts: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """State, structural and bad log rows of results(chunk_id, status, reason, char_count, raw)."""
    at = (ts if ts is not None else F.current_timestamp()).alias("ts")
    structural = results.where("status = 'structural_chunk'").select("chunk_id", "reason", "char_count", at)
    bad = results.where("status = 'failed'").select("chunk_id", "reason", F.substring("raw", 1, 2000).alias("raw_response"), at)
    return results.select("chunk_id", "status", at), structural, bad


def run_summary(chunks: DataFrame, before: DataFrame, log: DataFrame) -> DataFrame:
    """One row: total, done_before, success, failed, structural, processed of a run's log."""
    counts = log.agg(*[F.count_if(F.col("status") == s).alias(n) for s, n in (("success", "success"), ("failed", "failed"), ("structural_chunk", "structural"))], F.count("*").alias("processed"))
    total = chunks.agg(F.count("*").alias("total"))
    return total.crossJoin(done_ids(before).agg(F.count("*").alias("done_before"))).crossJoin(counts)
