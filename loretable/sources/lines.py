"""Lines of large files by byte ranges: exact line numbers, and texts decoded in bounded pieces.

Spark's text reader cuts a file at any byte, and each task reads the lines that start in its range. A task knows
how many lines (and bytes) its range has, not how many stand before it; those come from sums of the ranges' counts
in the order of the file. So one file of any size is read by many tasks, and no task holds more than a range.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loretable.functions.tables import scratch

#: Bytes of a decoded piece; a longer line is a piece of its own.
PIECE_BYTES = 1 << 20
# Encodings that are tried, in this order; what neither can read is decoded by the last with signs of replacement.
UTF8, GB = "utf-8-sig", "gb18030"
BOM = 3


def ranged_lines(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(path, file, size, start, at, line binary): lines ended by \\n (which is not part of them) as raw bytes.

    start is the first byte of the task's range; at orders the lines of a range. A line belongs to the range in which
    it starts. Bytes are not decoded, so any encoding in which \\n is no part of another character will do.
    """
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", recursive)
    meta = [F.col(f"_metadata.{c}").alias(n) for c, n in (("file_path", "path"), ("file_name", "file"), ("file_size", "size"), ("file_block_start", "start"))]
    return reader.text(path).select(*meta, F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("line"))


def numbered(rows: DataFrame, units: dict[str, F.Column] | None = None) -> DataFrame:
    """rows (path, start, at, …) with line_no from 1 in each file, and for each further unit the sum of it before the
    row's range (named before_<unit>).

    rows must be a table that is read twice alike (written, not a plan). One aggregation counts each range; the
    counts' running sum within a file is joined back. A file has one row per range in it, and those alone are sorted.
    """
    sums = {"lines": F.lit(1), **(units or {})}
    per = rows.groupBy("path", "start").agg(F.min("at").alias("_first"), *[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ranges = per.select("path", "start", "_first", *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"before_{n}") for n in sums])
    joined = rows.join(ranges, ["path", "start"])
    return joined.withColumn("line_no", F.col("before_lines") + F.col("at") - F.col("_first") + 1).drop("_first", "before_lines")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line): UTF-8 lines with their numbers; \\r before the end goes. Written to the shared folder once."""
    at = scratch(spark, "lines")
    ranged_lines(spark, path).write.parquet(at)
    rows = numbered(spark.read.parquet(at))
    return rows.select("file", "line_no", F.regexp_replace(F.col("line").cast("string"), "\r$", "").alias("line"))


def _pieces(most: int):
    """A function over batches of lines: runs of one range's lines joined to at most `most` bytes, each line with its end."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "file", "size", "start", "at", "bytes", "utf8"]
        held: list[bytes] = []
        head, size, out = None, 0, []

        def close() -> None:
            nonlocal held, size
            if held:
                data = b"\n".join(held) + b"\n"
                out.append((*head, data, _reads(data, "utf-8")))
            held, size = [], 0

        def batch() -> pa.RecordBatch:
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
            made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)
            out.clear()
            return made

        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
                *where, line = row
                if held and (where[:4] != list(head[:4]) or size + len(line) + 1 > most):
                    close()
                if not held:
                    head = tuple(where)
                held.append(line)
                size += len(line) + 1
                if len(out) >= 16:
                    yield batch()
        close()
        yield batch()

    return work


def _reads(data: bytes, encoding: str) -> bool:
    try:
        data.decode(encoding)
    except UnicodeDecodeError:
        return False
    return True


@F.pandas_udf(T.StringType())
def _decoded(data: pd.Series, encoding: pd.Series) -> pd.Series:
    return pd.Series([d.decode(e, "replace") for d, e in zip(data, encoding, strict=True)], dtype=object)


def read_pieces(spark: SparkSession, path: str, most: int = PIECE_BYTES) -> DataFrame:
    """(source_name, source_file, encoding, piece, text): the files' texts in pieces of whole lines; line ends are \\n.

    The pieces of a file, joined in order (piece counts from 0), are its text. Each piece is tested where
    it is read; a file is UTF-8 if all of its pieces are, else it has the other encoding. Only the flags are gathered
    per file, never its text. A byte-order mark at the start goes. Empty files give no piece. A piece ends at a line's end,
    so no character is cut, and none is longer than `most` bytes but for a single longer line.
    """
    at = scratch(spark, "pieces")
    ranged_lines(spark, path, True).mapInArrow(_pieces(most), "path string, file string, size long, start long, at long, bytes binary, utf8 boolean").write.parquet(at)
    rows = spark.read.parquet(at)
    files = rows.groupBy("path").agg(F.bool_and("utf8").alias("utf8"), F.sum(F.length("bytes")).alias("read"), F.max("size").alias("size"), F.max(F.struct("start", "at")).alias("last"))
    files = files.select("path", F.when(F.col("utf8"), UTF8).otherwise(GB).alias("encoding"), (F.col("read") - F.col("size")).isin(1, 1 - BOM).alias("open_end"), "last")
    order = Window.partitionBy("path").orderBy("start", "at")
    # numbers of pieces, from their places alone
    places = rows.select("path", "start", "at").withColumn("piece", F.row_number().over(order) - 1)
    found = rows.drop("utf8", "size").join(places, ["path", "start", "at"]).join(files, "path")
    # a file that does not end in \n: its last line was given an end here (the reader leaves a byte-order mark out)
    last = (F.col("last.start") == F.col("start")) & (F.col("last.at") == F.col("at"))
    data = F.when(last & F.col("open_end"), F.expr("substring(bytes, 1, length(bytes) - 1)")).otherwise(F.col("bytes"))
    encoding = F.when(F.col("encoding") == UTF8, "utf-8").otherwise(F.col("encoding"))
    text = F.regexp_replace(_decoded(data, encoding), "\r\n?", "\n")
    file = F.coalesce(F.try_url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))), F.col("file"))
    return found.select(F.regexp_replace(file, r"(?<=.)\.[^.]*$", "").alias("source_name"), file.alias("source_file"), F.col("encoding"), "piece", text.alias("text"))
