"""Reading texts, chunk folders, JSON records and alias maps; writing tables, indexes and texts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loretable.functions.text import strip
from loretable.sources.lines import read_lines, read_pieces  # noqa: F401

ENCODINGS = ("utf-8-sig", "gb18030")
#: Bytes of small files that one task reads.
TASK_BYTES = 64 << 20


def decoded(data: bytes) -> tuple[str, str]:
    """Text and encoding by trial; undecodable bytes are replaced at last. Line ends become \\n."""
    for name in ENCODINGS:
        try:
            text = data.decode(name)
            break
        except UnicodeDecodeError:
            continue
    else:
        text = data.decode(name, "replace")
    return text.replace("\r\n", "\n").replace("\r", "\n"), name


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """raw(source_name, source_file, encoding, text): one row per file that is not empty."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(p.rsplit("/", 1)[-1], *decoded(bytes(c))) for p, c in zip(f["path"], f["content"], strict=True)]
            yield pd.DataFrame([(n.rsplit(".", 1)[0] if "." in n else n, n, e, t) for n, t, e in rows], columns=["source_name", "source_file", "encoding", "text"])

    return files.mapInPandas(work, "source_name string, source_file string, encoding string, text string")


def _stem() -> F.Column:
    return F.regexp_replace(F.col("_metadata.file_name"), r"(\.meta)?\.[^.]*$", "")


def load_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunk texts (*.txt, stripped) with their meta files' fields beside them where there are any."""
    texts = spark.read.option("pathGlobFilter", "*.txt").text(path, wholetext=True).select(_stem().alias("chunk_id"), strip("value").alias("text"))
    meta = spark.read.schema("chunk_id string, source_file string, chapter_hint string, char_start bigint, char_end bigint, section_type string").option("multiLine", True).option("pathGlobFilter", "*.meta.json").json(path)
    return texts.join(meta.where("chunk_id is not null"), "chunk_id", "left")


def load_records(spark: SparkSession, path: str, schema: str, files: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """Records of a folder's files with one JSON object each (without chunk_id: the file's name; of several with one id the
    last file by name), and the names of unreadable files.

    Spark deals few files to a task, since it counts 4 MB for opening one; small files are read by four tasks a core,
    more only where their bytes ask for it.
    """
    fields = T.StructType.fromDDL(schema).add("_bad", T.StringType())
    texts = spark.read.option("pathGlobFilter", files).text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), _stem().alias("stem"), "value")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    held = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    texts = texts.coalesce(max(4 * spark.sparkContext.defaultParallelism, -(-held // TASK_BYTES)))
    rows = texts.withColumn("r", F.from_json("value", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("r").isNull() | F.col("r._bad").isNotNull()
    good = rows.where(~bad).select("file", "stem", "r.*").drop("_bad").withColumn("chunk_id", F.coalesce(F.nullif("chunk_id", F.lit("")), "stem")).drop("stem")
    last = good.groupBy("chunk_id").agg(F.max_by(F.struct(*[c for c in good.columns if c != "file"]), "file").alias("r")).select("r.*")
    return last, rows.where(bad).select("file")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Records of JSON lines with their line_no, and malformed lines (file, line_no, line); blank lines are
    dropped, but count. A file is read by as many tasks as it has ranges (`read_lines`)."""
    lines = read_lines(spark, path).where("trim(line) <> ''")
    fields = T.StructType.fromDDL(schema).add("_bad", T.StringType())
    rows = lines.withColumn("r", F.from_json("line", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("r").isNull() | F.col("r._bad").isNotNull()
    return rows.where(~bad).select("line_no", "r.*").drop("_bad"), rows.where(bad).select("file", "line_no", "line")


def read_alias_map(spark: SparkSession, path: str) -> DataFrame:
    from loretable.operators.aliases import mapping_rows

    return mapping_rows(spark.read.text(path, wholetext=True), "value")


def read_block_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(a, b) unordered, from a list of pairs {a, b}, alone or under any key of an object."""
    from loretable.operators.aliases import unordered

    pair = "array<struct<a:string,b:string>>"
    texts = spark.read.text(path, wholetext=True)
    alone = texts.where("ltrim(value) like '[%'").select(F.inline(F.from_json("value", pair)))
    under = texts.where("ltrim(value) like '{%'").select(F.explode(F.from_json("value", "map<string,string>")).alias("k", "v")).where("ltrim(v) like '[%'").select(F.inline(F.from_json("v", pair)))
    return unordered(alone.unionByName(under))


def write_chunks(chunks: DataFrame, path: str, buckets: int | None = None) -> None:
    """A folder for each source, or for each of so many buckets of sources (column source_bucket): folders of
    millions of sources are better read by bucket. A bucket's rows are gathered first, large ones in several files."""
    if buckets is None:
        chunks.write.mode("overwrite").partitionBy("source_name").parquet(path)
        return
    rows = chunks.withColumn("source_bucket", F.pmod(F.xxhash64("source_name"), F.lit(buckets)).cast("int"))
    rows.hint("rebalance", "source_bucket").write.mode("overwrite").partitionBy("source_bucket").parquet(path)


def read_chunks(spark: SparkSession, path: str, sources: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """Chunks of all or some sources; with buckets only the folders of the asked sources' buckets are read."""
    rows = spark.read.parquet(path)
    if sources is None:
        return rows
    if buckets is not None:
        asked = spark.createDataFrame([(s,) for s in sources], "s string").select(F.pmod(F.xxhash64("s"), F.lit(buckets)).cast("int")).distinct().collect()
        rows = rows.where(F.col("source_bucket").isin(*[r[0] for r in asked]))
    return rows.where(F.col("source_name").isin(*sources))


def write_table(rows: DataFrame, path: str, form: str = "parquet") -> None:
    """As parquet, or as JSON lines for exchange."""
    rows.write.mode("overwrite").format(form).save(path)


def encoded(text: Column, encoding: str, after: bytes = b"") -> Column:
    """Text in another encoding, as raw bytes in a text column: write_texts and Spark's text writer store them as they are."""

    @F.pandas_udf("binary")
    def encode(t: pd.Series) -> pd.Series:
        return t.map(lambda x: None if x is None else x.encode(encoding, "replace") + after)

    return encode(text).cast("string")


def write_texts(rows: DataFrame, column: str, path: str, order: str | None = None) -> None:
    """One text column; ordered inside each file if asked for."""
    out = rows.repartitionByRange(order).sortWithinPartitions(order) if order else rows
    out.select(column).write.mode("overwrite").text(path)
