"""Tables between the steps of a job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir). Where the session
    names none, a temporary folder stands in on one machine; on a cluster that is an error."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = _own.setdefault(context.applicationId, tempfile.mkdtemp(prefix="spark-loretable-"))
    return f"{named.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Shuffle files of a finished write go at once, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(rows: DataFrame, name: str, *over: str) -> tuple[DataFrame, str]:
    """rows as a table in the shared folder and its path: cut from its lineage, and without the shuffle files that it took,
    so that the shuffles of a long job don't lie on disk together. over: paths of earlier steps that nothing reads any more."""
    spark, path = rows.sparkSession, scratch(rows.sparkSession, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        rows.write.parquet(path, compression="zstd")
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    for p in over:
        gone = spark._jvm.org.apache.hadoop.fs.Path(p)
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return spark.read.schema(rows.schema).parquet(path), path


def kept(rows: DataFrame) -> DataFrame:
    """rows cut from their lineage, in the session's checkpoint folder; where it has none (one machine), in memory and on disk."""
    context = rows.sparkSession.sparkContext
    named = context.getConf().get("spark.checkpoint.dir")
    if named and not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(named)
    return rows.checkpoint() if context._jsc.sc().getCheckpointDir().isDefined() else rows.persist()
