"""Confirmed section types as versions of a chunk table: nothing is written in place, and the first state stays.

Chunks are written once, as version 1. A later version adds a small table of labels (chunk_id, section_type)
and a manifest that lists what it consists of. A version exists from the moment its manifest is moved to
its number, which one writer can do once, so readers see whole versions only and a writer that is lost
leaves the last one as it was. Every few versions the labels are merged, so a reader joins a bounded number
of label tables however many versions there are.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loretable.functions.files import Files

LABELS = "chunk_id string, section_type string"
ERRORS = "chunk_id string, section_type string, line_no bigint"
HISTORY = "version bigint, parent bigint, kind string, note string, changed bigint, errors bigint"


class LabelVersions:
    """Versions of a chunk table's section types under a folder that all executors share.

    merge: after so many label tables one holds all of them. tries: how often a commit is moved behind
    another writer's.
    """

    def __init__(self, spark: SparkSession, root: str, merge: int = 8, tries: int = 20):
        self.spark, self.root, self.merge, self.tries = spark, root.rstrip("/"), merge, tries
        self.files = Files(spark, self.root)

    def current(self) -> int:
        """Number of the last version; 0 before the first."""
        names = [n for n in self.files.names("manifests") if n.endswith(".json")]
        return int(names[-1].split(".")[0]) if names else 0

    def manifest(self, version: int | None = None) -> dict:
        number = self.current() if version is None else version
        if not 1 <= number <= self.current():
            raise ValueError(f"there is no version {number}")
        return json.loads(self.files.read(f"manifests/{number:010d}.json"))

    def _commit(self, made) -> int:
        """Publish made(parent's manifest or None) under the next free number."""
        for _ in range(self.tries):
            parent = self.current()
            entry = made(self.manifest(parent) if parent else None)
            draft = f"drafts/{uuid.uuid4().hex}.json"
            self.files.write(draft, json.dumps({"version": parent + 1, "parent": parent, **entry}, ensure_ascii=False))
            if self.files.publish(draft, f"manifests/{parent + 1:010d}.json"):
                return parent + 1
        raise RuntimeError(f"other writers were first {self.tries} times")

    def _write(self, rows: DataFrame, name: str) -> str:
        place = f"{name}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{place}")
        return place

    def start(self, chunks: DataFrame, note: str = "") -> int:
        """Version 1: the chunks as they are. Their section_type (null where there is none) is the first state."""
        if self.current():
            raise ValueError("these versions have a first state already")
        rows = chunks if "section_type" in chunks.columns else chunks.withColumn("section_type", F.lit(None).cast("string"))
        base = self._write(rows, "chunks")

        def first(parent: dict | None) -> dict:
            if parent:
                raise ValueError("these versions have a first state already")
            return {"kind": "start", "note": note, "base": base, "labels": [], "changed": 0, "errors": 0}

        return self._commit(first)

    def apply(self, labels: DataFrame, note: str = "") -> int:
        """A version with these labels (chunk_id, section_type, line_no): the last line of each chunk counts.

        Labels of unknown chunks change nothing; they are kept beside the version (errors). Only ids and
        labels are joined, the chunks' texts are not read. If another writer was first, the same label table
        goes on top of that writer's version.
        """
        base = self.manifest()["base"]
        last = labels.groupBy("chunk_id").agg(F.max_by("section_type", "line_no").alias("section_type"))
        known = self.spark.read.parquet(f"{self.root}/{base}").select("chunk_id").distinct()
        place = self._write(last.join(known, "chunk_id", "left_semi"), "labels")
        wrong = self._write(labels.select("chunk_id", "section_type", F.col("line_no").cast("long")).join(known, "chunk_id", "left_anti"), "errors")
        changed, errors = self._read(place, LABELS).count(), self._read(wrong, ERRORS).count()

        def entry(parent: dict) -> dict:
            chain = [*parent["labels"], place]
            return {"kind": "apply", "note": note, "base": parent["base"], "labels": self._merged(chain), "delta": place, "errors_in": wrong, "changed": changed, "errors": errors}

        return self._commit(entry)

    def restore(self, version: int, note: str = "") -> int:
        """A new version that is equal to an earlier one; no data is copied."""
        old = self.manifest(version)
        return self._commit(lambda _: {"kind": "restore", "note": note, "base": old["base"], "labels": old["labels"], "changed": 0, "errors": 0, "of": version})

    def _read(self, place: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{place}")

    def _merged(self, chain: list[str]) -> list[str]:
        return [self._write(self._labels(chain), "labels")] if len(chain) > self.merge else chain

    def _labels(self, chain: list[str]) -> DataFrame:
        """One row per labelled chunk: the last table's label."""
        tables = [self._read(p, LABELS).withColumn("_at", F.lit(i)) for i, p in enumerate(chain)]
        if len(tables) == 1:
            return tables[0].drop("_at")
        return reduce(DataFrame.unionByName, tables).groupBy("chunk_id").agg(F.max_by("section_type", "_at").alias("section_type"))

    def read(self, version: int | None = None) -> DataFrame:
        """Chunks with the section types of a version (the last by default)."""
        m = self.manifest(version)
        chunks = self.spark.read.parquet(f"{self.root}/{m['base']}")
        if not m["labels"]:
            return chunks
        new = self._labels(m["labels"]).withColumnRenamed("section_type", "_new")
        return chunks.join(new, "chunk_id", "left").withColumn("section_type", F.coalesce("_new", "section_type")).drop("_new").select(*chunks.columns)

    def errors(self, version: int | None = None) -> DataFrame:
        """Label rows of a version that had no chunk."""
        place = self.manifest(version).get("errors_in")
        return self._read(place, ERRORS) if place else self.spark.createDataFrame([], ERRORS)

    def history(self) -> DataFrame:
        """One row per version, from the manifests."""
        rows = [self.manifest(v) for v in range(1, self.current() + 1)]
        return self.spark.createDataFrame([tuple(m[c.split()[0]] for c in HISTORY.split(", ")) for m in rows], HISTORY)

    def changes(self, old: int, new: int) -> DataFrame:
        """(chunk_id, before, after) of chunks whose label differs between two versions, from label tables and ids alone."""
        type_of = lambda v, name: self.read(v).select("chunk_id", F.col("section_type").alias(name))
        both = type_of(old, "before").join(type_of(new, "after"), "chunk_id")
        return both.where(~F.col("before").eqNullSafe(F.col("after")))
