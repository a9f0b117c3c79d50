"""Token counts kept as additive totals by source, language and tokenizer version.

A ledger is a folder of batches. A batch says for some documents and versions what their counts are
now (insert, revise) or that they are gone (delete). Applying it writes two tables in a folder of its
own: the documents' new states, and its signed effect on the totals. It counts once a complete file that
names it has been moved to the next number, which is done once only, so of two writers one commits and
the other works out its effect anew. A writer that is lost leaves no file under a number, and a number
whose file says nothing is passed over. A name that was committed is never applied again, so batches may
be sent twice or retried after a loss. Totals are the sum of all committed effects. Every few commits a
snapshot of states, totals and names is added, so that readers never go through the whole history.
"""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loretable.functions.files import Files
from loretable.llm.common import member_test

CHANGES = "op string, doc_id long, source string, lang string, version string, n_tokens long"
STATES = "doc_id long, version string, source string, lang string, n_tokens long, alive boolean"
EFFECTS = "source string, lang string, version string, documents long, tokens long"
GROUP = ["source", "lang", "version"]
#: Times that a batch is worked out anew because another writer committed meanwhile, the longest pause before (seconds), and commits to a snapshot.
ATTEMPTS, PAUSE, SNAPSHOT = 20, 2.0, 16


class TokenLedger:
    def __init__(self, spark: SparkSession, path: str, snapshot: int = SNAPSHOT):
        self.spark, self.path, self.snapshot = spark, path.rstrip("/"), snapshot
        self.files = Files(spark, self.path)

    def _base(self) -> tuple[int, str | None]:
        """Number up to which the last snapshot holds everything, and its folder."""
        for name in reversed(self.files.names("snapshots")):
            if name.isdigit() and (own := self.files.read(f"snapshots/{name}")):
                return int(name), own
        return -1, None

    def _commits(self, after: int) -> tuple[int, list[tuple[int, str, str]]]:
        """The next free number, and (number, name, folder) of the commits behind a number, in their order."""
        numbers = [n for n in self.files.names("commits") if n.isdigit()]
        out = []
        for n in numbers:
            if int(n) > after:
                own, _, name = self.files.read(f"commits/{n}").partition("\n")
                if own:
                    out.append((int(n), name, own))
        return max((int(n) for n in numbers), default=-1) + 1, out

    def _names(self, own: str | None) -> DataFrame:
        return self._read(f"held/{own}/names" if own else None, "number long, name string")

    def batches(self) -> list[str]:
        """Names of committed batches, in the order of their commits."""
        after, own = self._base()
        return [r.name for r in self._names(own).orderBy("number").collect()] + [name for _, name, _ in self._commits(after)[1]]

    def _publish(self, name: str, text: str) -> bool:
        draft = f"drafts/{uuid.uuid4().hex}"
        self.files.write(draft, text)
        return self.files.publish(draft, name)

    def _commit(self, number: int, name: str, own: str) -> bool:
        """Moves a complete file to that number; False if another writer has."""
        return self._publish(f"commits/{number:08d}", f"{own}\n{name}")

    def _read(self, folder: str | None, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}") if folder else self.spark.createDataFrame([], schema)

    def _behind(self, kind: str, schema: str, base: str | None, commits: list[tuple[int, str, str]]) -> DataFrame:
        """A snapshot's table and those of the commits behind it, each in one scan, with seq, the commit's number (snapshot: -1)."""
        rows = self._read(f"held/{base}/{kind}" if base else None, schema).withColumn("seq", F.lit(-1).cast("long"))
        if not commits:
            return rows
        numbers = F.create_map(*[F.lit(x) for n, _, own in commits for x in (own, n)])
        new = self.spark.read.schema(f"{schema}, own string").option("basePath", f"{self.path}/{kind}").parquet(*[f"{self.path}/{kind}/own={own}" for _, _, own in commits])
        return rows.unionByName(new.withColumn("seq", numbers[F.col("own")].cast("long")).drop("own"))

    def current(self) -> DataFrame:
        """The state of each document and version that is not deleted."""
        after, own = self._base()
        return _last(self._behind("states", STATES, own, self._commits(after)[1]))

    def totals(self) -> DataFrame:
        """source, lang, version, documents, tokens: sums of all effects; empty groups are left out."""
        after, own = self._base()
        return _sums(self._behind("effects", EFFECTS, own, self._commits(after)[1])).where("documents <> 0 or tokens <> 0")

    def _hold(self) -> None:
        """A snapshot of all commits so far, if enough were made since the last. If it is lost or late, nothing depends on it."""
        after, own = self._base()
        commits = self._commits(after)[1]
        if len(commits) < self.snapshot:
            return
        new, last = uuid.uuid4().hex, commits[-1][0]
        names = self._names(own).unionByName(self.spark.createDataFrame([(n, name) for n, name, _ in commits], "number long, name string"))
        states = _last(self._behind("states", STATES, own, commits)).withColumn("alive", F.lit(True))
        for kind, rows in (("states", states), ("effects", _sums(self._behind("effects", EFFECTS, own, commits))), ("names", names)):
            rows.write.parquet(f"{self.path}/held/{new}/{kind}")
        self._publish(f"snapshots/{last:08d}", new)

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commits a batch; False and no effect if its name was committed before.

        changes: op (insert, revise or delete), doc_id, source, lang, version, n_tokens. Inserts and
        revisions both set a document's count under a version, whether or not it had one; its old
        count leaves its old group. Deletes of what is not there have no effect. If a batch names a
        document and version several times, a set count wins over a delete, and the largest wins.
        Nulls are values like others (null counts: 0; documents without an id are one document, as nothing
        tells them apart); rows with another op are ignored; an empty batch is committed without effect.
        """
        own = uuid.uuid4().hex
        asked = changes.where(F.col("op").isin("insert", "revise", "delete")).select("doc_id", "version", F.struct((F.col("op") != "delete").alias("alive"), F.coalesce("n_tokens", F.lit(0)).alias("n"), "source", "lang").alias("new"))
        asked = asked.groupBy("doc_id", "version").agg(F.max("new").alias("new"))
        states = asked.select("doc_id", "version", "new.source", "new.lang", F.col("new.n").alias("n_tokens"), "new.alive")
        written = None
        for attempt in range(ATTEMPTS):
            if attempt:
                time.sleep(random.uniform(0, min(PAUSE, 0.05 * 2**attempt)))
            after, base = self._base()
            number, commits = self._commits(after)
            if any(name == batch for _, name, _ in commits) or (base and self._names(base).where(F.col("name") == batch).head(1)):
                return False
            if written is None:
                states.write.parquet(f"{self.path}/states/own={own}")
                written = self.spark.read.schema(STATES).parquet(f"{self.path}/states/own={own}")
            added = written.where("alive").select(*GROUP, F.lit(1).alias("documents"), F.col("n_tokens").alias("tokens"))
            if commits or base:
                # only the batch's own documents are looked for, before anything is aggregated
                before, keys = self._behind("states", STATES, base, commits), written.select("doc_id", "version")
                maybe = member_test(keys.select(F.xxhash64("doc_id", "version").alias("k")), "k")
                before = before.where(maybe(F.xxhash64("doc_id", "version")))
                same = keys["doc_id"].eqNullSafe(before["doc_id"]) & keys["version"].eqNullSafe(before["version"])
                gone = _last(before.join(keys, same, "left_semi")).select(*GROUP, F.lit(-1).alias("documents"), (-F.col("n_tokens")).alias("tokens"))
                added = added.unionByName(gone)
            _sums(added).write.mode("overwrite").parquet(f"{self.path}/effects/own={own}")
            if self._commit(number, batch, own):
                self._hold()
                return True
        raise RuntimeError(f"{batch} was overtaken by other writers {ATTEMPTS} times")


def _sums(effects: DataFrame) -> DataFrame:
    return effects.groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))


def _last(states: DataFrame) -> DataFrame:
    """The latest state of each document and version, if it is not deleted."""
    last = states.groupBy("doc_id", "version").agg(F.max_by(F.struct("source", "lang", "n_tokens", "alive"), "seq").alias("s"))
    return last.where("s.alive").select("doc_id", "version", "s.source", "s.lang", "s.n_tokens")


def vocabularies() -> dict[str, str]:
    import public_tokenizers

    return {"byte_bpe_50k": public_tokenizers.path("byte_bpe_50k.tiktoken"), "word_bpe_49k": public_tokenizers.path("word_bpe_49k.json")}


@cache
def byte_tokens(path: str, pattern: str):
    """The library's tokenizer of a rank file, without special tokens."""
    import tiktoken

    from loretable.llm.bpe_tree import read_ranks

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


def count_tokens(docs: DataFrame, versions: dict[str, str] | None = None, op: str = "insert") -> DataFrame:
    """Changes that set every document's count of tokens under each version; whole texts, null: 0.

    versions: version name -> vocabulary file, ending in .tiktoken (byte-level) or .json (by words).
    Repeated rows give repeated changes (of which the ledger takes the largest); an empty table gives none.
    """
    files = versions or vocabularies()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        from loretable.llm.word_tokens import word_tokens

        for b in batches:
            for lo in range(0, b.num_rows, 300):
                part = b.slice(lo, 300)
                texts = part.column(3).to_pylist()
                for version, path in files.items():
                    if path.endswith(".tiktoken"):
                        encode = byte_tokens(path, public_tokenizers.PATTERN).encode_ordinary
                        n = np.array([len(encode(t)) for t in texts], np.int64)
                    else:
                        n = word_tokens(path).encode(texts)[1]
                    fixed = [pa.array([x] * len(texts), pa.string()) for x in (op, version)]
                    yield pa.RecordBatch.from_arrays([fixed[0], *part.columns[:3], fixed[1], pa.array(n)], [c.split()[0] for c in CHANGES.split(", ")])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(work, CHANGES)


def estimated_counts(docs: DataFrame, version: str) -> DataFrame:
    """Changes that set a quick estimate: the number of words between blanks. Null texts count 0, other nulls are kept as they are."""
    words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    return docs.select(F.lit("insert").alias("op"), F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.lit(version).alias("version"), words.cast("long").alias("n_tokens"))


def deleted(docs: DataFrame, versions: list[str]) -> DataFrame:
    """Changes that take documents out of the totals of some versions; rows without an id take out the documents without one."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(F.array(*map(F.lit, versions))).alias("version"))
    none = F.lit(None).cast("string")
    return rows.select(F.lit("delete").alias("op"), "doc_id", none.alias("source"), none.alias("lang"), "version", F.lit(None).cast("long").alias("n_tokens"))
