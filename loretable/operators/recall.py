"""Recall: known names and places looked up in chunk texts, and gates on what is found."""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loretable.functions.tables import kept

#: Terms that a task holds at once; more are looked for in rounds, with the same result.
DICTIONARY_TERMS = 200_000


_automata: dict = {}


def _automaton(name: str, terms: list[str]):
    """The automaton of a dictionary; a worker keeps that of the last one."""
    if name not in _automata:
        import ahocorasick

        _automata.clear()
        made = _automata[name] = ahocorasick.Automaton()
        for t in terms:
            made.add_word(t, t)
        made.make_automaton()
    return _automata[name]


def mentions_in_text(chunks: DataFrame, terms: DataFrame, most_terms: int = DICTIONARY_TERMS) -> DataFrame:
    """(chunk_id, term, pos, n): where each term first stands in a chunk, and how often (apart from itself).

    terms(term): blank ones are left out. Each term is found on its own, also inside others, by one
    automaton over all of a task's terms. Up to most_terms terms go to all tasks; more terms than that
    are dealt into rounds of as many, which changes no result. Null texts hold nothing.
    """
    known = terms.where("term is not null and trim(term) <> ''").select("term").distinct().persist()
    rounds = max(1, -(-known.count() // most_terms))
    out = None
    for k in range(rounds):
        part = known if rounds == 1 else known.where(F.pmod(F.xxhash64("term"), F.lit(rounds)) == k)
        shared = chunks.sparkSession.sparkContext.broadcast(sorted(part.toPandas()["term"]))

        def work(batches: Iterator[pa.RecordBatch], shared=shared, name=uuid4().hex) -> Iterator[pa.RecordBatch]:
            look = _automaton(name, shared.value).iter if shared.value else lambda text: ()
            for b in batches:
                rows = []
                for chunk, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    found: dict[str, list[int]] = {}
                    for end, t in look(text.as_py() or ""):
                        at = end - len(t) + 1
                        seen = found.get(t)
                        if seen is None:
                            found[t] = [at, 1, end]
                        elif at > seen[2]:
                            seen[1], seen[2] = seen[1] + 1, end
                    rows += [(chunk, t, p, n) for t, (p, n, _) in found.items()]
                kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["chunk_id", "term", "pos", "n"])

        found = chunks.select("chunk_id", "text").mapInArrow(work, "chunk_id string, term string, pos long, n long")
        out = found if out is None else out.unionByName(found)
    known.unpersist()
    return out


def new_mentions(found: DataFrame, aliases: DataFrame, known: DataFrame) -> DataFrame:
    """(entity, chunk_id): mentions of entities (terms resolved one hop) in chunks where no fact has them."""
    one = aliases.groupBy("alias").agg(F.min("canonical").alias("canonical"))
    resolved = found.join(one, found["term"] == one["alias"], "left").select(F.coalesce("canonical", "term").alias("entity"), "chunk_id").distinct()
    return resolved.join(known.select("entity", "chunk_id").distinct(), ["entity", "chunk_id"], "left_anti")


def evidence_chunks(rows: DataFrame, most: int = 20) -> DataFrame:
    """(entity, chunk_count, evidence): the first chunks of each entity."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("entity").orderBy("chunk_id"))
    first = rows.withColumn("place", place).where(F.col("place") <= most).groupBy("entity").agg(F.array_sort(F.collect_list("chunk_id")).alias("evidence"))
    return rows.groupBy("entity").agg(F.count("*").alias("chunk_count")).join(first, "entity")


def recall_rounds(chunks: DataFrame, terms: DataFrame, aliases: DataFrame, known: DataFrame, rounds: int = 3, least: int = 1) -> DataFrame:
    """New mentions, repeated with the entities found as terms of the next round, until a round finds
    fewer than least or rounds are up."""
    out, names = None, terms.select("term")
    for _ in range(rounds):
        new = new_mentions(mentions_in_text(chunks, names), aliases, known)
        if out is not None:
            new = new.join(out, ["entity", "chunk_id"], "left_anti")
        new = kept(new)
        grown = new.count()
        out = new if out is None else out.unionByName(new)
        if grown < least:
            break
        names = new.select(F.col("entity").alias("term")).distinct()
    return out


def exit_gate(candidates: DataFrame, confirmed: DataFrame) -> DataFrame:
    """(problem, alias, detail) of alias candidates(alias, canonical, evidence): several canonical names,
    a name against the confirmed one, no evidence, and chains (a canonical name that is an alias itself)."""
    several = candidates.groupBy("alias").agg(F.count_distinct("canonical").alias("n")).where("n > 1").select(F.lit("several_canonicals").alias("problem"), "alias", F.col("n").cast("string").alias("detail"))
    c = confirmed.select("alias", F.col("canonical").alias("settled"))
    against = candidates.join(c, "alias").where("canonical <> settled").select(F.lit("against_confirmed").alias("problem"), "alias", F.col("canonical").alias("detail"))
    bare = candidates.where(F.coalesce(F.size("evidence"), F.lit(0)) <= 0).select(F.lit("no_evidence").alias("problem"), "alias", F.col("canonical").alias("detail"))
    inner = candidates.select(F.col("alias").alias("canonical")).distinct()
    chain = candidates.join(inner, "canonical", "left_semi").select(F.lit("chain").alias("problem"), "alias", F.col("canonical").alias("detail"))
    return several.unionByName(against).unionByName(bare).unionByName(chain).distinct()
