"""Name aliases: candidates by containment, their classes, and layered maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loretable.functions.text import grams, strip, two_decimals
from loretable.operators.ranks import TASK_ROWS, placed

CLOSE, RATIO, LEAST_ALIAS, LEAST_CANONICAL, LEAST_COUNT, REVIEW_COUNT = 0.5, 0.4, 2, 3, 10, 5


def containment(names: DataFrame, q: int = 3) -> DataFrame:
    """(alias, canonical_candidate, alias_count, canonical_count): names of two or more characters that
    stand inside another one, which has a positive count.

    A name stands in another one only if all its grams of q characters do. So an alias is looked up by one gram
    of it, the one that the fewest names have, among the grams of the longer names, and whether the whole of it
    stands there is tested on what meets. A name is spread into as many grams as it has characters, and no name is
    compared with all others. Aliases shorter than q are looked up by themselves, among grams of their length.
    """
    base = names.select("name", F.col("count").cast("bigint").alias("count")).where("name is not null")
    n = F.length("name")
    held = base.where("length(name) > 2 and count > 0").select(F.col("name").alias("canonical_candidate"), F.col("count").alias("canonical_count"), F.explode(F.flatten(F.array(*[grams(F.col("name"), k) for k in range(2, q + 1)]))).alias("gram"))
    asked = base.where("length(name) >= 2").select(F.col("name").alias("alias"), F.col("count").alias("alias_count"), grams(F.col("name"), F.least(n, F.lit(q))).alias("grams"))
    often = held.groupBy("gram").agg(F.count("*").alias("n"))
    # a gram that no longer name has is the rarest of all: nothing is found
    by_gram = asked.select("alias", "alias_count", F.explode("grams").alias("gram")).join(often, "gram", "left")
    rarest = by_gram.groupBy("alias", "alias_count").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("r")).where("r.n > 0").select("alias", "alias_count", "r.gram")
    met = held.join(rarest, "gram").where(F.col("canonical_candidate").contains(F.col("alias")) & (F.length("alias") < F.length("canonical_candidate")))
    return met.select("alias", "canonical_candidate", "alias_count", "canonical_count")


# The texts of reasons, as they stand in the table of candidates, are part of the functions below.
def classified(pairs: DataFrame) -> DataFrame:
    """pairs with ratio, rule, confidence, auto_accept and reason."""
    ratio = F.col("alias_count") / F.col("canonical_count")
    shown = two_decimals(F.col("ratio"))
    fails = F.filter(
        F.array(
            F.when(F.length("alias") < LEAST_ALIAS, F.format_string("alias太短(%d字)", F.length("alias"))),
            F.when(F.length("canonical_candidate") < LEAST_CANONICAL, F.format_string("canonical太短(%d字)", F.length("canonical_candidate"))),
            F.when(F.col("canonical_count") < LEAST_COUNT, F.format_string("canonical低频(%d次)", "canonical_count")),
            F.when(F.col("ratio") >= RATIO, F.concat(F.lit("频率差不足(ratio="), shown, F.lit(")"))),
        ),
        lambda x: x.isNotNull(),
    )
    rows = pairs.withColumn("ratio", ratio).withColumn("fails", fails)
    rule = F.when(F.col("ratio") >= CLOSE, "freq_close_skip").when(F.size("fails") == 0, "substring_auto").when((F.size("fails") == 1) & (F.col("canonical_count") >= REVIEW_COUNT), "substring_review").otherwise("substring_weak")
    rows = rows.withColumn("rule", rule)
    by = lambda a, b, c, d: F.when(F.col("rule") == "freq_close_skip", a).when(F.col("rule") == "substring_auto", b).when(F.col("rule") == "substring_review", c).otherwise(d)
    why = F.array_join("fails", "; ")
    reason = by(
        F.concat(F.lit("频率接近（ratio="), shown, F.lit("），可能是独立角色")),
        F.concat(F.lit("子串简称，频率差显著(ratio="), shown, F.lit(")，canonical出现"), F.col("canonical_count").cast("string"), F.lit("次")),
        F.concat(F.lit("需人工确认："), why), F.concat(F.lit("弱候选，不建议合并："), why),
    )
    return rows.select("alias", "canonical_candidate", "alias_count", "canonical_count", "ratio", "rule", by(F.lit("low"), F.lit("high"), F.lit("medium"), F.lit("low")).alias("confidence"), (F.col("rule") == "substring_auto").alias("auto_accept"), reason.alias("reason"))


def ordered(candidates: DataFrame) -> DataFrame:
    """High confidence first, then by falling count of the canonical name."""
    return candidates.orderBy(F.when(F.col("confidence") == "high", 0).when(F.col("confidence") == "medium", 1).otherwise(2), F.desc("canonical_count"), F.desc(F.length("canonical_candidate")), "canonical_candidate", "alias")


def alias_map(candidates: DataFrame) -> DataFrame:
    """(alias, canonical): of accepted candidates the most frequent, then longest, then first name."""
    w = Window.partitionBy("alias").orderBy(F.desc("canonical_count"), F.desc(F.length("canonical_candidate")), "canonical_candidate")
    return candidates.where("auto_accept").withColumn("rank", F.row_number().over(w)).where("rank = 1").select("alias", F.col("canonical_candidate").alias("canonical"))


def mapping_rows(objects: DataFrame, column: str = "json") -> DataFrame:
    """(alias, canonical) of JSON objects; blank sides and keys of metadata (from _) are left out."""
    rows = objects.select(F.explode(F.from_json(column, "map<string,string>")).alias("alias", "canonical"))
    return rows.select(strip("alias").alias("alias"), strip("canonical").alias("canonical")).where("alias <> '' and canonical <> '' and not startswith(alias, '_')")


def unordered(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    return pairs.select(F.least(strip(a), strip(b)).alias("a"), F.greatest(strip(a), strip(b)).alias("b")).where("a <> '' and b <> ''").distinct()


def unblocked(pairs: DataFrame, blocked: DataFrame) -> DataFrame:
    """(alias, canonical) without pairs that are blocked, in either order."""
    out = pairs.withColumns({"a": F.least("alias", "canonical"), "b": F.greatest("alias", "canonical")})
    return out.join(blocked, ["a", "b"], "left_anti").drop("a", "b")


def layered(layers: dict[str, DataFrame], blocked: DataFrame) -> DataFrame:
    """(alias, canonical, alias_source): for each alias the first layer that names it and is not blocked."""
    rows = None
    for rank, (name, df) in enumerate(layers.items()):
        part = df.select("alias", "canonical", F.lit(name).alias("alias_source"), F.lit(rank).alias("rank"))
        rows = part if rows is None else rows.unionByName(part)
    best = unblocked(rows, blocked).groupBy("alias").agg(F.min(F.struct("rank", "canonical", "alias_source")).alias("x"))
    return best.select("alias", "x.canonical", "x.alias_source")


def fact_aliases(confirmed: DataFrame, auto: DataFrame, blocked: DataFrame) -> DataFrame:
    return layered({"confirmed": confirmed, "auto": auto}, blocked)


def query_aliases(nicknames: DataFrame, confirmed: DataFrame, auto: DataFrame, blocked: DataFrame) -> DataFrame:
    return layered({"nickname": nicknames, "confirmed": confirmed, "auto": auto}, blocked)


def review_rows(candidates: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """(section, place, line): lines of a review table in three sections; ratio only where it is shown."""
    section = F.when(F.col("auto_accept"), 1).when(F.col("confidence") == "medium", 2).otherwise(3)
    ratio = F.when(F.col("section") < 3, F.concat(two_decimals(F.col("ratio")), F.lit(" | "))).otherwise("")
    line = F.concat(F.lit("| "), "alias", F.lit(" | "), "canonical_candidate", F.lit(" | "), F.col("alias_count").cast("string"), F.lit(" | "), F.col("canonical_count").cast("string"), F.lit(" | "), ratio, "reason", F.lit(" |"))
    rows = candidates.withColumn("section", section).select("section", "canonical_count", F.length("canonical_candidate").alias("n"), "canonical_candidate", "alias", line.alias("line"))
    order = [F.desc("canonical_count"), F.desc("n"), "canonical_candidate", "alias"]
    return placed(rows, ["section"], order, task_rows=task_rows).select("section", F.col("place").cast("int").alias("place"), "line")


def review_totals(candidates: DataFrame) -> DataFrame:
    return candidates.agg(F.count("*").alias("total"), F.count_if("auto_accept").alias("accepted"), F.count_if(~F.col("auto_accept") & (F.col("confidence") == "medium")).alias("review"), F.count_if(~F.col("auto_accept") & (F.col("confidence") == "low")).alias("low"))
