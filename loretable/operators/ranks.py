"""Places in an order, and pages of it, for groups of any size.

A window gives a group's places in one task. Here rows are dealt by ranges of (group, order), as many as the rows
demand, numbered within their range, and the few rows of the ranges' sizes give where each range begins; so a
group that has all rows is the work of many tasks, and each holds about a stated number of rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loretable.functions.tables import scratch

#: Rows of a range on average, and ranges of the histogram that seeks a page.
TASK_ROWS, HISTOGRAM = 500_000, 256


def placed(rows: DataFrame, group: list[str], order: list[str | Column], name: str = "place", total: str | None = None, task_rows: int = TASK_ROWS) -> DataFrame:
    """rows with their place from 1 in the order within their group, and if asked for the group's number of rows.

    Rows that are equal in the whole order get places in any order, as with a window. Ranges are cut by Spark's own
    sample of the order's values; their number follows from the number of rows. Rows are written to the shared folder
    twice, in their ranges the second time. No two columns may be called _range or _row.
    """
    spark, at, ranged = rows.sparkSession, scratch(rows.sparkSession, "unplaced"), scratch(rows.sparkSession, "ranged")
    rows.write.parquet(at)
    held = spark.read.parquet(at)
    ranges = max(1, -(-held.count() // task_rows))
    keys = [*group, *order]
    dealt = held.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    dealt.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_row")).write.parquet(ranged)
    held = spark.read.parquet(ranged)
    sizes = held.groupBy(*group, "_range").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    of_group = Window.partitionBy(*group)
    earlier = of_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("_range").alias("_r"), (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"), F.sum("_n").over(of_group).alias("_total"))
    same = held["_range"] == begins["_r"]
    for g in group:
        same = same & held[g].eqNullSafe(begins[f"_{g}"])
    out = held.join(begins, same).withColumn(name, F.col("_row") + F.col("_shift"))
    out = out if total is None else out.withColumn(total, F.col("_total"))
    return out.select(*rows.columns, name, *([total] if total else []))


def page(rows: DataFrame, offset: int = 0, limit: int | None = None, by: str = "chunk_id", most: int | None = None) -> DataFrame:
    """A page of rows in the order of a text column (nulls first), without sorting all rows.

    A histogram of the keys over ranges cut from a bounded sample tells which range the page begins in; only that
    range's rows are looked at again, in finer ranges, until at most `most` rows (four pages, at least 1000) stand
    around the page, or its keys cannot be cut any more. Those alone are sorted. Each step counts keys and shuffles
    nothing but counts.
    """
    enough = most or max(1000, 4 * (limit or 0))
    low, high, before = None, None, 0
    size = rows.count()
    while size > enough:
        cuts = _cuts(_between(rows, by, low, high).select(by), by, size)
        counts = _histogram(_between(rows, by, low, high), by, cuts)
        ends = before + np.cumsum(counts)
        first = int(np.searchsorted(ends, offset, side="right"))
        last = len(counts) - 1 if limit is None else int(np.searchsorted(ends, offset + limit, side="left"))
        if first >= len(counts):
            return rows.limit(0)
        last = min(max(first, last), len(counts) - 1)
        smaller = int(counts[first : last + 1].sum())
        if smaller == size or not len(cuts):
            break
        before += int(counts[:first].sum())
        low, high = cuts[first - 1] if first else low, cuts[last] if last < len(cuts) else high
        size = smaller
    out = _between(rows, by, low, high).orderBy(by).offset(max(0, offset - before))
    return out if limit is None else out.limit(limit)


def page_after(rows: DataFrame, last: str | None, limit: int, by: str = "chunk_id") -> DataFrame:
    """The page behind a key (null: the first page), for keys that stand there once: found by the key itself."""
    return (rows if last is None else rows.where(F.col(by) > last)).orderBy(by).limit(limit)


def _between(rows: DataFrame, by: str, low: str | None, high: str | None) -> DataFrame:
    """Rows with low <= key < high; nulls are below every key. The bounds reach the scan as filters."""
    rows = rows if low is None else rows.where(F.col(by) >= low)
    return rows if high is None else rows.where(F.col(by).isNull() | (F.col(by) < high))


def _cuts(keys: DataFrame, by: str, size: int, sample: int = 20_000) -> list[str]:
    """Ascending distinct keys that cut rows into about HISTOGRAM ranges, from a sample of a bounded size by a hash of the key."""
    share = int(min(1.0, sample / size) * (1 << 30))
    values = np.sort(np.array(keys.where(F.col(by).isNotNull() & (F.pmod(F.xxhash64(by, F.lit(size)), F.lit(1 << 30)) < share)).limit(2 * sample).toPandas()[by].tolist(), object))
    if not len(values):
        least, largest = keys.agg(F.min(by), F.max(by)).first()
        return [largest] if least != largest else []
    return sorted({values[len(values) * k // HISTOGRAM] for k in range(HISTOGRAM)} | {values[-1]})


def _histogram(rows: DataFrame, by: str, cuts: list[str]) -> np.ndarray:
    """How many rows stand below the first cut, between each two, and from the last on."""
    array = np.array(cuts, object)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        values, none = keys.to_numpy(object), keys.isna().to_numpy()
        out = np.zeros(len(values), np.int32)
        out[~none] = np.searchsorted(array, values[~none], side="right")
        return pd.Series(out)

    found = rows.groupBy(range_of(by).alias("r")).count().collect()
    counts = np.zeros(len(cuts) + 1, np.int64)
    for r in found:
        counts[r["r"]] = r["count"]
    return counts
