"""A filter of a fixed size for keys that are looked for in a large table."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a filter, as a power of two (1 MB). What is broadcast does not grow with the keys; more keys let more others through.
BITS = 23


def maybe_in(keys: DataFrame, column: str) -> Callable[[Column], Column]:
    """A test that is true for every value in keys[column], and for some others (about keys / 2**BITS of them).

    It spares a large table's rows a shuffle; an exact join decides on those that it lets through. No key may be null.
    """
    place = F.pmod(F.xxhash64(F.col(column)), F.lit(1 << BITS))
    words = keys.select(place.alias("b")).groupBy(F.shiftright("b", 6).cast("int").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(b & 63 as int)))").alias("m")).toPandas()
    bits = np.zeros(1 << (BITS - 6), np.int64)
    bits[words["w"].to_numpy(np.int64)] = words["m"].to_numpy(np.int64)
    shared = keys.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf(T.BooleanType())
    def test(hashed: pd.Series) -> pd.Series:
        at = hashed.to_numpy(np.int64)
        return pd.Series(shared.value[at >> 6] >> (at & 63) & 1 == 1)

    return lambda c: test(F.pmod(F.xxhash64(c), F.lit(1 << BITS)))
