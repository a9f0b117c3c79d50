"""Indexes of tables in which one entity has more values, and one pair more chunks, than arrays once held."""

import os

import pytest

import __spark_entry__ as entry
from oracle import TABLES, difference

N = 1200


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """N orders of one customer from one supplier: line 1 has a type of its own, line 3 an event that all orders have, each
    with its own priority."""
    out = str(tmp_path_factory.mktemp("wide"))
    lines = f"SELECT * FROM (SELECT id FROM range({N})) CROSS JOIN VALUES (1), (3) AS l(line)"
    made = {
        "nation": "SELECT 0 AS n_nationkey, 'PERU' AS n_name",
        "supplier": "SELECT 0 AS s_suppkey, 'S' AS s_name, 0 AS s_nationkey",
        "customer": "SELECT 0 AS c_custkey, 'C' AS c_name",
        "part": f"SELECT id AS p_partkey, 'a same b' AS p_name, concat('T', id) AS p_type, 'B' AS p_brand FROM range({N + 1})",
        "orders": f"SELECT id AS o_orderkey, 0 AS o_custkey, concat('P', (id * 7) % {N}) AS o_orderpriority, 'O' AS o_orderstatus FROM range({N})",
        "lineitem": f"SELECT id AS l_orderkey, IF(line = 1, id, {N}) AS l_partkey, 0 AS l_suppkey, line AS l_linenumber, 1.0 AS l_quantity, 1.0 AS l_extendedprice, 0.0 AS l_discount, 0.0 AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus, DATE'1995-01-01' AS l_shipdate FROM ({lines})",
    }
    for t in TABLES:
        if t in made:
            spark.sql(made[t]).coalesce(2).write.parquet(f"{out}/{t}.parquet")
        else:
            os.symlink(f"/root/testdata/sf0.001/{t}.parquet", f"{out}/{t}.parquet")
    return out


WHOLE = {"m2_character_index": "actions", "m4_event_index": "causes", "m5_relationship_index": "chunks"}


@pytest.mark.parametrize("name", WHOLE)
def test_lists_are_whole(spark, wide, name):
    lists = [r[WHOLE[name]].split("|") for r in entry.queries()[name](spark, wide).collect()]
    assert max(map(len, lists)) >= N and all(len(x) == len(set(x)) for x in lists)
    assert not difference(spark, wide, name, entry.queries()[name], entry.oracle_sql()[name])
