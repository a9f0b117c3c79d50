import os

import oracle
import pytest

import __spark_entry__ as entry
from loretable.plans import queries as core

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the tables")
@pytest.mark.parametrize("name", sorted(core.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert not oracle.difference(spark, SF, name, core.QUERIES[name], core.ORACLE_SQL[name])


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the tables")
@pytest.mark.parametrize("name", sorted(set(core.QUERIES) - set(core.ORACLE_SQL)))
def test_query_without_sql_runs(spark, name):
    assert core.QUERIES[name](spark, SF).count() > 0


def test_entry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(core.QUERIES) <= set(entry.queries())
