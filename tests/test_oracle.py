"""Every query against its SQL."""

import pytest
from oracle_check import CHECKED, compare, connect

from __spark_entry__ import LLM_ORACLE, LLM_QUERIES, entry, oracle_sql, queries

BUILDS = {name: build for name, build in queries().items() if name not in LLM_QUERIES}
SQLS = {name: sql for name, sql in oracle_sql().items() if name not in LLM_ORACLE}


@pytest.fixture(scope="module")
def con():
    return connect(CHECKED)


def test_every_query_has_sql():
    assert set(BUILDS) == set(SQLS)


@pytest.mark.parametrize("name", sorted(BUILDS))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, CHECKED, name, BUILDS[name], SQLS[name]) == []


def test_entry_gives_rows(spark):
    assert entry(spark).count() > 0
