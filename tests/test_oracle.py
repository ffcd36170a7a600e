"""Every named query against its SQL twin, and the driver contract."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences
from tests.conftest import SF_DIR
from textlake.plans.oracle import ORACLE_SQL as ORACLE
from textlake.plans.queries import QUERIES

MODEL_QUERIES = sorted(set(QUERIES) - set(ORACLE))


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SF_DIR), connection, ORACLE[name]) is None


@pytest.mark.parametrize("name", MODEL_QUERIES)
def test_query_without_sql_gives_rows(spark, name):
    assert not QUERIES[name](spark, SF_DIR).isEmpty()


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {row["type"] for row in rows} == {0, 1, None}
    assert sum(row["percent"] for row in rows) == pytest.approx(100, abs=0.01)
