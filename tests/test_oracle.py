"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import os

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from auditlake.plans.oracle import oracle_sql as own_sql
from auditlake.plans.queries import QUERIES as OWN

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
# The text operators' queries have their own tests.
QUERIES, SQL = OWN, own_sql()
PRODUCTION = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.codegen.wholeStage": "true",
    "spark.sql.codegen.factoryMode": "FALLBACK",
}


@pytest.fixture(scope="module")
def session(spark):
    before = {k: spark.conf.get(k) for k in PRODUCTION}
    for key, value in PRODUCTION.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(session, con, name):
    assert differences(QUERIES[name](session, SF_DIR), con, SQL[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql()) <= set(queries())


def test_entry_is_the_flagship(session):
    assert entry(session).columns == QUERIES["kpi_daily"](session, SF_DIR).columns
