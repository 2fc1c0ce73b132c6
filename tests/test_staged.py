"""Worlds that stage what several tables read."""

import pytest

from auditlake.plans.queries import QUERIES
from auditlake.plans.world import World

EVENTS = """SELECT id AS event_id, TIMESTAMP_NTZ '2024-01-02 03:04:05' + make_dt_interval(0, 0, CAST(id AS INT)) AS ts,
  id % 7 AS user_id, element_at(array('click', 'error', 'purchase', 'signup', 'view'), CAST(id % 5 AS INT) + 1) AS event_type,
  CAST(id AS DOUBLE) AS value, concat('{"k": ', id % 9, '}') AS props FROM range(130)"""
LINES = """SELECT id AS l_orderkey, id % 11 AS l_partkey, id % 3 AS l_suppkey, CAST(id % 7 AS INT) AS l_linenumber,
  CAST(1 + id % 50 AS DOUBLE) AS l_quantity, CAST(10 * id AS DOUBLE) AS l_extendedprice, 0.0D AS l_discount, 0.0D AS l_tax,
  if(id % 2 = 0, 'R', 'N') AS l_returnflag, 'O' AS l_linestatus, TIMESTAMP_NTZ '1996-06-01 00:00:00' AS l_shipdate FROM range(60)"""
NATION = "SELECT CAST(id AS INT) AS n_nationkey, concat('N', id) AS n_name, CAST(id % 5 AS INT) AS n_regionkey FROM range(6)"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    for name, rows in (("events", EVENTS), ("lineitem", LINES), ("nation", NATION)):
        df = spark.sql(rows)
        df.unionAll(df.limit(5)).write.parquet(f"{root}/{name}.parquet")  # some rows come twice
    return str(root)


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_ids_and_times_of_a_staged_world_are_made_once(spark, folder):
    lazy, staged = World(spark, folder), World(spark, folder, staged=True)
    assert "sha2(" in plan_of(lazy.transactions) and "sha2(" not in plan_of(staged.transactions)
    same = [c for c in lazy.transactions.columns if c != "is_bank_holiday"]
    rows = [sorted(map(str, w.transactions.select(same).collect())) for w in (lazy, staged)]
    assert rows[0] == rows[1] and len(rows[0]) > 100
    assert staged.quarantine.count() == lazy.quarantine.count() > 0
    # Without the flag in the stored rows, with it where it is read.
    assert staged.transactions.where("is_bank_holiday").count() == 60


def test_metrics_of_the_star_read_stored_rows(spark, folder):
    assert "sha2(" not in plan_of(QUERIES["star_metrics_recipient"](spark, folder))
