import random
from datetime import datetime, timedelta

import pytest
from builders import dim, fact, frame, holidays, tx
from pyspark.sql import functions as F

from auditlake.operators import joins

VERSIONS = [
    {"customer_key": "1", "valid_from": "2026-01-01 00:00:00", "valid_to": "2026-02-01 00:00:00", "is_current": "false"},
    {"customer_key": "2", "valid_from": "2026-02-01 00:00:00"},
]


@pytest.mark.parametrize(
    ("at", "expected"),
    [("2025-12-31 23:59:59", -1), ("2026-01-01 00:00:00", 1), ("2026-01-31 23:59:59", 1), ("2026-02-01 00:00:00", 2), ("2030-01-01 00:00:00", 2)],
)
def test_the_version_valid_at_event_time(spark, at, expected):
    out = joins.pit_join(tx(spark, {"event_ts": at}), dim(spark, *VERSIONS), "customer_id", "event_ts", "key")
    assert [r["key"] for r in out.collect()] == [expected]


def test_unmatched_and_null_ids_get_the_unknown_key(spark):
    rows = tx(spark, {"customer_id": "C404"}, {"customer_id": None})
    versions = dim(spark, *VERSIONS, {"customer_id": None, "customer_key": "9", "valid_from": "2026-01-01 00:00:00"})
    assert [r["key"] for r in joins.pit_join(rows, versions, "customer_id", "event_ts", "key").collect()] == [-1, -1]


def test_a_gap_between_versions_is_no_match(spark):
    gap = [{**VERSIONS[0], "valid_to": "2026-01-15 00:00:00"}, VERSIONS[1]]
    out = joins.pit_join(tx(spark, {"event_ts": "2026-01-20 00:00:00"}), dim(spark, *gap), "customer_id", "event_ts", "key")
    assert out.first()["key"] == -1


@pytest.mark.parametrize("seconds", [1, 600, 10**7])
def test_the_join_agrees_with_brute_force_on_hot_and_null_keys(spark, seconds):
    rng = random.Random(11)
    at = lambda: datetime(2026, 1, 1) + timedelta(minutes=rng.randrange(0, 4000))
    pick = lambda: rng.choice(["hot"] * 4 + ["warm"] * 3 + ["a", "b"])
    starts = sorted({(pick(), at()) for _ in range(80)})
    versions = []
    for n, (key, start) in enumerate(starts):
        later = [s for k, s in starts if k == key and s > start]
        versions.append((n, key, start, min(later) if later else datetime(9999, 12, 31)))
    facts = [(i, pick(), at()) for i in range(300)] + [(1000 + n, key, start) for n, key, start, _ in versions]
    facts += [(2000 + i, None, at()) for i in range(60)] + [(3000 + i, "hot", datetime(2026, 1, 2, 3, 4, 5)) for i in range(60)]
    facts += [(4000, "hot", None)]
    v = spark.createDataFrame(versions, "customer_key BIGINT, customer_id STRING, valid_from TIMESTAMP, valid_to TIMESTAMP")
    f = spark.createDataFrame(facts, "id INT, who STRING, ts TIMESTAMP")
    found = {r["id"]: r["key"] for r in joins.pit_join(f, v, "who", "ts", "key", seconds=seconds).collect()}
    expected = {
        i: next((n for n, k, s, e in versions if k == who and ts and s <= ts < e), -1) for i, who, ts in facts
    }
    assert found == expected and len(found) == len(facts)


def test_recomputed_attributes_take_the_latest_change_at_or_before_the_event(spark):
    facts = frame(
        spark, "event_id STRING, customer_id STRING, event_ts TIMESTAMP",
        [{"event_id": "before", "event_ts": "2026-01-01"}, {"event_id": "at", "event_ts": "2026-01-02"}, {"event_id": "after", "event_ts": "2026-03-01"}],
        {"customer_id": "a"},
    )
    events = frame(
        spark, "customer_id STRING, changed_at TIMESTAMP, segment STRING",
        [{"changed_at": "2026-01-02", "segment": "s"}, {"changed_at": "2026-02-01", "segment": "p"}], {"customer_id": "a"},
    )
    found = {r["event_id"]: r["expected_segment"] for r in joins.asof_recompute(facts, events, ["segment"]).collect()}
    assert found == {"at": "s", "after": "p"}


def test_a_date_with_two_holidays_never_doubles_a_row(spark):
    names = holidays(spark, {}, {"title": "Second"}, {"division": "scotland", "holiday_date": "2026-10-06"})
    rows = tx(spark, {"event_date": "2026-08-31"}, {"event_date": "2026-10-06"}, {"event_date": None})
    flags = joins.with_holiday_flag(rows, names).select("event_date", "is_bank_holiday").collect()
    assert sorted((str(r[0]), r[1]) for r in flags) == [("2026-08-31", True), ("2026-10-06", False), ("None", False)]


def test_orphans_are_counted_per_key_and_null_is_an_orphan(spark):
    facts = fact(spark, {"type_key": "4"}, {"type_key": "9"}, {"type_key": "9"}, {"type_key": None})
    types = spark.createDataFrame([(4,)], "type_key INT")
    found = {r["fk_value"]: r["fact_rows"] for r in joins.orphans(facts, types, "type_key", "type_key").collect()}
    assert found == {9: 2, None: 1}
    assert joins.orphan_count(facts, types, "type_key", "type_key", "n").first()["n"] == 3


def test_overlap_counts_what_a_join_would_give(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "k STRING")
    b = spark.createDataFrame([("x",), ("x",), ("x",), ("z",), (None,)], "k STRING")
    assert joins.overlap_count(a, b, "k").first()[0] == a.join(b, "k").count() == 6


def test_mismatches_ignore_nulls_and_missing_keys(spark):
    a = spark.createDataFrame([(1, "s"), (2, "s"), (3, None), (4, "s")], "id INT, x STRING")
    b = spark.createDataFrame([(1, "s"), (2, "t"), (3, "t"), (5, "s")], "id INT, y STRING")
    assert joins.mismatch_count(a, b, "id", {"x": "y"}, "n").first()["n"] == 1


def test_lookup_gives_null_for_an_unknown_value(spark):
    types = spark.createDataFrame([("TRANSFER", 4)], "type_name STRING, type_key INT")
    out = joins.lookup(tx(spark, {}, {"txn_type": "REFUND"}), types, "txn_type", "type_name", ["type_key"])
    assert sorted(str(r["type_key"]) for r in out.collect()) == ["4", "None"]


def test_manifest_compare_counts_days_that_differ(spark):
    measured = frame(spark, "feed_date DATE, n INT", [{"feed_date": "2026-01-01", "n": "1"}, {"feed_date": "2026-01-02", "n": "2"}])
    manifest = frame(spark, "feed_date DATE, m INT", [{"feed_date": "2026-01-01", "m": "1"}, {"feed_date": "2026-01-02", "m": "3"}, {"feed_date": "2026-01-03", "m": "9"}])
    assert joins.manifest_compare(measured, manifest, {"bad": ("n", "m")}).first()["bad"] == 1


def test_latest_snapshot_and_newest(spark):
    df = frame(spark, "at TIMESTAMP, v INT", [{"at": "2026-01-01", "v": "1"}, {"at": "2026-01-02", "v": "2"}, {"at": "2026-01-02", "v": "3"}])
    assert sorted(r["v"] for r in joins.latest_snapshot(df, "at").collect()) == [2, 3]
    assert joins.newest(df.orderBy(F.desc("v")), "at").count() == 1


@pytest.mark.parametrize("seconds", [3600, 86_400, 40 * 86_400])
def test_overlapping_versions_against_brute_force(spark, seconds):
    rng = random.Random(seconds)
    moment = lambda: rng.randrange(0, 400 * 24) * 3600
    versions = []
    for i in range(160):
        begin = moment()
        length = rng.choice([0, 1800, 3600, 86_400, 9 * 86_400, 300 * 86_400])
        versions.append((rng.choice(["a", "a", "b", None]), begin, None if i % 9 == 0 else begin + length, i))
    facts = [(i, rng.choice(["a", "b", "c", None]), None if i % 31 == 0 else moment() + rng.randrange(0, 3600, 600)) for i in range(400)]
    at = lambda c: F.timestamp_seconds(F.lit(1_700_000_000) + F.col(c)).alias(c)
    v = spark.createDataFrame(versions, "k STRING, valid_from BIGINT, valid_to BIGINT, n INT").select("k", at("valid_from"), at("valid_to"), "n")
    f = spark.createDataFrame(facts, "id INT, k STRING, ts BIGINT").select("id", "k", at("ts"))
    found = joins.pit_join_overlapping(f, v, "k", "ts", "hit", version_key="k", value="n", seconds=seconds)
    assert found.columns == ["id", "k", "ts", "hit"]
    want = {}
    for i, k, ts in facts:
        valid = [(b, n) for vk, b, e, n in versions if k is not None and vk == k and ts is not None and b <= ts and (e is None or ts < e)]
        want[i] = max(valid)[1] if valid else -1
    assert {r["id"]: r["hit"] for r in found.collect()} == want and len({*want.values()}) > 40


def test_overlapping_form_of_nothing(spark):
    v = spark.createDataFrame([], "customer_id STRING, valid_from TIMESTAMP, valid_to TIMESTAMP, customer_key BIGINT")
    f = spark.createDataFrame([(1, "a", None)], "id INT, k STRING, ts TIMESTAMP")
    assert [r["hit"] for r in joins.pit_join_overlapping(f, v, "k", "ts", "hit").collect()] == [-1]
    assert joins.pit_join_overlapping(f.limit(0), v, "k", "ts", "hit").count() == 0


def test_cells_that_versions_fill_are_not_broadcast(spark):
    # One short version row in the size check, one row for each cell of its years in the join.
    f = spark.sql("SELECT * FROM VALUES ('a', TIMESTAMP '2020-01-01'), ('a', TIMESTAMP '2026-01-01') AS f(k, ts)")
    v = spark.sql("SELECT * FROM VALUES ('a', 7, TIMESTAMP '2019-01-01', TIMESTAMP '9999-12-31') AS v(customer_id, customer_key, valid_from, valid_to)")
    found = joins.pit_join_overlapping(f, v, "k", "ts", "hit", seconds=600)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "Inner" in line] == []
    assert [r["hit"] for r in found.collect()] == [7, 7]
