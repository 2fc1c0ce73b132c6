"""Wide rows stay out of the shuffles where few keys come twice, are crowded, or are known."""

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from auditlake.operators import cdc, joins, keyed, reconcile
from auditlake.plans import queries

DDL = "id STRING, at INT, value STRING"
ROWS = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, "x"), ("b", 1, "x"), ("c", 5, None), (None, 1, "n"), (None, 3, "m"), ("d", None, "q")]


def same(a, b):
    assert sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(map(str, b.select(*sorted(b.columns)).collect()))


def shuffles(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("hashpartitioning")


@pytest.mark.parametrize("most", [keyed.FEW_ROWS, 0])
def test_rare_repeats_give_what_scd1_gives(spark, monkeypatch, most):
    monkeypatch.setattr(keyed, "FEW_ROWS", most)
    df = spark.createDataFrame(ROWS, DDL)
    for ties in (None, ["value"]):
        same(cdc.scd1(df, ["id"], "at", tie_break=ties), cdc.scd1_rare(df, ["id"], "at", tie_break=ties))
    same(cdc.scd1(df.limit(0), ["id"], "at"), cdc.scd1_rare(df.limit(0), ["id"], "at"))


def test_rare_repeats_shuffle_no_other_row(spark):
    df = spark.createDataFrame(ROWS, DDL)
    assert shuffles(cdc.scd1(df, ["id"], "at")) == 1
    assert shuffles(cdc.scd1_rare(df, ["id"], "at", ["value"])) == 0


@pytest.mark.parametrize("most", [keyed.FEW_ROWS, 0])
def test_few_known_keys_find_the_same_versions(spark, monkeypatch, most):
    monkeypatch.setattr(keyed, "FEW_ROWS", most)
    at = lambda c: F.timestamp_seconds(c).alias(c)
    facts = spark.createDataFrame([(k, t, n) for n, (k, t) in enumerate([("a", 5), ("a", 15), ("a", 15), ("b", 1), ("z", 9), (None, 3), ("a", None)])], "k STRING, ts LONG, n INT")
    facts = facts.select("k", at("ts"), "n")
    versions = spark.createDataFrame([("a", 4, 10, 1), ("a", 10, 99, 2), ("b", 2, 9, 3), (None, 0, 99, 4)], "customer_id STRING, valid_from LONG, valid_to LONG, customer_key LONG")
    versions = versions.select("customer_id", at("valid_from"), at("valid_to"), "customer_key")
    plain, partly = (joins.pit_join(facts, versions, "k", "ts", "hit", few_known=few) for few in (False, True))
    same(plain, partly)
    assert {r["n"]: r["hit"] for r in partly.collect()} == {0: 1, 1: 2, 2: 2, 3: -1, 4: -1, 5: -1, 6: -1}


@pytest.mark.parametrize("most", [keyed.FEW_ROWS, 0])
def test_fact_totals_count_each_id_once(spark, monkeypatch, most):
    monkeypatch.setattr(keyed, "FEW_ROWS", most)
    ids = ["a", "a", "a", "b", None, None, "c"]
    fact = spark.createDataFrame(
        [(i, Decimal("1.50"), "h" if n % 2 else "f", True, 7, -1) for n, i in enumerate(ids)],
        "event_id STRING, amount DECIMAL(18,2), source_system STRING, is_fraud BOOLEAN, origin_customer_key LONG, counterparty_key LONG",
    )
    row = reconcile.fact_totals(fact, "f", "h").first()
    assert (row["fact_rows"], row["fact_distinct_events"], row["fact_value_total"]) == (7, 3, Decimal("10.50"))
    assert (row["history_rows_gold"], row["gold_generated_rows"], row["generated_unknown_customer_rows"]) == (3, 4, 4)
    assert reconcile.fact_totals(fact.limit(0), "f", "h").first()["fact_distinct_events"] == 0


def test_whole_cells_are_shuffled_once(spark):
    facts = spark.createDataFrame([("a", 5), ("a", 90_000_000)], "k STRING, s LONG").select("k", F.timestamp_seconds("s").alias("ts"))
    spans = spark.createDataFrame([("a", 4, 80_000_000, 1)], "k STRING, f LONG, t LONG, n LONG")
    versions = spans.select("k", F.timestamp_seconds("f").alias("valid_from"), F.timestamp_seconds("t").alias("valid_to"), "n")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = joins.pit_join_overlapping(facts, versions, "k", "ts", "hit", version_key="k", value="n")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["hit"] for r in found.collect()) == [-1, 1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"hashpartitioning\([^)]*level", plan)) == 2  # the cells and those looked up


def test_layouts_get_more_files_with_more_rows(spark, monkeypatch, tmp_path):
    for name, rows in (("events", 5), ("lineitem", 30)):
        spark.range(rows).write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(queries, "LAYOUT_ROWS", 2)
    assert queries._layout_files(spark, str(tmp_path), 8) == 18
    monkeypatch.setattr(queries, "LAYOUT_ROWS", 1_000)
    assert queries._layout_files(spark, str(tmp_path), 8) == 8


def minutes(df, *columns):
    return df.withColumns({c: F.timestamp_seconds(F.col(c) * 60) for c in columns})


@pytest.mark.parametrize("light", [keyed.LIGHT_ROWS, 40, 0])
def test_light_and_sliced_keys_find_the_same_versions(spark, monkeypatch, light):
    monkeypatch.setattr(keyed, "LIGHT_ROWS", light)
    rows = [("hot" if n % 3 else f"k{n % 7}", n * 37 % 5000, n) for n in range(150)]
    rows += [("hot", 100, 1000 + n) for n in range(30)] + [(None, 5, 2000), (None, 5, 2001), ("hot", None, 2002), ("none", 5, 2003)]
    versions = [("hot", at, at + 50, at) for at in range(0, 5000, 70)] + [(f"k{k}", 900 * k, 9000, k) for k in range(6)] + [(None, 0, 9000, 77)]
    facts = minutes(spark.createDataFrame(rows, "k STRING, ts LONG, n INT"), "ts")
    known = minutes(spark.createDataFrame(versions, "customer_id STRING, valid_from LONG, valid_to LONG, customer_key LONG"), "valid_from", "valid_to")
    found = {r["n"]: r["hit"] for r in joins.pit_join(facts, known, "k", "ts", "hit").collect()}
    expected = {n: next((v for c, low, high, v in versions if c == k and k and at is not None and low <= at < high), -1) for k, at, n in rows}
    assert found == expected and len(found) == len(rows)


@pytest.mark.parametrize("light", [40, 0])
def test_light_and_sliced_keys_have_the_same_history(spark, monkeypatch, light):
    rows = [("hot" if n % 3 else None if n % 7 == 0 else f"k{n % 7}", n * 37 % 5000, f"s{n * 37 // 400 % 3}", n) for n in range(150)]
    rows += [("hot", 74, "s9", 900), ("hot", None, "s9", 901)]
    changes = minutes(spark.createDataFrame(rows, "id STRING, at LONG, segment STRING, n INT"), "at")
    whole = cdc.scd2(changes, ["id"], "at", ["segment"], tie_break=["n"]).collect()
    monkeypatch.setattr(keyed, "LIGHT_ROWS", light)
    same(spark.createDataFrame(whole, "id STRING, segment STRING, n INT, start_at TIMESTAMP, end_at TIMESTAMP"), cdc.scd2(changes, ["id"], "at", ["segment"], tie_break=["n"]))


def test_light_keys_are_shuffled_once(spark):
    facts = minutes(spark.createDataFrame([("a", 1, 1), (None, 2, 2)], "k STRING, ts LONG, n INT"), "ts")
    changes = minutes(spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "id STRING, at LONG, segment STRING"), "at")
    history = cdc.scd2(changes, ["id"], "at", ["segment"])
    assert shuffles(history) == 1
    versions = history.selectExpr("id AS customer_id", "start_at AS valid_from", "end_at AS valid_to", "1L AS customer_key")
    assert shuffles(joins.pit_join(facts, versions, "k", "ts", "hit")) == 1
