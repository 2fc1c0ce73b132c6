from decimal import Decimal
from itertools import product

import pytest
from builders import PEER, by, dim, fact, frame, holidays, tx
from pyspark.sql import functions as F

from auditlake import constants as K
from auditlake.operators import kpis, star
from auditlake.sources import reference

KINDS = ("TRANSFER", "CASH_OUT", "PAYMENT", "DEBIT")
# Amounts on both sides of the night threshold; balances equal to them, above, below, unknown, nothing.
AMOUNTS = tuple(Decimal(K.NIGHT_AMOUNT) + d for d in (Decimal("-0.01"), 0, 1)) + (Decimal(0), Decimal("7.31"))
BALANCES = ("same", "more", "less", None)
LEFT = {"same": 0, "more": Decimal("0.01"), "less": Decimal("-0.01")}


def grid_rows():
    """Every kind, amount and balance at some hour, and every hour for a large transfer."""
    cases = [(k, a, b, (3 * i) % 24) for i, (k, a, b) in enumerate(product(KINDS, AMOUNTS, BALANCES))]
    cases += [("TRANSFER", Decimal(K.NIGHT_AMOUNT), "more", hour) for hour in range(24)]
    return {f"g{i}": (kind, amount, None if left is None else amount + LEFT[left], hour) for i, (kind, amount, left, hour) in enumerate(cases)}


@pytest.fixture(scope="module")
def grid(spark):
    rows = [
        {"event_id": name, "customer_id": name, "txn_type": kind, "amount": str(amount),
         "origin_balance_before": None if before is None else str(before), "event_ts": f"2026-03-05 {hour:02d}:17:00"}
        for name, (kind, amount, before, hour) in grid_rows().items()
    ] + [
        {"event_id": "src", "status": "DECLINED", "status_source": K.HISTORY_STATUS_SOURCE, "customer_id": "s1"},
        {"event_id": "gen", "status": "DECLINED", "customer_id": "s2"},
        {"event_id": "odd", "txn_type": "REFUND", "customer_id": "s3"},
        {"event_id": "end", "event_ts": "2026-12-31 23:59:59", "customer_id": "s4"},
    ]
    versions = dim(spark, {"customer_id": "src", "customer_key": "5"}, {"customer_id": PEER, "customer_key": "6"})
    return by(star.fact_transactions(tx(spark, *rows), reference.dim_type(spark), versions))


def test_balance_drain_and_night_rules_on_the_whole_grid(grid):
    low, high = K.NIGHT_HOURS
    drains = nights = 0
    for name, (kind, amount, before, hour) in grid_rows().items():
        moves = kind in ("TRANSFER", "CASH_OUT") and amount > 0
        drain = (None if before is None else amount == before) if moves else False
        night = kind == "TRANSFER" and low <= hour <= high and amount >= K.NIGHT_AMOUNT
        assert (grid[name]["flag_balance_drain"], grid[name]["flag_night_high_value"]) == (drain, night), name
        drains, nights = drains + bool(drain), nights + night
    assert drains > 3 and nights > 3


def test_source_rule_needs_both_the_derived_status_and_the_decline(grid):
    assert (grid["src"]["flag_source_rule"], grid["gen"]["flag_source_rule"], grid["gen"]["is_declined"]) == (True, False, True)


def test_keys(grid):
    assert grid["odd"]["type_key"] is None and grid["src"]["type_key"] == 4
    assert grid["end"]["date_key"] == 20261231 and grid["end"]["hour_of_day"] == 23
    assert (grid["src"]["origin_customer_key"], grid["src"]["counterparty_key"]) == (-1, 6)


def test_calendar_attributes_and_holiday_pivot(spark):
    days = reference.calendar(spark, "2026-08-29", "2026-08-31")
    names = holidays(spark, {}, {"title": "Another"}, {"division": "scotland", "title": "S", "holiday_date": "2026-08-30"})
    rows = {str(r["calendar_date"]): r for r in star.dim_date(days, names).orderBy("calendar_date").collect()}
    assert list(rows) == ["2026-08-29", "2026-08-30", "2026-08-31"]
    saturday, sunday, monday = rows.values()
    assert (saturday["date_key"], saturday["day_name"], saturday["month_name"], saturday["is_weekend"]) == (20260829, "Saturday", "August", True)
    assert (sunday["is_weekend"], sunday["is_bank_holiday_scotland"], sunday["is_bank_holiday_eaw"]) == (True, True, False)
    assert (monday["bank_holiday_name_eaw"], monday["is_weekend"], monday["iso_week"]) == ("Summer", False, 36)


def test_the_default_calendar_ends_where_the_rules_end(spark):
    assert reference.calendar(spark).count() == 1096


def test_types_are_planned_without_a_shuffle(spark):
    plan = reference.dim_type(spark)._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" in plan and reference.dim_type(spark).count() == 5


def test_daily_kpis_keep_null_declines_out_of_the_counts_only(spark):
    days = star.dim_date(reference.calendar(spark, "2026-10-06", "2026-10-06"), holidays(spark, {}))
    facts = fact(
        spark,
        {"amount": "10.00"},
        {"amount": "20.00", "is_declined": "true", "is_fraud": "true"},
        {"amount": "40.00", "is_declined": None, "is_fraud": "true"},
        {"amount": "80.00", "is_fraud": None},
        {"amount": "5.00", "date_key": "20990101"},
    )
    (row,) = kpis.kpi_daily(facts, days).collect()
    assert (row["txn_count"], row["approved_count"], row["declined_count"]) == (4, 2, 1)
    assert (str(row["txn_value"]), str(row["approved_value"])) == ("150.00", "130.00")
    assert (row["fraud_count"], str(row["fraud_value"]), row["fraud_rate"]) == (2, "60.00", 0.5)
    assert (row["fraud_missed_count"], str(row["fraud_missed_value"]), row["fraud_catch_rate"]) == (0, "0.00", 0.5)


def test_sources_are_never_mixed_and_catch_rate_is_null_without_fraud(spark):
    days = star.dim_date(reference.calendar(spark, "2026-10-06", "2026-10-06"), holidays(spark, {}))
    rows = kpis.kpi_daily(fact(spark, {}, {"source_system": "paysim"}), days).collect()
    assert len(rows) == 2 and {r["fraud_catch_rate"] for r in rows} == {None}


def test_kpis_by_type_band_and_hour(spark):
    facts = fact(spark, {"is_fraud": "true"}, {"amount": "300.00"}, {"type_key": None})
    (by_type,) = kpis.kpi_by_type(facts, reference.dim_type(spark)).collect()
    assert (by_type["type_name"], by_type["txn_count"], str(by_type["avg_amount"]), by_type["fraud_rate"]) == ("TRANSFER", 2, "200.000000", 0.5)
    (band,) = kpis.kpi_by_band(facts).collect()
    (hour,) = kpis.kpi_by_hour(facts).collect()
    assert (band["amount_band"], band["txn_count"], hour["day_part"], hour["fraud_count"]) == ("100 to 999.99", 3, "afternoon", 1)


def test_rule_effectiveness_by_hand(spark):
    facts = fact(
        spark,
        {"is_fraud": "true", "flag_balance_drain": "true"},
        {"is_fraud": "true", "flag_balance_drain": "true", "flag_burst": "true"},
        {"is_fraud": "true", "flag_source_rule": "true"},
        {"flag_balance_drain": "true"},
        {"flag_night_high_value": "true"},
        {"is_fraud": None, "flag_balance_drain": "true"},
        {"flag_balance_drain": None},
        {},
        {"source_system": "paysim"},
    )
    found = {
        (r["source_system"], r["rule_name"]): (r["flagged_count"], r["fraud_caught"], r["fraud_total"], r["precision_rate"], r["recall_rate"])
        for r in kpis.rule_effectiveness(facts).collect()
    }
    assert len(found) == 10
    assert found["generator-v1", "balance_drain"] == (4, 2, 3, 0.5, 2 / 3)
    assert found["generator-v1", "source_rule"] == (1, 1, 3, 1.0, 1 / 3)
    assert found["generator-v1", "night_high_value"] == (1, 0, 3, 0.0, 0.0)
    assert found["generator-v1", "burst"] == (1, 1, 3, 1.0, 1 / 3)
    assert found["generator-v1", "any_of_our_rules"] == (5, 2, 3, 0.4, 2 / 3)
    assert found["paysim", "burst"] == (0, 0, 0, None, None)


def flagged(df):
    return {(r["entity_id"], r["entity_role"], r["date_key"]): r["flag_reasons"] for r in df.collect()}


def test_unusual_senders(spark):
    facts = fact(
        spark,
        *[{"customer_id": "busy"}] * 8,
        *[{"customer_id": "calm"}] * 7,
        *[{"customer_id": "split", "date_key": "20261006"}] * 4,
        *[{"customer_id": "split", "date_key": "20261007"}] * 4,
        {"customer_id": "both", "flag_burst": "true", "flag_balance_drain": "true"},
    )
    assert flagged(kpis.unusual_senders(facts)) == {
        ("busy", "sender", 20261006): ["HIGH_FREQUENCY"],
        ("both", "sender", 20261006): ["BURST", "BALANCE_DRAIN"],
    }


def test_unusual_recipients(spark):
    types = reference.dim_type(spark)
    hub = [{"counterparty_id": "hub", "customer_id": f"s{i}"} for i in range(5)]
    few = [{"counterparty_id": "few", "customer_id": f"s{i % 4}"} for i in range(5)]
    pay = [{"counterparty_id": "pay", "customer_id": f"s{i}", "type_key": "3"} for i in range(5)]
    facts = fact(spark, *hub, *few, *pay)
    assert flagged(kpis.unusual_recipients(facts, types)) == {("hub", "recipient", 20261006): ["HUB_RECIPIENT"]}
    everything = kpis.unusual_activity(facts, types)
    assert everything.where(F.size("flag_reasons") == 0).count() == 0


def test_a_builder_refuses_unknown_fields(spark):
    with pytest.raises(KeyError):
        frame(spark, "a INT", [{"b": "1"}])
