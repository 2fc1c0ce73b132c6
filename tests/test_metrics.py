from builders import dim, fact, frame, holidays

from auditlake.operators import kpis, metrics, star
from auditlake.sources import reference

KPI = (
    "calendar_date DATE, source_system STRING, txn_count BIGINT, txn_value DECIMAL(28,2), approved_count BIGINT, "
    "fraud_count BIGINT, fraud_rate DOUBLE, fraud_missed_value DECIMAL(28,2)"
)
BASE = {"source_system": "generator-v1", "txn_value": "10", "approved_count": "1", "fraud_missed_value": "2.50"}


def daily(spark):
    return frame(
        spark, KPI,
        [
            {"calendar_date": "2026-10-01", "txn_count": "10", "fraud_count": "5", "fraud_rate": "0.5"},
            {"calendar_date": "2026-10-02", "txn_count": "90", "fraud_count": "0", "fraud_rate": "0"},
            {"calendar_date": "2026-10-04", "txn_count": "100", "fraud_count": "5", "fraud_rate": "0.05"},
            {"calendar_date": "2026-10-04", "txn_count": "0", "fraud_count": "0", "source_system": "paysim"},
        ],
        BASE,
    )


def test_a_ratio_is_a_ratio_of_sums_never_a_mean_of_rates(spark):
    (row,) = metrics.tiles(daily(spark), {"source_system": "generator-v1"}).collect()
    assert (row["transactions"], row["fraud_rate"], str(row["fraud_missed_value"])) == (200, 0.05, "7.50")


def test_a_ratio_is_null_on_a_zero_denominator(spark):
    (row,) = metrics.metric_query(daily(spark), ["source_system"], [metrics.FRAUD_RATE], {"source_system": "paysim"}).collect()
    assert row["fraud_rate"] is None


def test_filters_apply_only_where_the_column_exists(spark):
    filters = {"calendar_date": ("2026-10-02", "2026-10-04"), "hour_of_day": 3, "source_system": "generator-v1"}
    rows = metrics.trend(daily(spark), metrics.TRANSACTIONS, filters).collect()
    assert [(str(r["day"]), r["transactions"]) for r in rows] == [("2026-10-02", 90), ("2026-10-04", 100)]


def test_the_previous_day_is_a_calendar_day(spark):
    rows = metrics.with_previous_day(daily(spark), ["fraud_rate"], by=["source_system"]).collect()
    found = {(str(r["calendar_date"]), r["source_system"]): r["previous_fraud_rate"] for r in rows}
    assert found == {
        ("2026-10-01", "generator-v1"): None, ("2026-10-02", "generator-v1"): 0.5,
        ("2026-10-04", "generator-v1"): None, ("2026-10-04", "paysim"): None,
    }


def test_star_measures_by_role_agree_with_the_kpi_tables(spark):
    facts = fact(
        spark,
        {"is_fraud": "true", "flag_balance_drain": "true"},
        {"is_fraud": "true", "is_declined": "true", "amount": "7.00"},
        {"counterparty_key": "-1", "flag_balance_drain": "true"},
        {"origin_customer_key": "-1", "is_declined": None},
    )
    people = dim(
        spark, {}, {"customer_key": "12", "customer_id": "CG4072", "segment": "premium"},
        {"customer_key": "-1", "customer_id": "UNKNOWN", "segment": "Unknown", "region": "Unknown"},
    )
    sent = {r["segment"]: r for r in metrics.star_metrics(facts, ["segment"], people).collect()}
    received = {r["segment"]: r for r in metrics.star_metrics(facts, ["segment"], people, role="recipient").collect()}
    assert (sent["standard"]["transactions"], sent["Unknown"]["transactions"]) == (3, 1)
    assert (received["premium"]["transactions"], received["Unknown"]["transactions"]) == (3, 1)
    standard = sent["standard"]
    assert (standard["fraud_rate"], standard["fraud_catch_rate"], standard["balance_drain_precision"]) == (2 / 3, 0.5, 0.5)
    assert str(standard["fraud_missed_value"]) == "100.00" and sent["Unknown"]["approval_rate"] == 0.0

    dates = star.dim_date(reference.calendar(spark), holidays(spark, {}))
    (whole,) = metrics.star_metrics(facts, ["source_system"]).collect()
    (tile,) = metrics.tiles(kpis.kpi_daily(facts, dates)).collect()
    assert (whole["transactions"], whole["fraud_rate"], whole["approval_rate"], whole["fraud_missed_value"]) == (
        tile["transactions"], tile["fraud_rate"], tile["approval_rate"], tile["fraud_missed_value"],
    )
    years = {r["calendar_year"]: r["transactions"] for r in metrics.star_metrics(facts, ["calendar_year", "type_name"], dim_date=dates, dim_type=reference.dim_type(spark)).collect()}
    assert years == {2026: 4}


def test_ordered_tables(spark):
    rules = kpis.rule_effectiveness(fact(spark, {}))
    names = [r["rule_name"] for r in metrics.rule_table(rules).collect()]
    assert names == sorted(names) and len(names) == 5
    hours = metrics.by_hour(kpis.kpi_by_hour(fact(spark, {"hour_of_day": "9"}, {"hour_of_day": "3"}))).collect()
    assert [r["hour_of_day"] for r in hours] == [3, 9]
    assert metrics.by_type(kpis.kpi_by_type(fact(spark, {}), reference.dim_type(spark))).first()["type_name"] == "TRANSFER"
