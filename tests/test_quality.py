from datetime import datetime

import pytest
from builders import feed, frame, holidays, profile, tx
from pyspark.sql import functions as F

from auditlake import constants as K
from auditlake.operators import quality, shape
from auditlake.operators.quality import DROP, FAIL, WARN, Expectation, ExpectationFailed
from auditlake.operators.rules import DATASETS, expectations
from auditlake.sources import sinks


def numbers(spark):
    return spark.createDataFrame([(1,), (-1,), (None,)], "x INT")


def counts(metrics):
    return {r["expectation"]: (r["passed_records"], r["failed_records"]) for r in metrics.collect()}


def test_false_and_null_are_both_violations(spark):
    metrics = quality.expectation_metrics(numbers(spark), [Expectation("positive", "x > 0")], "t", "u")
    assert counts(metrics) == {"positive": (1, 2)}


def test_warn_keeps_rows_drop_removes_them_fail_stops(spark):
    rows, metrics = quality.expect(numbers(spark), [Expectation("p", "x > 0", WARN)], "t", "u")
    assert rows.count() == 3 and counts(metrics) == {"p": (1, 2)}
    rows, _ = quality.expect(numbers(spark), [Expectation("p", "x > 0", DROP)], "t", "u")
    assert [r["x"] for r in rows.collect()] == [1]
    with pytest.raises(ExpectationFailed, match="p \\(2 rows\\)"):
        quality.expect(numbers(spark), [Expectation("p", "x > 0", FAIL)], "t", "u")


def test_an_empty_frame_violates_nothing(spark):
    _, metrics = quality.expect(numbers(spark).limit(0), [Expectation("p", "x > 0", FAIL)], "t", "u")
    assert counts(metrics) == {"p": (0, 0)}


def test_audited_write_publishes_only_what_passed(spark, tmp_path):
    target, staging = str(tmp_path / "target"), str(tmp_path / "s")
    soft = [Expectation("p", "x > 0", DROP), Expectation("q", "x IS NOT NULL", WARN)]
    metrics = quality.audited_write(numbers(spark), soft, "t", "u", staging, target)
    assert counts(metrics) == {"p": (1, 2), "q": (2, 1)}
    with pytest.raises(ExpectationFailed):
        hard = [Expectation("p", "x > 0", FAIL)]
        quality.audited_write(numbers(spark), hard, "t", "u", staging, target)
    assert [r["x"] for r in quality.read_audited(spark, target, "t").collect()] == [1]
    quality.audited_write(numbers(spark), [], "t", "u", staging, target)
    assert quality.read_audited(spark, target, "t").count() == 3
    with pytest.raises(LookupError):
        quality.read_audited(spark, target, "other")


def test_all_rules_are_there_and_hard_ones_are_hard():
    every = {(d, e.name): e.action for d in DATASETS for e in expectations(d)}
    assert len(every) == 54
    assert sum(a == FAIL for a in every.values()) == 35
    assert every["silver.transactions", "counterparty_present"] == WARN
    assert every["gold.reconciliation", "versions_match_profile_events"] == WARN


CLEAN = {
    "silver.transactions": lambda s: tx(s, {}),
    "silver.customer_profile_events": lambda s: profile(s, {}, {"customer_id": "MG8803", "entity_type": "merchant"}),
    "silver.bank_holidays": lambda s: holidays(s, {}),
    "bronze.transactions_daily": lambda s: feed(s, {}),
}
DEFECTS = [
    ("silver.transactions", lambda s: tx(s, {"event_id": None}), "event_id_present"),
    ("silver.transactions", lambda s: tx(s, {"amount": "-1"}), "amount_not_negative"),
    ("silver.transactions", lambda s: tx(s, {"amount": None}), "amount_not_negative"),
    ("silver.transactions", lambda s: tx(s, {"txn_type": "REFUND"}), "known_type"),
    ("silver.transactions", lambda s: tx(s, {"status": None}), "known_status"),
    ("silver.transactions", lambda s: tx(s, {"status": "DECLINED"}), "decline_has_reason"),
    ("silver.transactions", lambda s: tx(s, {"event_date": "2029-01-01"}), "event_date_in_range"),
    ("silver.transactions", lambda s: tx(s, {"counterparty_id": None}), "counterparty_present"),
    ("silver.customer_profile_events", lambda s: profile(s, {"entity_type": "bank"}), "known_entity_type"),
    ("silver.customer_profile_events", lambda s: profile(s, {"customer_id": "MG8803"}), "id_prefix_matches_type"),
    ("silver.bank_holidays", lambda s: holidays(s, {"title": ""}), "title_present"),
    ("silver.bank_holidays", lambda s: holidays(s, {"division": "wales"}), "known_division"),
    ("bronze.transactions_daily", lambda s: feed(s, {"_rescued_data": "{}"}), "no_contract_violations"),
]


@pytest.mark.parametrize("dataset", CLEAN)
def test_clean_rows_violate_nothing(spark, dataset):
    metrics = quality.expectation_metrics(CLEAN[dataset](spark), expectations(dataset), dataset, "u")
    assert all(failed == 0 for _, failed in counts(metrics).values())


@pytest.mark.parametrize(("dataset", "rows", "rule"), DEFECTS)
def test_each_rule_notices_its_defect(spark, dataset, rows, rule):
    metrics = counts(quality.expectation_metrics(rows(spark), expectations(dataset), dataset, "u"))
    assert metrics[rule] == (0, 1)


@pytest.mark.parametrize(
    "defect",
    [{"event_id": None}, {"customer_id": None}, {"amount": None}, {"amount": "-1"}, {"type": "X"}, {"event_ts": "10:30"}, {"status": "X"}],
)
def test_what_the_split_catches_would_also_stop_the_clean_table(spark, defect):
    forced = shape.unify([shape.map_feed(feed(spark, defect))])
    assert shape.split_valid(forced).count() == 0
    with pytest.raises(ExpectationFailed):
        quality.expect(forced, expectations("silver.transactions"), "silver.transactions", "u")


def results(spark, *rows):
    base = {"run_id": "r", "suite": "gold", "check_name": "c", "expected": "0", "actual": "0", "passed": "true"}
    return frame(spark, K.CHECK_RESULTS_DDL, rows, base)


def test_scorecard_shows_the_newest_run_only(spark):
    df = results(
        spark,
        {"run_at": "2026-10-01", "passed": "false"},
        {"run_at": "2026-10-02"},
        {"run_at": "2026-10-02", "passed": "false"},
        {"run_at": "2026-10-02", "suite": "silver"},
    )
    card = {r["suite"]: (r["checks"], r["passed"], r["failed"]) for r in quality.check_scorecard(df).collect()}
    assert card == {"gold": (2, 1, 1), "silver": (1, 1, 0)}
    assert {str(r["run_at"])[:10]: r["failed"] for r in quality.check_history(df).collect()} == {"2026-10-01": 1, "2026-10-02": 1}


def test_failure_rate_is_null_when_nothing_ran(spark):
    base = {"run_at": "2026-10-01", "dataset": "d", "expectation": "e"}
    df = frame(
        spark, K.EXPECTATION_RESULTS_DDL,
        [{"passed_records": "3", "failed_records": "1"}, {"expectation": "f", "passed_records": "0", "failed_records": "0"}], base,
    )
    rates = {r["expectation"]: r["failure_rate"] for r in quality.expectation_scorecard(df).collect()}
    assert rates == {"e": 0.25, "f": None}


def test_quality_objects_are_idempotent_and_empty_before_any_run(spark):
    for _ in range(2):
        sinks.ensure_quality_objects(spark, "quality_t")
    assert spark.table("quality_t.check_scorecard").count() == 0
    sinks.append_history(results(spark, {"run_at": "2026-10-01"}), "quality_t.check_results")
    sinks.append_history(results(spark, {"run_at": "2026-10-02", "passed": "false"}), "quality_t.check_results")
    sinks.ensure_quality_objects(spark, "quality_t")
    (card,) = spark.table("quality_t.check_scorecard").collect()
    assert (str(card["run_at"])[:10], card["checks"], card["failed"]) == ("2026-10-02", 1, 1)
    assert spark.table("quality_t.check_history").count() == 2
    assert spark.table("quality_t.expectation_scorecard").count() == 0


def test_a_retried_append_adds_nothing(spark):
    sinks.ensure_quality_objects(spark, "quality_r")
    first, second = results(spark, {"run_at": "2026-10-01"}), results(spark, {"run_at": "2026-10-02"}, {"run_at": "2026-10-02", "suite": "other"})
    for part in (first, second, second, first):
        sinks.append_history(part, "quality_r.check_results")
    kept = spark.table("quality_r.check_results").groupBy("run_at", "suite").count().collect()
    assert len(kept) == 3 and {r["count"] for r in kept} == {1}


def test_an_append_that_breaks_off_leaves_the_history_and_can_be_sent_again(spark):
    sinks.ensure_quality_objects(spark, "quality_b")
    sinks.append_history(results(spark, {"run_at": "2026-10-01"}), "quality_b.check_results")
    new = results(spark, {"run_at": "2026-10-02"}, {"run_at": "2026-10-02", "check_name": "last"})
    broken = new.withColumn("actual", F.when(F.col("check_name") == "last", F.raise_error(F.lit("lost"))).otherwise(F.col("actual")))
    with pytest.raises(Exception, match="lost"):
        sinks.append_history(broken, "quality_b.check_results")
    assert spark.table("quality_b.check_results").count() == 1
    for _ in range(2):
        sinks.append_history(new, "quality_b.check_results")
    assert spark.table("quality_b.check_results").count() == 3


def test_a_table_that_is_not_stored_by_run_takes_no_history(spark):
    results(spark, {}).write.mode("overwrite").saveAsTable("plain_history")
    with pytest.raises(ValueError, match="not stored by run"):
        sinks.append_history(results(spark, {}), "plain_history")


def test_materialize_replaces(spark):
    for n in (3, 2):
        sinks.materialize(spark.range(n), "mat_t")
    assert spark.table("mat_t").count() == 2


def test_a_recomputation_that_fails_leaves_the_old_table(spark):
    sinks.materialize(spark.range(4), "mat_f")
    begun = spark.table("mat_f")
    with pytest.raises(Exception, match="half way"):
        sinks.materialize(spark.range(9).select(F.when(F.col("id") > 7, F.raise_error(F.lit("half way"))).otherwise(F.col("id")).alias("id")), "mat_f")
    assert spark.table("mat_f").count() == 4
    sinks.materialize(spark.table("mat_f").where("id < 3"), "mat_f")  # from itself
    assert spark.table("mat_f").count() == 3 and begun.count() == 4


@pytest.mark.parametrize("method", ["xxhash64", "sha256"])
def test_fingerprint_follows_content_not_order(spark, method):
    df = spark.range(100).select(F.col("id").cast("string").alias("a"), F.when(F.col("id") % 2 == 0, "x").alias("b"))
    one = quality.fingerprint(df, ["a", "b"], method).first()
    assert quality.fingerprint(df.orderBy(F.desc("a")).repartition(7), ["a", "b"], method).first() == one
    edited = df.withColumn("a", F.when(F.col("a") == "5", "55").otherwise(F.col("a")))
    moved = df.withColumn("b", F.when(F.col("a") == "2", None).otherwise(F.col("b")))
    assert quality.fingerprint(edited, ["a", "b"], method).first() != one
    assert quality.fingerprint(moved, ["a", "b"], method).first() != one
    assert tuple(quality.fingerprint(df.limit(0), ["a"], method).first()) == (0, "0")


def test_fingerprint_tells_null_from_text(spark):
    a = spark.createDataFrame([(None, "x")], "a STRING, b STRING")
    b = spark.createDataFrame([("x", None)], "a STRING, b STRING")
    for method in ("xxhash64", "sha256"):
        assert quality.fingerprint(a, ["a", "b"], method).first() != quality.fingerprint(b, ["a", "b"], method).first()


def test_plain_text_drops_the_fraction_of_whole_numbers(spark):
    df = frame(spark, "v DECIMAL(28,2)", [{"v": "1097.00"}, {"v": "12.50"}, {"v": "100"}, {"v": None}])
    assert [r[0] for r in df.select(quality.plain_text(F.col("v"))).collect()] == ["1097", "12.50", "100", None]


def test_defects_and_quarantine_summary(spark):
    rows = feed(
        spark, {}, {}, {"event_id": "n", "customer_id": None, "is_fraud": "1"}, {"event_id": "b", "amount": "-1"},
        {"event_id": "t", "event_ts": "10:30"}, {"event_id": "u", "type": "X", "event_ts": "2026"},
    )
    (day,) = quality.measure_defects(rows, quality.defect_rules()).collect()
    assert tuple(day) == (datetime(2026, 10, 6).date(), 6, 5, 1, 1, 1, 2)
    summary = {r["reason"]: (r["quarantined_rows"], r["hidden_fraud_rows"]) for r in quality.quarantine_summary(shape.quarantine(shape.unify([shape.map_feed(rows)]))).collect()}
    assert summary == {"NULL_REQUIRED_FIELD": (1, 1), "NEGATIVE_AMOUNT": (1, 0), "BAD_TIMESTAMP": (2, 0), "UNKNOWN_TYPE": (1, 0)}
