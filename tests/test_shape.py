import json

import pytest
from builders import by, feed, history
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from auditlake import constants as K
from auditlake.operators import shape

CASES = {
    "clean": ({}, []),
    "no-counterparty": ({"counterparty_id": None}, []),
    "no-customer": ({"customer_id": None}, ["NULL_REQUIRED_FIELD"]),
    "no-amount": ({"amount": None}, ["NULL_REQUIRED_FIELD"]),
    "no-type": ({"type": None}, ["NULL_REQUIRED_FIELD"]),
    "no-ts": ({"event_ts": None}, ["NULL_REQUIRED_FIELD"]),
    "no-status": ({"status": None}, ["NULL_REQUIRED_FIELD"]),
    "negative": ({"amount": "-0.01"}, ["NEGATIVE_AMOUNT"]),
    "zero": ({"amount": "0.00"}, []),
    "type-case": ({"type": "payment"}, ["UNKNOWN_TYPE"]),
    "type-space": ({"type": "PAYMENT "}, ["UNKNOWN_TYPE"]),
    "status-near": ({"status": "Approved"}, ["UNKNOWN_STATUS"]),
    "bad-ts": ({"event_ts": "10:30"}, ["BAD_TIMESTAMP"]),
    "many": (
        {"amount": "-1", "type": "X", "event_ts": "?", "status": "?", "customer_id": None},
        ["NULL_REQUIRED_FIELD", "NEGATIVE_AMOUNT", "UNKNOWN_TYPE", "BAD_TIMESTAMP", "UNKNOWN_STATUS"],
    ),
}


@pytest.fixture(scope="module")
def mapped(spark):
    rows = [{"event_id": name, **change} for name, (change, _) in CASES.items()]
    return by(shape.map_feed(feed(spark, *rows)))


@pytest.mark.parametrize("name", CASES)
def test_reasons(mapped, name):
    assert mapped[name]["failed_checks"] == CASES[name][1]


def test_a_missing_id_is_a_reason(spark):
    assert shape.map_feed(feed(spark, {"event_id": None})).first()["failed_checks"] == ["NULL_REQUIRED_FIELD"]


def test_labels_stay_three_valued(spark):
    rows = by(shape.map_feed(feed(spark, {"event_id": "n", "is_fraud": None}, {"event_id": "y", "is_fraud": "1"})))
    assert (rows["n"]["is_fraud"], rows["y"]["is_fraud"]) == (None, True)


def test_history_derives_time_status_and_unknown_balances(spark):
    df = shape.map_history(
        history(
            spark,
            {"step": "265", "nameDest": "M9", "amount": "1"},
            {"step": "1", "nameDest": "C9", "amount": "2", "isFlaggedFraud": "1", "oldbalanceDest": "7"},
        )
    )
    merchant, flagged = df.orderBy("amount").collect()
    assert str(merchant["event_ts"]) == "2026-08-31 00:00:00"
    assert (merchant["dest_balance_before"], merchant["counterparty_kind"]) == (None, "merchant")
    assert (merchant["status"], merchant["decline_reason"]) == ("APPROVED", None)
    assert (flagged["status"], flagged["decline_reason"]) == ("DECLINED", "PAYSIM_FLAGGED")
    assert str(flagged["dest_balance_before"]) == "7.00"
    assert flagged["event_id"].startswith("P") and len(flagged["event_id"]) == 25


def test_every_source_column_changes_the_content_id_and_audit_columns_do_not(spark):
    changes = [
        {"step": "2"}, {"type": "DEBIT"}, {"amount": "1.00"}, {"nameOrig": "C7"}, {"oldbalanceOrg": "1.00"},
        {"newbalanceOrig": "1.00"}, {"nameDest": "M7"}, {"oldbalanceDest": "1.00"}, {"newbalanceDest": "1.00"},
        {"isFraud": "1"}, {"isFlaggedFraud": "1"},
    ]
    ids = [r["event_id"] for r in shape.map_history(history(spark, {}, *changes)).collect()]
    assert len(set(ids)) == len(changes) + 1
    audit = shape.map_history(history(spark, {}, {"_source_file": "/other", "_ingested_at": "2027-01-01 00:00:00"}))
    assert len({r["event_id"] for r in audit.collect()}) == 1


def test_history_reasons(spark):
    rows = shape.map_history(
        history(spark, {"step": None, "amount": "1"}, {"amount": "-2"}, {"type": "X", "amount": "3"}, {"nameDest": None, "amount": "4"})
    ).orderBy(F.abs("amount"))
    assert [r["failed_checks"] for r in rows.collect()] == [
        ["NULL_REQUIRED_FIELD"], ["NEGATIVE_AMOUNT"], ["UNKNOWN_TYPE"], [],
    ]


def test_unify_matches_by_name_and_keeps_the_declared_types(spark):
    df = shape.unify([shape.map_feed(feed(spark, {})), shape.map_history(history(spark, {}))])
    declared = StructType.fromDDL(K.UNIFIED_DDL)
    assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in declared.fields]
    rows = {r["source_system"]: r for r in df.collect()}
    assert rows["generator-v1"]["dest_balance_before"] is None and rows["paysim"]["channel"] is None


def test_split_and_quarantine_share_the_rows(spark):
    tagged = shape.unify([shape.map_feed(feed(spark, {"event_id": "a"}, {"event_id": "b", "amount": None, "event_ts": "10:30"}))])
    assert [r["event_id"] for r in shape.split_valid(tagged).collect()] == ["a"]
    row = shape.quarantine(tagged).first()
    record = json.loads(row["raw_record"])
    assert row["event_id"] == "b" and row["failed_checks"] == ["NULL_REQUIRED_FIELD", "BAD_TIMESTAMP"]
    assert set(record) == set(shape.RAW_RECORD)
    assert record["amount"] is None and record["event_ts_raw"] == "10:30"


def test_a_feed_without_the_later_column_still_maps(spark):
    assert shape.map_feed(feed(spark, {}).drop("channel")).first()["channel"] is None


def test_profile_events_pass_the_typed_columns(spark):
    from builders import profile

    assert shape.profile_events(profile(spark, {})).columns == [
        "customer_id", "entity_type", "segment", "region", "changed_at", "_source_file", "_ingested_at",
    ]
