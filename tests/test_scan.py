import json

import pytest
from pyspark.sql import functions as F

from auditlake.operators import scan

EVENT = {"title": "t", "date": "2026-01-01", "notes": "", "bunting": True}


def calendar(**regions):
    base = {d: {"events": [EVENT]} for d in ("england-and-wales", "scotland", "northern-ireland")}
    return {**base, **{k.replace("_", "-"): v for k, v in regions.items()}}


def without(field):
    return {k: v for k, v in EVENT.items() if k != field}


CASES = {
    "sound": (json.dumps(calendar()), None),
    "extra-region": (json.dumps(calendar(wales={"events": []})), None),
    "not-json": ("<html>", "INVALID_JSON"),
    "cut": (json.dumps(calendar())[:-5], "INVALID_JSON"),
    "empty-object": ("{}", "MISSING_DIVISION"),
    "one-missing": (json.dumps({k: v for k, v in calendar().items() if k != "scotland"}), "MISSING_DIVISION"),
    "no-list": (json.dumps(calendar(scotland={"events": "none"})), "NO_EVENTS"),
    "empty-list": (json.dumps(calendar(scotland={"events": []})), "NO_EVENTS"),
    "no-events-key": (json.dumps(calendar(scotland={})), "NO_EVENTS"),
    "bad-date": (json.dumps(calendar(scotland={"events": [{**EVENT, "date": "01/02/2026"}]})), "BAD_DATE"),
    "impossible-date": (json.dumps(calendar(scotland={"events": [EVENT, {**EVENT, "date": "2026-02-30"}]})), "BAD_DATE"),
    **{f"no-{f}": (json.dumps(calendar(scotland={"events": [EVENT, without(f)]})), "MISSING_FIELD") for f in EVENT},
}


@pytest.fixture(scope="module")
def verdicts(spark):
    df = spark.createDataFrame([(k, v) for k, (v, _) in CASES.items()], "id STRING, payload STRING")
    return {r["id"]: r["reason"] for r in scan.validate_payloads(df, "id", "payload").collect()}


@pytest.mark.parametrize("name", CASES)
def test_payload_contract(verdicts, name):
    assert verdicts[name] == CASES[name][1]


def hits(spark, text, *patterns):
    df = spark.createDataFrame([(1, text)], "id INT, text STRING")
    return {r["line_no"]: r["n_patterns"] for r in scan.scan_lines(df, "id", "text", patterns or scan.DEFAULT_PATTERNS).collect()}


def test_lines_are_numbered_from_one_and_case_does_not_matter(spark):
    assert hits(spark, "nothing\nJane.Doe@Example.COM\n\n/home/jane and a@b.io", *scan.DEFAULT_PATTERNS[:2]) == {2: 1, 4: 2}


def test_every_kind_of_line_end_counts(spark):
    text = "a\r\nb\rc\nd\x0be\x0cf\x1cg\x1dh\x1ei\x85j k l"
    assert set(hits(spark, text, "[a-z]")) == set(range(1, len(text.splitlines()) + 1))


def test_word_edges_follow_unicode(spark):
    assert hits(spark, "leé\nle é", r"\ble\b") == {2: 1}


def test_the_match_itself_is_not_in_the_output(spark):
    df = spark.createDataFrame([(1, "a@b.io")], "id INT, text STRING")
    assert scan.scan_lines(df, "id", "text").columns == ["id", "line_no", "n_patterns"]


def test_profile_counts_what_is_wrong_with_each_column(spark):
    rows = [("1", "1.5"), ("2", "x"), ("2", "x"), ("3", " "), (None, "1.234"), ("5", "1.010284203E7")]
    df = spark.createDataFrame(rows, "id STRING, amount STRING")
    found = {r["column_name"]: r for r in scan.profile_columns(df, ("amount",)).collect()}
    amount = found["amount"]
    assert (amount["nulls"], amount["blanks"], amount["unparsable"], amount["lossy"], amount["row_count"]) == (0, 1, 2, 1, 6)
    assert (amount["min_value"], amount["max_value"]) == ("1.234", "1.010284203E7")
    assert (found["id"]["nulls"], found["id"]["unparsable"], found["id"]["max_value"]) == (1, None, "5")
    assert scan.duplicate_rows(df).first()[0] == 1
    assert {r["column_name"]: r["distinct_values"] for r in scan.distinct_counts(df, ["id", "amount"]).collect()} == {"id": 4, "amount": 5}
    counts = {(r["dimension"], r["value"]): r["row_count"] for r in scan.profile_counts(df, {"id": F.col("id")}).collect()}
    assert counts["id", "2"] == 2 and counts["id", None] == 1
