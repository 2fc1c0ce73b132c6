from datetime import datetime
from decimal import Decimal

import pytest
from builders import frame
from pyspark.sql import functions as F

from auditlake import constants as K
from auditlake import functions as A

CENT = Decimal("0.01")
# Nothing, a cent below and exactly at every edge, and far above the last one.
POINTS = sorted({Decimal("0.00"), *(Decimal(e) - CENT for e in K.BAND_EDGES), *(Decimal(e).quantize(CENT) for e in K.BAND_EDGES), Decimal(7) * K.BAND_EDGES[-1] ** 2})
LENIENT = [
    "2026", "2026-10-06", "10:30", "2026-10-06 10:30:00", "2026-10-06T10:30:00", "2026-10-06T10:30Z",
    "2026-10-06T10:30:00+00:00", "2026-10-06T10:30:00.000Z", "06/10/2026", " 2026-10-06T10:30:00Z", "not-a-time",
]
IMPOSSIBLE = ["2026-02-30T10:00:00Z", "2026-13-01T10:00:00Z", "2026-10-06T25:00:00Z", "2026-10-06T10:61:00Z"]


def test_bands_at_every_edge(spark):
    df = frame(spark, "amount DECIMAL(18,2)", [{"amount": str(a)} for a in POINTS])
    sort = A.band_sort(F.col("amount"))
    rows = df.select("amount", sort.alias("s"), A.amount_band(sort).alias("b")).collect()
    for r in rows:
        band = 1 + sum(r.amount >= e for e in K.BAND_EDGES)
        assert (r.s, r.b) == (band, K.BAND_LABELS[band - 1])
    assert {r.s for r in rows} == set(range(1, len(K.BAND_LABELS) + 1))


def test_day_parts_of_every_hour(spark):
    def named(hour):
        return next((name for before, name in K.DAY_PART_EDGES if hour < before), K.LAST_DAY_PART)

    rows = spark.range(24).select("id", A.day_part(F.col("id"))).collect()
    assert [r[1] for r in sorted(rows)] == [named(h) for h in range(24)]


@pytest.mark.parametrize("text", LENIENT + IMPOSSIBLE)
def test_only_the_documented_timestamp_text_is_accepted(spark, text):
    df = spark.createDataFrame([(text,)], "t STRING")
    assert df.select(A.strict_ts(F.col("t"))).first()[0] is None


def test_the_documented_timestamp_text_is_read_as_utc(spark):
    df = spark.createDataFrame([("2026-10-06T10:30:05Z",), (None,)], "t STRING")
    rows = [r[0] for r in df.select(A.strict_ts(F.col("t")).cast("string")).collect()]
    assert rows == ["2026-10-06 10:30:05", None]


def test_step_counter_starts_at_the_anchor(spark):
    df = spark.createDataFrame([(1,), (743,)], "s INT")
    rows = [r[0] for r in df.select(A.step_to_ts(F.col("s")).cast("string")).collect()]
    assert rows == ["2026-08-20 00:00:00", "2026-09-19 22:00:00"]


def test_content_id_skips_nulls_unless_asked_not_to(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x STRING, y STRING")
    plain = df.select(A.content_id([F.col("x"), F.col("y")])).distinct().count()
    safe = df.select(A.content_id([F.col("x"), F.col("y")], null_safe=True)).distinct().count()
    assert (plain, safe) == (1, 2)


def test_null_safe_content_id_is_not_fooled_by_separators(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c")], "x STRING, y STRING")
    assert df.select(A.content_id([F.col("x"), F.col("y")], null_safe=True)).distinct().count() == 2


def test_entity_kind_and_merchant_balance(spark):
    df = spark.createDataFrame([("M1",), ("C1",), ("X1",), (None,)], "i STRING")
    kinds = [r[0] for r in df.select(A.entity_kind(F.col("i"))).collect()]
    kept = [r[0] for r in df.select(A.null_if_merchant(F.col("i"), F.lit(5))).collect()]
    assert kinds == ["merchant", "customer", None, None]
    assert kept == [None, 5, 5, 5]


def test_feed_date_and_late_file(spark):
    df = spark.createDataFrame([("/x/customer_profile_2026-10-05_late.csv",)], "p STRING")
    row = df.select(A.feed_date(F.col("p"), "customer_profile_").cast("string"), A.is_late_file(F.col("p"))).first()
    assert tuple(row) == ("2026-10-05", True)


def test_ratio_is_null_on_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "n BIGINT, d BIGINT")
    assert [r[0] for r in df.select(A.ratio(F.col("n"), F.col("d"))).collect()] == [None, 0.25]


def test_reasons_keep_rule_order_and_treat_null_as_not_fired(spark):
    df = spark.createDataFrame([(1,)], "x INT")
    rules = [("B", F.lit(True)), ("N", F.lit(None).cast("boolean")), ("A", F.col("x") == 1), ("F", F.lit(False))]
    assert df.select(A.reason_list(rules)).first()[0] == ["B", "A"]


def test_surrogate_key_follows_id_and_start(spark):
    df = spark.createDataFrame([("a", datetime(2026, 1, 1)), ("a", datetime(2026, 1, 2))], "i STRING, t TIMESTAMP")
    keys = [r[0] for r in df.select(A.surrogate_key(F.col("i"), F.col("t"))).collect()]
    again = [r[0] for r in df.select(A.surrogate_key(F.col("i"), F.col("t"))).collect()]
    assert keys[0] != keys[1] and keys == again
