import random
from datetime import datetime, timedelta

import pytest
from builders import tx
from pyspark.sql import functions as F

from auditlake import constants as K
from auditlake.operators import keyed, star

START = datetime(2026, 10, 6, 10, 0, 0)


def flagged_seconds(spark, offsets, **window):
    """Offsets (seconds after START, customer, type) of the rows that the burst rule flags."""
    rows = [
        {"event_id": str(i), "event_ts": str(START + timedelta(seconds=s)), "customer_id": who, "txn_type": kind}
        for i, (s, who, kind) in enumerate(offsets)
    ]
    flags = {int(r["event_id"]): r["flag_burst"] for r in star.burst_flag(tx(spark, *rows), **window).collect()}
    return [offsets[i][0] for i in sorted(flags) if flags[i]]


FRAME = K.BURST_MINUTES * 60


@pytest.mark.parametrize("gap", [0, 1, FRAME // (K.BURST_COUNT - 1)])
def test_a_run_as_long_as_the_frame_is_a_burst_for_every_row(spark, gap):
    run = [(gap * i, "c", "TRANSFER") for i in range(K.BURST_COUNT)]
    assert len(flagged_seconds(spark, run)) == K.BURST_COUNT
    assert flagged_seconds(spark, run[1:]) == []


def test_the_frame_reaches_equally_far_both_ways_and_includes_its_ends(spark):
    half = K.BURST_COUNT // 2
    ends = [(-FRAME, "c", "TRANSFER")] * half + [(0, "c", "TRANSFER")] + [(FRAME, "c", "TRANSFER")] * half
    assert flagged_seconds(spark, ends) == [0]
    outside = [(s - (s < 0) + (s > 0), who, kind) for s, who, kind in ends]
    assert flagged_seconds(spark, outside) == []


def test_burst_flags_equal_the_definition_on_random_rows(spark):
    rng = random.Random(31)
    rows = [(rng.randrange(0, 4 * FRAME), rng.choice("ccd"), rng.choice(["TRANSFER", "TRANSFER", "PAYMENT"])) for _ in range(60)]
    # A row counts, and is flagged, only if it is a transfer.
    want = [
        s
        for s, who, kind in rows
        if kind == "TRANSFER" and sum(w == who and k == kind and abs(t - s) <= FRAME for t, w, k in rows) >= K.BURST_COUNT
    ]
    assert sorted(flagged_seconds(spark, rows)) == sorted(want) and 0 < len(want) < 60


@pytest.mark.parametrize(("before", "after"), [(900, 900), (60, 0), (0, 7200), (1, 1)])
def test_count_within_equals_brute_force(spark, before, after):
    rng = random.Random(before + after)
    rows = [
        (i, rng.choice(["a", "a", "a", "b", None]), START + timedelta(seconds=rng.randrange(0, 20000)), rng.random() < 0.4)
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "id INT, k STRING, ts TIMESTAMP, hit BOOLEAN")
    found = {r["id"]: r["n"] for r in keyed.count_within(df, "k", "ts", F.col("hit"), before, after, "n").collect()}
    for i, k, ts, _ in rows:
        lo, hi = ts - timedelta(seconds=before), ts + timedelta(seconds=after)
        assert found[i] == sum(1 for _, k2, t2, h in rows if k2 == k and h and lo <= t2 <= hi)


@pytest.mark.parametrize("seconds", [1, 3600, 10**7])
@pytest.mark.parametrize("backward", [False, True])
def test_last_known_does_not_depend_on_slicing(spark, seconds, backward):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        k = "hot" if i % 3 else rng.choice([None, *[f"k{j}" for j in range(6)]])
        rows.append((k, START + timedelta(minutes=rng.randrange(0, 3000)), i, i if rng.random() < 0.3 else None))
    df = spark.createDataFrame(rows, "k STRING, ts TIMESTAMP, i INT, v INT")
    sliced = keyed.with_slice(df, "ts", seconds)
    values = {"upto": (F.col("v"), True), "prior": (F.col("v"), False)}
    found = {r["i"]: (r["upto"], r["prior"]) for r in keyed.last_known(sliced, ["k"], ["ts", "i"], values, backward).collect()}
    for k, ts, i, _ in rows:
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2]), reverse=backward)
        at = next(n for n, r in enumerate(mine) if r[2] == i)
        last = lambda rs: next((r[3] for r in reversed(rs) if r[3] is not None), None)
        assert found[i] == (last(mine[: at + 1]), last(mine[:at]))


def test_latest_keeps_one_row_a_key_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    latest = keyed.latest_by(df, ["k"], [F.col("id").desc()])
    assert sorted(r["id"] for r in latest.collect()) == [997, 998, 999]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
