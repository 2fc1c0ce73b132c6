"""Properties that hold for any input."""

import random

from builders import feed, tx
from pyspark.sql import functions as F

from auditlake.operators import cdc, shape, star

VALUES = {
    "customer_id": ["CG4071", None],
    "amount": ["1.00", "0.00", "-3.00", None],
    "type": ["PAYMENT", "TRANSFER", "REFUND", "payment", None],
    "event_ts": ["2026-10-06T12:30:00Z", "10:30", "2026-02-30T00:00:00Z", None],
    "status": ["APPROVED", "DECLINED", "PENDING", None],
}


def random_feed(spark, seed, n=200):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        row = {"event_id": f"e{rng.randrange(n // 2)}", "_ingested_at": f"2026-10-07 {rng.randrange(24):02d}:00:00"}
        for column, values in VALUES.items():
            row[column] = values[0] if rng.random() < 0.7 else rng.choice(values)
        rows.append(row)
    return feed(spark, *rows)


def test_every_row_is_clean_or_quarantined_and_never_both(spark):
    raw = random_feed(spark, 1)
    tagged = shape.unify([shape.map_feed(raw)])
    assert shape.split_valid(tagged).count() + shape.quarantine(tagged).count() == raw.count() == 200


def test_replay_and_order_never_change_the_deduplicated_rows(spark):
    tagged = shape.unify([shape.map_feed(random_feed(spark, 2))])
    clean = shape.split_valid(tagged)
    once = cdc.scd1(clean, ["event_id"], "_ingested_at", ["failed_checks"])
    replayed = clean.unionByName(clean).repartition(5, F.rand(3))
    again = cdc.scd1(replayed, ["event_id"], "_ingested_at", ["failed_checks"])
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect()))
    assert once.count() == clean.select("event_id").distinct().count()


def test_the_fact_keeps_exactly_the_transactions(spark):
    from auditlake.sources import reference
    from builders import dim

    rng = random.Random(4)
    rows = [{"event_id": f"t{i}", "customer_id": f"CG{rng.randrange(4)}", "event_ts": f"2026-10-06 {rng.randrange(24):02d}:{rng.randrange(60):02d}:00"} for i in range(120)]
    versions = dim(spark, {}, {"customer_key": "12", "customer_id": "CG4072"})
    fact = star.fact_transactions(tx(spark, *rows), reference.dim_type(spark), versions)
    assert sorted(r["event_id"] for r in fact.collect()) == sorted(r["event_id"] for r in rows)


def test_staged_burst_moments_give_the_same_flags(spark):
    rows = [{"event_id": str(i), "event_ts": f"2026-10-06 10:{i * 3:02d}:00"} for i in range(12)]
    plain = {r["event_id"]: r["flag_burst"] for r in star.burst_flag(tx(spark, *rows)).collect()}
    staged = {r["event_id"]: r["flag_burst"] for r in star.burst_flag(tx(spark, *rows), staged=True).collect()}
    assert plain == staged and any(plain.values())
