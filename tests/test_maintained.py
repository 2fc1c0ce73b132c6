import random

import pytest
from builders import frame
from pyspark.sql import functions as F
from test_streams import EVENT, VERSIONS, landed, same

from auditlake.operators import cdc
from auditlake.sources import ranged
from auditlake.streaming import maintained

WIDE = "id STRING, part INT, at TIMESTAMP, segment STRING, region STRING, n INT"


def events_of(rng, ids, n, first=0):
    return [
        {"id": rng.choice(ids), "part": str(rng.randrange(2)), "at": f"2026-01-{rng.randrange(1, 9):02d} {rng.randrange(24):02d}:00:00",
         "segment": rng.choice("st"), "region": rng.choice("ne"), "n": str(first + i)}
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def batches(spark):
    """Six batches: the first over all keys, then neighbours, new ones at both ends, a null and a hot key."""
    rng = random.Random(3)
    every = [f"k{i:03d}" for i in range(200)]
    parts = [every, every[20:24], every[150:153], ["z1", "z2"], ["a0", None], ["k021", "k021", "k180"]]
    sizes = [400, 30, 30, 20, 20, 60]
    return [frame(spark, WIDE, events_of(rng, ids, n, 1000 * i)).cache() for i, (ids, n) in enumerate(zip(parts, sizes))]


def so_far(batches, i):
    rows = batches[0]
    for later in batches[1 : i + 1]:
        rows = rows.unionByName(later)
    return rows


def test_an_upsert_rewrites_only_files_that_can_hold_its_keys(spark, batches, tmp_path):
    root, keys = str(tmp_path / "t"), ["id", "part"]
    for i, batch in enumerate(batches):
        for _ in range(2 if i in (2, 4) else 1):  # a retried batch changes nothing
            maintained.upsert(batch, i, root, keys, "at", rows_per_file=30)
        now = maintained.scd1_maintained_current(spark, root, batch.schema)
        same(cdc.scd1(so_far(batches, i), keys, "at"), now)
    report = {r["batch_id"]: r for r in ranged.states(spark, root).collect()}
    assert sorted(report) == list(range(6)) and report[0]["files_stored"] == 0
    assert all(report[i]["files_rewritten"] < report[i]["files_stored"] for i in range(1, 6))
    assert report[1]["files_rewritten"] > 0 and report[3]["files_rewritten"] == 0 == report[3]["rows_read"]


def test_slots_are_apart_and_hold_every_key_once(spark, batches, tmp_path):
    root = str(tmp_path / "t")
    for i, batch in enumerate(batches):
        maintained.upsert(batch, i, root, ["id", "part"], "at", rows_per_file=25)
    listing = ranged.listing(spark, ranged.state(spark, root), ["id", "part"], batches[0].schema)
    slots = [(r["low"], r["high"]) for r in listing.groupBy(ranged.SLOT).agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("low").collect()]
    named = [tuple((x["id"] or "", x["part"]) for x in s) for s in slots]
    assert all(a[1] < b[0] for a, b in zip(named, named[1:])) and len(named) > 10
    assert listing.agg(F.sum("row_count")).first()[0] == so_far(batches, 5).select("id", "part").distinct().count()


def test_history_after_every_batch_is_that_of_all_events(spark, batches, tmp_path):
    root = str(tmp_path / "t")
    for i, batch in enumerate(batches):
        for _ in range(2 if i == 5 else 1):
            maintained.recut(batch, i, root, ["id"], "at", ["segment", "region"], ["n"], rows_per_file=40)
        now = maintained.scd2_maintained_current(spark, root, batch.schema, "at")
        same(cdc.scd2(so_far(batches, i), *VERSIONS, tie_break=["n"]), now)


def test_what_a_batch_reads_does_not_grow_with_the_batches_before(spark, tmp_path):
    rng, root = random.Random(8), str(tmp_path / "t")
    for i in range(9):  # every batch has keys of its own and one key that has been there before
        ids = [f"k{10 * i + j:03d}" for j in range(10)]
        rows = events_of(rng, ids, 60, 1000 * i) + events_of(rng, [f"k{max(0, 10 * i - 3):03d}"], 2, 5000 + 10 * i)
        maintained.recut(frame(spark, WIDE, rows), i, root, ["id"], "at", ["segment", "region"], ["n"], rows_per_file=50)
    report = [r for r in ranged.states(spark, root).orderBy("batch_id").collect()]
    read = [r["rows_read"] for r in report]
    assert max(read) <= 200 and max(read[5:]) <= 1.5 * max(read[1:5])
    assert report[-1]["files_rewritten"] <= 4 < report[-1]["files_stored"]


def test_a_hot_key_spreads_over_files_of_one_slot(spark, tmp_path):
    root = str(tmp_path / "t")
    rng = random.Random(4)
    rows = [{"id": "hot", "part": "0", "at": f"2026-01-01 {i // 60:02d}:{i % 60:02d}:00", "segment": rng.choice("st"), "region": "n", "n": str(i)} for i in range(300)]
    rows += events_of(rng, ["a", "b", "y", "z"], 40, 1000)
    events = frame(spark, WIDE, rows)
    late = frame(spark, WIDE, [{"id": "hot", "part": "0", "at": "2026-01-01 02:00:30", "segment": "late", "region": "n", "n": "9999"}])
    for i, batch in enumerate((events, late)):
        maintained.recut(batch, i, root, ["id"], "at", ["segment", "region"], ["n"], rows_per_file=60)
    listing = ranged.listing(spark, ranged.state(spark, root), ["id"], events.schema)
    assert listing.where("low.id = 'hot' AND high.id = 'hot'").count() > 2
    same(cdc.scd2(events.unionByName(late), *VERSIONS, tie_break=["n"]), maintained.scd2_maintained_current(spark, root, events.schema, "at"))


def test_streams_keep_tables_up(spark, tmp_path):
    rng = random.Random(5)
    rows = [{k: v for k, v in r.items() if k != "part"} for r in events_of(rng, ["a", "b", "c", None], 80)]
    events = frame(spark, EVENT, rows)
    stream, _ = landed(events, tmp_path)
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    maintained.scd1_maintained(stream, ["id"], "at", one, str(tmp_path / "ck1"))
    maintained.scd1_maintained(stream, ["id"], "at", one, str(tmp_path / "ck1"))  # nothing new
    maintained.scd2_maintained(stream, *VERSIONS, two, str(tmp_path / "ck2"), ["n"])
    same(cdc.scd1(events, ["id"], "at"), maintained.scd1_maintained_current(spark, one, events.schema))
    same(cdc.scd2(events, *VERSIONS, tie_break=["n"]), maintained.scd2_maintained_current(spark, two, events.schema, "at"))
    assert ranged.states(spark, two).count() >= 4


def test_a_table_without_batches_is_empty(spark, tmp_path):
    schema = frame(spark, EVENT, []).schema
    assert maintained.scd1_maintained_current(spark, str(tmp_path / "none"), schema).count() == 0
    maintained.upsert(frame(spark, EVENT, []), 0, str(tmp_path / "t"), ["id"], "at")
    assert ranged.state(spark, str(tmp_path / "t")) is None


def test_the_keys_of_a_batch_are_not_broadcast(spark, batches, tmp_path, monkeypatch):
    # Millions of sorted keys make a file of a few megabytes, so its size must not decide.
    joined, join = [], ranged.join_null_safe
    monkeypatch.setattr(ranged, "join_null_safe", lambda *a, **k: joined.append(join(*a, **k)) or joined[-1])
    for i in (0, 1):
        maintained.upsert(batches[i], i, str(tmp_path / "t"), ["id", "part"], "at", rows_per_file=30)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in joined]
    assert len(plans) == 2 and all("SortMergeJoin" in p for p in plans)
    right = [line for p in plans for line in p.splitlines() if "BroadcastHashJoin" in line and "LeftOuter" in line]
    assert right == []
