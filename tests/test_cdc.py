import json
import random

import pytest
from builders import frame, profile
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from auditlake.operators import cdc, shape

EVENT = "id STRING, at TIMESTAMP, segment STRING, region STRING, kind STRING"


def cut(df, **kw):
    return cdc.scd2(df, ["id"], "at", ["segment", "region"], **kw)


def rows(df):
    return sorted(
        (r["id"], str(r["start_at"]), str(r["end_at"]), r["segment"], r["region"], r["kind"]) for r in df.collect()
    )


def event(at, segment, region="n", kind="x", id="a"):
    return {"id": id, "at": f"2026-01-{at} 00:00:00", "segment": segment, "region": region, "kind": kind}


def test_a_version_starts_only_when_a_tracked_column_changes(spark):
    df = frame(spark, EVENT, [event("01", "s"), event("02", "s"), event("03", "p"), event("04", "p", "e")])
    assert rows(cut(df)) == [
        ("a", "2026-01-01 00:00:00", "2026-01-03 00:00:00", "s", "n", "x"),
        ("a", "2026-01-03 00:00:00", "2026-01-04 00:00:00", "p", "n", "x"),
        ("a", "2026-01-04 00:00:00", "None", "p", "e", "x"),
    ]


def test_untracked_columns_show_their_last_value_within_the_version(spark):
    df = frame(spark, EVENT, [event("01", "s", kind="old"), event("02", "s", kind="new"), event("03", "p", kind="z")])
    assert [(r[3], r[5]) for r in rows(cut(df))] == [("s", "new"), ("p", "z")]


def test_null_is_a_value_of_its_own(spark):
    df = frame(spark, EVENT, [event("01", None), event("02", None), event("03", "p"), event("04", None)])
    assert [r[3] for r in rows(cut(df))] == [None, "p", None]


def test_a_return_to_an_old_value_is_a_new_version(spark):
    df = frame(spark, EVENT, [event("01", "s"), event("02", "p"), event("03", "s")])
    assert [r[3] for r in rows(cut(df))] == ["s", "p", "s"]


def test_of_several_changes_at_one_time_only_the_last_counts(spark):
    df = frame(spark, EVENT, [event("01", "s"), event("02", "p", kind="1"), event("02", "q", kind="2")])
    assert [r[3] for r in rows(cut(df, tie_break=["kind"]))] == ["s", "q"]


@pytest.mark.parametrize("seconds", [1, 86_400, 10**9])
def test_input_order_and_slicing_do_not_matter(spark, seconds):
    rng = random.Random(3)
    events = [
        {"id": rng.choice(["a", "a", "a", "b", "c"]), "at": f"2026-01-{d:02d} {h:02d}:{m:02d}:00",
         "segment": rng.choice("st"), "region": rng.choice("ne"), "kind": str(i)}
        for i, (d, h, m) in enumerate((rng.randrange(1, 5), rng.randrange(0, 24), rng.randrange(0, 60)) for _ in range(200))
    ]
    expected = rows(cut(frame(spark, EVENT, events), tie_break=["kind"], seconds=3600))
    rng.shuffle(events)
    assert rows(cut(frame(spark, EVENT, events + events[:40]), tie_break=["kind"], seconds=seconds)) == expected
    # The same history by hand.
    by_hand = []
    for key in "abc":
        latest = {}
        for e in sorted((e for e in events if e["id"] == key), key=lambda e: (e["at"], e["kind"])):
            latest[e["at"]] = e
        runs = []
        for at, e in sorted(latest.items()):
            if runs and (runs[-1][1], runs[-1][2]) == (e["segment"], e["region"]):
                runs[-1][3] = e["kind"]
            else:
                runs.append([at, e["segment"], e["region"], e["kind"]])
        ends = [r[0] for r in runs[1:]] + ["None"]
        by_hand += [(key, r[0], end, r[1], r[2], r[3]) for r, end in zip(runs, ends)]
    assert expected == sorted(by_hand)


def test_scd1_keeps_the_highest_sequence_and_survives_replay(spark):
    ddl = "k STRING, seq INT, v STRING, extra STRING"
    data = [{"k": "a", "seq": "1", "v": "old"}, {"k": "a", "seq": "2", "v": "new"}, {"k": "b", "seq": "1", "v": "x"}]
    once = cdc.scd1(frame(spark, ddl, data), ["k"], "seq", ["extra"])
    again = cdc.scd1(frame(spark, ddl, list(reversed(data)) + data), ["k"], "seq", ["extra"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect())) == [("a", 2, "new"), ("b", 1, "x")]


def test_scd1_ties_are_settled_by_content_not_by_chance(spark):
    data = [{"k": "a", "seq": "1", "v": v} for v in ("p", "r", "q")]
    assert cdc.scd1(frame(spark, "k STRING, seq INT, v STRING", data), ["k"], "seq").first()["v"] == "r"


def dimension(spark):
    events = shape.profile_events(
        profile(spark, {}, {"changed_at": "2026-10-01 00:00:00", "segment": "premium"}, {"customer_id": "CG4072"})
    )
    history = cdc.scd2(events, ["customer_id"], "changed_at", ["segment", "region"], ["_source_file", "_ingested_at"])
    return cdc.scd2_dimension(history)


def test_dimension_has_open_ends_hash_keys_and_the_unknown_member(spark):
    found = {(r["customer_id"], str(r["valid_from"])): r for r in dimension(spark).collect()}
    assert len(found) == 4 and len({r["customer_key"] for r in found.values()}) == 4
    old, new = found["CG4071", "2026-09-20 00:00:00"], found["CG4071", "2026-10-01 00:00:00"]
    assert (str(old["valid_to"]), old["is_current"]) == ("2026-10-01 00:00:00", False)
    assert (str(new["valid_to"]), new["is_current"]) == ("9999-12-31 00:00:00", True)
    assert found["UNKNOWN", "1970-01-01 00:00:00"]["customer_key"] == -1


def integrity(df):
    return tuple(cdc.scd2_integrity(df).first())


def test_integrity_of_a_sound_and_of_damaged_dimensions(spark):
    dim = dimension(spark)
    assert integrity(dim) == (0, 0, 0)
    first = F.col("valid_to") < "2027-01-01"
    gap = dim.withColumn("valid_to", F.when(first, F.lit("2026-09-25").cast("timestamp")).otherwise(F.col("valid_to")))
    assert integrity(gap) == (1, 0, 0)
    inverted = dim.withColumn("valid_to", F.when(first, F.lit("2026-01-01").cast("timestamp")).otherwise(F.col("valid_to")))
    assert integrity(inverted) == (1, 1, 0)
    closed = dim.withColumn("is_current", F.col("is_current") & (F.col("customer_id") != "CG4072"))
    assert integrity(closed) == (0, 0, 1)


def payload(spark, *docs):
    data = [(json.dumps(doc) if not isinstance(doc, str) else doc, at) for doc, at in docs]
    return spark.createDataFrame(data, "payload STRING, at STRING").select("payload", F.col("at").cast("timestamp").alias("_ingested_at"))


def region(*events, name="scotland"):
    return {name: {"division": name, "events": list(events)}}


def day(date, title="New Year", notes="", bunting=True):
    return {"title": title, "date": date, "notes": notes, "bunting": bunting}


def test_the_newest_payload_is_the_truth(spark):
    df = payload(
        spark,
        (region(day("2026-01-01"), day("2026-01-02", "Moved")), "2026-01-01"),
        (region(day("2026-01-01"), day("2026-01-05", "Moved")), "2026-02-01"),
    )
    found = sorted((str(r["holiday_date"]), r["title"]) for r in cdc.snapshot_replace(df).collect())
    assert found == [("2026-01-01", "New Year"), ("2026-01-05", "Moved")]


def test_payloads_of_one_batch_are_merged_and_repeats_collapse(spark):
    df = payload(
        spark,
        (region(day("2026-01-01"), day("2026-01-01")), "2026-02-01"),
        (region(day("2026-01-01"), name="northern-ireland"), "2026-02-01"),
    )
    assert sorted(r["division"] for r in cdc.snapshot_replace(df).collect()) == ["northern-ireland", "scotland"]


def test_an_unknown_region_and_an_empty_title_are_kept_for_the_rules(spark):
    df = payload(spark, (region(day("2026-01-01", ""), name="wonderland"), "2026-02-01"))
    assert [(r["division"], r["title"]) for r in cdc.snapshot_replace(df).collect()] == [("wonderland", "")]


def test_a_malformed_date_in_reference_data_stops_the_run(spark):
    df = payload(spark, (region(day("2026-13-01")), "2026-02-01"))
    with pytest.raises(PySparkException):
        cdc.snapshot_replace(df).collect()
