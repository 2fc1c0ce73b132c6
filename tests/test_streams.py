import random

import pytest
from builders import feed, frame
from builders import history as paid
from pyspark.sql import functions as F

from auditlake.operators import cdc, joins, shape
from auditlake.streaming import runs

EVENT = "id STRING, at TIMESTAMP, segment STRING, region STRING, n INT"


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(5)
    rows = [
        {"id": rng.choice("aab"), "at": f"2026-01-{rng.randrange(1, 9):02d} {rng.randrange(0, 24):02d}:00:00",
         "segment": rng.choice("st"), "region": rng.choice("ne"), "n": str(i)}
        for i in range(90)
    ]
    return frame(spark, EVENT, rows)


def landed(df, folder, parts=5):
    path = str(folder / "in")
    df.withColumn("_p", F.col("n") % parts).repartition(parts, "_p").drop("_p").write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path), path


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))


def test_scd1_stream_equals_batch_under_replay(spark, events, tmp_path):
    stream, _ = landed(events, tmp_path)
    target = str(tmp_path / "t")
    runs.scd1_stream(stream, ["id"], "at", target, str(tmp_path / "ck"))
    runs.scd1_stream(stream, ["id"], "at", target, str(tmp_path / "ck"))  # nothing new
    runs.scd1_stream(stream, ["id"], "at", target, str(tmp_path / "ck2"))  # everything again
    now = runs.scd1_current(spark, target, events.schema, ["id"], "at", ["region"])
    same(cdc.scd1(events, ["id"], "at").drop("region"), now)


def test_compacted_winners_are_the_winners(spark, events, tmp_path):
    stream, path = landed(events, tmp_path)
    target, checkpoint = str(tmp_path / "t"), str(tmp_path / "ck")
    runs.scd1_stream(stream, ["id"], "at", target, checkpoint)
    folded = runs.scd1_compact(spark, target, str(tmp_path / "t2"), events.schema, ["id"], "at")
    assert spark.read.parquet(folded).count() == events.select("id").distinct().count()
    late = frame(spark, EVENT, [{"id": "a", "at": "2027-01-01 00:00:00", "segment": "z", "region": "n", "n": "999"}])
    late.write.mode("append").parquet(path)
    runs.scd1_stream(stream, ["id"], "at", folded, checkpoint)  # the stream goes on in the new target
    same(cdc.scd1(events.unionByName(late), ["id"], "at"), runs.scd1_current(spark, folded, events.schema, ["id"], "at"))


VERSIONS = (["id"], "at", ["segment", "region"])


def history(spark, target, events, cut=runs.scd2_current, **more):
    return cut(spark, target, events.schema, *VERSIONS, tie_break=["n"], **more)


def test_scd2_stream_equals_batch_with_null_keys_in_any_order(spark, events, tmp_path):
    keyless = events.unionByName(events.where("n < 30").withColumn("id", F.lit(None).cast("string")))
    stream, _ = landed(keyless, tmp_path)
    target = str(tmp_path / "t")
    runs.scd2_stream(stream, *VERSIONS, target, str(tmp_path / "ck"), ["n"])
    now = history(spark, target, events)
    assert now.where("id IS NULL").count() > 1
    same(cdc.scd2(keyless, *VERSIONS, tie_break=["n"]), now)


def test_a_late_change_recuts_its_own_key(spark, events, tmp_path):
    stream, path = landed(events, tmp_path)
    target, checkpoint = str(tmp_path / "t"), str(tmp_path / "ck")
    runs.scd2_stream(stream, *VERSIONS, target, checkpoint, ["n"])
    newest = runs.scd2_log(spark, target, events.schema).agg(F.max("batch_id")).first()[0]
    late = frame(spark, EVENT, [{"id": "b", "at": "2026-01-01 00:30:00", "segment": "z", "region": "n", "n": "999"}])
    late.write.mode("append").parquet(path)
    runs.scd2_stream(stream, *VERSIONS, target, checkpoint, ["n"])
    whole = cdc.scd2(events.unionByName(late), *VERSIONS, tie_break=["n"])
    same(whole, history(spark, target, events))
    same(whole.where("id = 'b'"), history(spark, target, events, runs.scd2_touched, since=newest + 1))


def test_a_compacted_log_gives_the_same_history(spark, events, tmp_path):
    stream, _ = landed(events.unionByName(events), tmp_path)
    target = str(tmp_path / "t")
    runs.scd2_stream(stream, *VERSIONS, target, str(tmp_path / "ck"), ["n"])
    folded = runs.scd2_compact(spark, target, str(tmp_path / "t2"), events.schema, ["id"], "at", ["n"])
    assert runs.scd2_log(spark, folded, events.schema).count() <= events.count()
    same(cdc.scd2(events, *VERSIONS, tie_break=["n"]), history(spark, folded, events))


def test_two_flows_split_into_two_sinks(spark, tmp_path):
    feed(spark, {"event_id": "ok"}, {"event_id": "bad", "amount": "-1"}).write.parquet(str(tmp_path / "f"))
    paid(spark, {}, {"type": "X"}).write.parquet(str(tmp_path / "h"))
    read = lambda name: spark.readStream.schema(spark.read.parquet(str(tmp_path / name)).schema).parquet(str(tmp_path / name))
    flows = shape.unify([shape.map_feed(read("f")), shape.map_history(read("h"))])
    clean, rejected, checkpoint = (str(tmp_path / n) for n in ("clean", "rejected", "ck"))
    for _ in range(2):
        runs.split_stream(flows, clean, rejected, checkpoint)
    kept = runs.read_batches(spark, clean).select("source_system").collect()
    put_aside = runs.read_batches(spark, rejected).collect()
    assert sorted(r[0] for r in kept) == ["generator-v1", "paysim"]
    assert sorted(r["failed_checks"][0] for r in put_aside) == ["NEGATIVE_AMOUNT", "UNKNOWN_TYPE"]


def test_a_holiday_added_later_is_not_retroactive_in_the_stream(spark, tmp_path):
    day = {"event_ts": "2026-08-31T12:00:00Z"}
    landing, names = str(tmp_path / "in"), str(tmp_path / "names")
    from builders import holidays

    feed(spark, {"event_id": "early", **day}).write.parquet(landing)
    holidays(spark, {"holiday_date": "2026-12-25"}).write.parquet(names)
    stream = spark.readStream.schema(spark.read.parquet(landing).schema).parquet(landing)

    def run():
        static = spark.read.parquet(names)
        flagged = joins.with_holiday_flag(shape.unify([shape.map_feed(stream)]), static)
        runs.run_available(flagged, str(tmp_path / "out"), str(tmp_path / "ck"))
        return {r["event_id"]: r["is_bank_holiday"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}

    assert run() == {"early": False}
    holidays(spark, {}).write.mode("append").parquet(names)
    feed(spark, {"event_id": "later", **day}).write.mode("append").parquet(landing)
    assert run() == {"early": False, "later": True}


def test_layers_chain_through_streams(spark, tmp_path):
    feed(spark, {"event_id": "a"}, {"event_id": "b", "type": "X"}).write.parquet(str(tmp_path / "raw"))
    raw = spark.readStream.schema(spark.read.parquet(str(tmp_path / "raw")).schema).parquet(str(tmp_path / "raw"))
    unified = str(tmp_path / "unified")
    runs.run_available(shape.unify([shape.map_feed(raw)]), unified, str(tmp_path / "ck1"))
    second = spark.readStream.schema(spark.read.parquet(unified).schema).parquet(unified)
    runs.run_available(shape.split_valid(second), str(tmp_path / "clean"), str(tmp_path / "ck2"))
    assert [r["event_id"] for r in spark.read.parquet(str(tmp_path / "clean")).collect()] == ["a"]
