import pyarrow.parquet as pq
import pytest
from builders import frame
from pyspark.sql import functions as F

from auditlake.streaming import pinned

ROW = "id INT, day STRING"
SIDE = "day STRING, title STRING"


@pytest.fixture
def table(spark, tmp_path):
    landing, root, target = (str(tmp_path / n) for n in ("in", "side", "t"))
    (tmp_path / "in").mkdir()
    rows = frame(spark, ROW, [{"id": "1"}]).schema
    side = frame(spark, SIDE, [{"day": "x"}]).schema
    name = F.col("_metadata.file_path").alias("file")
    stream = spark.readStream.schema(rows).option("maxFilesPerTrigger", 1).parquet(landing).select("*", name)

    def land(file, *given):
        pq.write_table(frame(spark, ROW, [dict(zip(("id", "day"), g)) for g in given]).toArrow(), f"{landing}/{file}.parquet")

    def publish(*days):
        return pinned.publish_side(frame(spark, SIDE, [{"day": d, "title": d} for d in days]), root)

    def run(checkpoint="ck"):
        pinned.flag_stream(stream, root, side, "day", "day", "free", target, str(tmp_path / checkpoint), "file")

    def stored():
        found = pinned.read_flagged(spark, target, stream.schema, "free").collect()
        return {r["id"]: (r["free"], r["side_version"]) for r in found}

    def again():
        source = spark.read.schema(rows).parquet(landing).select("*", name)
        found = pinned.replay(source, root, side, "day", "day", "free", target, "file").collect()
        assert len(found) == source.count()
        return {r["id"]: (r["free"], r["side_version"]) for r in found}

    return land, publish, run, stored, again


def test_a_later_holiday_changes_no_stored_flag_and_replay_agrees(table):
    land, publish, run, stored, again = table
    land("a", ("1", "mon"), ("2", "tue"), ("3", None))
    run()  # no version yet
    assert publish("mon", "mon", None) == 1
    land("b", ("4", "mon"), ("5", "tue"))
    run()
    assert publish("mon", "tue") == 2
    land("c", ("6", "mon"), ("7", "tue"), ("8", "wed"))
    run()
    expected = {
        1: (False, 0), 2: (False, 0), 3: (False, 0), 4: (True, 1), 5: (False, 1), 6: (True, 2), 7: (True, 2), 8: (False, 2),
    }
    assert stored() == expected == again()
    publish("wed")
    land("d", ("9", "wed"))  # not taken yet
    assert again() == {**expected, 9: (True, 3)} and stored() == expected


def test_a_retried_batch_takes_the_version_it_had_settled_on(table, monkeypatch):
    land, publish, run, stored, again = table
    publish("mon")
    land("a", ("1", "mon"), ("2", "tue"))
    whole = pinned.with_match

    def lost(*args, **kw):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(pinned, "with_match", lost)
    with pytest.raises(Exception, match="executor lost"):
        run()
    monkeypatch.setattr(pinned, "with_match", whole)
    publish("tue")
    run()
    assert stored() == {1: (True, 1), 2: (False, 1)} == again()


def test_a_side_without_versions_and_a_version_without_rows(spark, table, tmp_path):
    schema = frame(spark, SIDE, [{"day": "x"}]).schema
    root = str(tmp_path / "other")
    assert pinned.read_side(spark, root, schema).count() == 0
    assert pinned.publish_side(spark.createDataFrame([], schema), root) == 1
    assert pinned.read_side(spark, root, schema, 1).count() == 0
    with pytest.raises(ValueError, match="no version 2"):
        pinned.read_side(spark, root, schema, 2)
