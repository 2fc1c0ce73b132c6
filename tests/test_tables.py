"""Rebuilding layers into folders of their own."""

from builders import feed

from auditlake.operators import shape
from auditlake.streaming import runs


def test_a_rebuild_starts_from_nothing_and_leaves_the_old_one(spark, tmp_path):
    feed(spark, {"event_id": "a"}, {"event_id": "b", "type": "X"}).write.parquet(str(tmp_path / "raw"))
    schema = spark.read.parquet(str(tmp_path / "raw")).schema

    def unified(before, target, checkpoint):
        assert before == {}
        raw = spark.readStream.schema(schema).parquet(str(tmp_path / "raw"))
        runs.run_available(shape.unify([shape.map_feed(raw)]), target, checkpoint)

    def clean(before, target, checkpoint):
        flow = spark.readStream.schema(spark.read.parquet(before["unified"]).schema).parquet(before["unified"])
        runs.run_available(shape.split_valid(flow), target, checkpoint)

    first, second = (runs.rebuild(spark, str(tmp_path / "out"), {"unified": unified, "clean": clean}) for _ in range(2))
    assert first["clean"] != second["clean"]
    for folders in (first, second):
        assert [r["event_id"] for r in spark.read.parquet(folders["clean"]).collect()] == ["a"]
        assert spark.read.parquet(folders["unified"]).count() == 2
