import pyarrow.parquet as pq
import pytest
from builders import frame
from pyspark.sql import functions as F

from auditlake.operators.quality import DROP, FAIL, WARN, Expectation
from auditlake.streaming import gated

ROW = "id INT, amount DECIMAL(18,2), kind STRING"
RULES = [
    Expectation("positive", "amount > 0", DROP),
    Expectation("named", "kind IS NOT NULL", WARN),
    Expectation("has_id", "id IS NOT NULL", FAIL),
]


def rows(spark, *given):
    return frame(spark, ROW, [dict(zip(("id", "amount", "kind"), r)) for r in given])


@pytest.fixture
def table(spark, tmp_path):
    landing, target = str(tmp_path / "in"), str(tmp_path / "t")
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(rows(spark).schema).option("maxFilesPerTrigger", 1).parquet(landing)

    def land(name, *given):
        pq.write_table(rows(spark, *given).toArrow(), f"{landing}/{name}.parquet")

    def run():
        gated.expect_stream(stream, RULES, "t", target, str(tmp_path / "ck"))

    def seen():
        return sorted(r["id"] for r in gated.read_published(spark, target, rows(spark).schema).collect())

    def counts():
        found = gated.batch_metrics(spark, target).where("published").groupBy("expectation")
        return {r["expectation"]: (r["p"], r["f"]) for r in found.agg(F.sum("passed_records").alias("p"), F.sum("failed_records").alias("f")).collect()}

    return land, run, seen, counts, target


def test_rules_are_counted_and_applied_once_per_batch(spark, table):
    land, run, seen, counts, target = table
    land("a", ("1", "5", "x"), ("2", "-1", "x"), ("3", None, None))
    run()
    land("b", ("4", "5", None), ("5", "6", "x"))
    run()
    run()  # nothing new
    assert seen() == [1, 4, 5]
    assert counts() == {"positive": (3, 2), "named": (3, 2), "has_id": (5, 0)}
    assert gated.batch_metrics(spark, target).select("batch_id").distinct().count() == 2


def test_a_bad_batch_stops_the_stream_and_nothing_is_lost_after_repair(spark, table):
    land, run, seen, counts, target = table
    land("a", ("1", "5", "x"))
    run()
    land("b", ("2", "5", "x"), (None, "7", "x"))
    with pytest.raises(Exception, match="has_id"):
        run()
    land("c", ("3", "8", "x"))
    with pytest.raises(Exception, match="has_id"):  # the bad batch comes first, again and again
        run()
    assert seen() == [1] and counts()["has_id"] == (1, 0)
    stopped = gated.batch_metrics(spark, target).where("NOT published AND expectation = 'has_id'").collect()
    assert [(r["passed_records"], r["failed_records"]) for r in stopped] == [(1, 1)]
    land("b", ("2", "5", "x"), ("9", "7", "x"))  # the file is mended where it lies; the batch is the same one
    run()
    assert seen() == [1, 2, 3, 9]
    assert counts() == {"positive": (4, 0), "named": (4, 0), "has_id": (4, 0)}


def test_a_stream_without_batches_publishes_nothing(spark, tmp_path):
    assert gated.read_published(spark, str(tmp_path / "none"), rows(spark).schema).count() == 0
