import pytest
from builders import frame

from auditlake.streaming import flows

DDL = "id INT, kind STRING, amount DECIMAL(18,2)"


@pytest.fixture
def table(spark, tmp_path):
    def land(name, ddl, *rows):
        frame(spark, ddl, [dict(zip([c.split()[0] for c in ddl.split(", ")], r)) for r in rows]).write.mode("append").parquet(str(tmp_path / name))

    def stream(name):
        path = str(tmp_path / name)
        return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)

    def run(*names):
        flows.run_flows({n: stream(n) for n in names}, DDL, str(tmp_path / "t"), str(tmp_path / "ck"))

    def seen():
        rows = flows.read_flows(spark, str(tmp_path / "t"), DDL).collect()
        return sorted((r["flow"], r["batch_id"], r["id"], r["kind"]) for r in rows)

    return land, run, seen


def test_a_flow_added_later_takes_in_only_itself(spark, table):
    land, run, seen = table
    assert seen() == []
    land("one", "kind STRING, id INT", ("a", "1"))  # by name, not by place
    land("two", "id INT, kind STRING", ("2", "b"))
    run("one", "two")
    land("one", "kind STRING, id INT", ("c", "3"))
    land("three", "id SMALLINT, kind STRING", ("4", "d"), ("5", "e"))
    run("one", "two", "three")
    assert seen() == [("one", 0, 1, "a"), ("one", 1, 3, "c"), ("three", 0, 4, "d"), ("three", 0, 5, "e"), ("two", 0, 2, "b")]
    run("three")
    assert len(seen()) == 5


def test_columns_that_the_table_lacks_are_refused_and_a_failing_flow_stops_alone(spark, table, tmp_path):
    land, run, seen = table
    land("wide", "id INT, extra STRING", ("1", "x"))
    with pytest.raises(ValueError, match="extra"):
        run("wide")
    with pytest.raises(ValueError, match="folder"):
        flows.run_flows({"a/b": spark.readStream.format("rate").load()}, DDL, str(tmp_path / "t"), str(tmp_path / "ck"))
    land("good", "id INT, kind STRING", ("1", "x"))
    land("bad", "id STRING, kind STRING", ("no number", "x"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run("bad", "good")
    assert seen() == [("good", 0, 1, "x")]
