import json

import pytest
from pyspark.sql import functions as F

from auditlake import constants as K
from auditlake.operators.quality import fingerprint
from auditlake.sources import files, sinks
from auditlake.streaming import runs

DDL = "id INT, amount DECIMAL(18,2), at TIMESTAMP, note STRING"


def land(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def contract(spark, folder, **kw):
    return files.read_contract(spark, str(folder), DDL, timestamp_format=K.PROFILE_TS_FORMAT, tz="UTC", **kw)


HEADER = "id,amount,at,note"


def test_contract_types_values_and_rescues_misfits(spark, tmp_path):
    land(
        tmp_path, "a.csv", HEADER,
        "1,1.010284203E7,2026-10-06T10:30:00Z,ok",
        "x,12.5,06/10/2026,two",
        ",,,",
        "4,1e30,2026-10-06T10:30:00Z,big",
    )
    good, bad, empty, big = contract(spark, tmp_path).orderBy(F.monotonically_increasing_id()).collect()
    assert (good["id"], str(good["amount"]), str(good["at"]), good["_rescued_data"]) == (1, "10102842.03", "2026-10-06 10:30:00", None)
    assert (bad["id"], str(bad["amount"]), bad["at"], bad["note"]) == (None, "12.50", None, "two")
    assert json.loads(bad["_rescued_data"]) == {"id": "x", "at": "06/10/2026"}
    assert empty["_rescued_data"] is None and empty["id"] is None
    assert json.loads(big["_rescued_data"]) == {"amount": "1e30"}


def test_audit_columns_and_name_filter(spark, tmp_path):
    land(tmp_path, "customer_profile_2026-10-05.csv", HEADER, "1,1,,")
    land(tmp_path, "stray.tmp", HEADER, "2,2,,")
    land(tmp_path, "_hidden.csv", HEADER, "3,3,,")
    (row,) = contract(spark, tmp_path).collect()
    assert row["_source_file"].endswith("customer_profile_2026-10-05.csv")
    assert row["_source_modified_at"] is not None and row["_ingested_at"] is not None


def test_a_zone_other_than_utc_is_applied(spark, tmp_path):
    land(tmp_path, "a.csv", HEADER, "1,1,2026-10-06T10:30:00Z,")
    df = files.read_contract(spark, str(tmp_path), DDL, timestamp_format=K.PROFILE_TS_FORMAT, tz="Europe/London")
    assert str(df.first()["at"]) == "2026-10-06 09:30:00"


def test_a_header_that_does_not_match_is_an_error(spark, tmp_path):
    land(tmp_path, "a.csv", "amount,id,at,note", "1,1,,")
    with pytest.raises(Exception, match="does not conform"):
        contract(spark, tmp_path).collect()


def test_files_are_ingested_once_in_any_order(spark, tmp_path):
    landing, target, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        runs.run_available(contract(spark, landing, streaming=True), target, checkpoint)
        return sorted(r["id"] for r in spark.read.parquet(target).collect())

    land(landing, "d_2026-10-06.csv", HEADER, "1,1,,", "2,2,,")
    assert run() == [1, 2]
    assert run() == [1, 2]
    land(landing, "d_2026-10-01.csv", HEADER, "3,3,,")  # an earlier day that arrives late
    land(landing, "part.tmp", HEADER, "9,9,,")
    assert run() == [1, 2, 3]


def test_a_full_refresh_and_the_batch_read_give_the_same_content(spark, tmp_path):
    landing = tmp_path / "in"
    land(landing, "a.csv", HEADER, "1,1.5,2026-10-06T10:30:00Z,x")
    land(landing, "b.csv", HEADER, "z,2,,", "3,,,y")
    columns = ["id", "amount", "at", "note", "_rescued_data", "_source_file"]
    prints = [fingerprint(contract(spark, landing), columns).first()]
    for n in (1, 2):
        target = str(tmp_path / f"out{n}")
        runs.run_available(contract(spark, landing, streaming=True, max_files=1), target, str(tmp_path / f"ck{n}"))
        prints.append(fingerprint(spark.read.parquet(target), columns).first())
    assert prints[0] == prints[1] == prints[2]


HINTS = "event_id STRING, amount DECIMAL(18,2), is_fraud INT"


def lines(*rows):
    return [json.dumps(r) if isinstance(r, dict) else r for r in rows]


def test_new_columns_appear_old_rows_are_null_and_nothing_is_read_twice(spark, tmp_path):
    landing, target, checkpoint = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "ck")

    def run():
        runs.ingest_evolving(spark, str(landing), HINTS, target, checkpoint)
        names = runs.evolved_columns(spark, target, HINTS)
        return {r["event_id"]: r.asDict() for r in runs.read_evolved(spark, target, HINTS, names).collect()}

    land(landing, "transactions_2026-09-27.jsonl", *lines({"event_id": "a", "amount": 12345678901234.56, "is_fraud": 0}))
    assert "channel" not in run()["a"]
    land(landing, "transactions_2026-09-28.jsonl", *lines({"event_id": "b", "channel": "app"}, {"event_id": "c", "device": {"os": "x"}}))
    rows = run()
    assert set(rows) == {"a", "b", "c"} and str(rows["a"]["amount"]) == "12345678901234.56"
    assert (rows["a"]["channel"], rows["b"]["channel"], rows["c"]["device"]) == (None, "app", '{"os":"x"}')
    land(landing, "transactions_2026-09-29.jsonl", *lines({"event_id": "d", "z": 1}))
    assert len(run()) == 4 and len(run()) == 4
    assert runs.evolved_columns(spark, target, HINTS) == ["channel", "device", "z"]


def test_a_type_conflict_is_rescued_not_evolved(spark, tmp_path):
    land(tmp_path, "a.jsonl", *lines({"event_id": "a", "amount": "lots", "is_fraud": 1}, {"event_id": "b", "amount": 5}, "not json"))
    rows = {r["event_id"]: r for r in files.read_evolving(spark, str(tmp_path), HINTS).collect()}
    assert rows["a"]["amount"] is None and json.loads(rows["a"]["_rescued_data"]) == {"amount": "lots"}
    assert rows["a"]["is_fraud"] == 1
    assert (str(rows["b"]["amount"]), rows["b"]["_rescued_data"]) == ("5.00", None)
    assert json.loads(rows[None]["_rescued_data"]) == {"_line": "not json"}


def test_batch_and_stream_reads_of_an_evolving_source_agree(spark, tmp_path):
    landing = tmp_path / "in"
    land(landing, "a.jsonl", *lines({"event_id": "a"}, {"event_id": "b", "channel": "app"}))
    land(landing, "b.jsonl", *lines({"event_id": "c", "device": "d"}))
    target = str(tmp_path / "t")
    runs.ingest_evolving(spark, str(landing), HINTS, target, str(tmp_path / "ck"), max_files=1)
    columns = ["event_id", "amount", "channel", "device"]
    stream = runs.read_evolved(spark, target, HINTS, columns[2:]).select(columns)
    batch = files.read_evolving(spark, str(landing), HINTS, names=columns[2:]).select(columns)
    assert sorted(map(str, stream.collect())) == sorted(map(str, batch.collect()))


def test_payloads_are_kept_whole(spark, tmp_path):
    text = '{\n  "scotland": {}\n}\n'
    (tmp_path / "a.json").write_text(text)
    (tmp_path / "b.tmp").write_text("half")
    (row,) = files.read_payloads(spark, str(tmp_path)).collect()
    assert row["payload"] == text and row["_source_file"].endswith("a.json")


def test_ad_hoc_scans(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"date": "2026-10-06", "defects": {"duplicates": 3}}, indent=2))
    row = files.scan_files(spark, str(tmp_path / "m.json"), "json", multiLine=True).first()
    assert (row["defects"]["duplicates"], row["file_path"].endswith("m.json")) == (3, True)
    land(tmp_path / "c", "h.csv", "id,amount", "1,1.010284203E7")
    text = files.scan_files(spark, str(tmp_path / "c"), "csv", header=True).first()
    assert text["amount"] == "1.010284203E7"


def test_clustered_layout_touches_fewer_files_even_with_one_hot_value(spark, tmp_path):
    df = spark.range(20000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("int").alias("day"), (F.col("id") % 5).cast("int").alias("kind")
    )
    plain, clustered = str(tmp_path / "plain"), str(tmp_path / "clustered")
    df.repartition(8).write.parquet(plain)
    sinks.write_clustered(df, clustered, ["day", "kind"], ["id"], files=8)
    a, b = (sinks.layout_report(spark, p, "day = 20 AND kind = 0").first() for p in (plain, clustered))
    assert a["row_count"] == b["row_count"] > 0 and b["files_touched"] == 1 < a["files_touched"]
    per_file = spark.read.parquet(clustered).groupBy(F.col("_metadata.file_path")).count().collect()
    assert max(r["count"] for r in per_file) < 20000 / 3
