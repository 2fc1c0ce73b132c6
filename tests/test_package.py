"""Facts that several modules must agree on, and habits the package keeps."""

import re
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from auditlake import constants as K
from auditlake.operators import suites
from auditlake.operators.rules import LAST_DAY, expectations
from auditlake.plans.queries import audit_tables, bound_known
from auditlake.plans.world import World
from auditlake.session import scratch_dir

PACKAGE = Path(__file__).resolve().parents[1] / "auditlake"


def test_nothing_else_imports_the_text_operators():
    for path in PACKAGE.rglob("*.py"):
        if PACKAGE / "llm" not in path.parents:
            assert "auditlake.llm" not in path.read_text(), path


def test_one_list_of_types_everywhere():
    named = {row[1] for row in K.TYPE_ROWS}
    rule = next(e for e in expectations("silver.transactions") if e.name == "known_type")
    assert named == set(K.TXN_TYPES) == set(re.findall(r"'([A-Z_]+)'", rule.condition))


def test_one_last_day_everywhere():
    assert K.CALENDAR_END == LAST_DAY


def test_bands_have_one_label_each():
    assert len(K.BAND_LABELS) == len(K.BAND_EDGES) + 1


def test_contracts_are_valid_schemas(spark):
    for ddl in (K.FEED_DDL, K.HISTORY_DDL, K.PROFILE_DDL, K.UNIFIED_DDL, K.CHECK_RESULTS_DDL, K.EXPECTATION_RESULTS_DDL):
        assert StructType.fromDDL(ddl).fields


def test_no_python_row_functions_and_no_local_checkpoints():
    # The text operators work in numpy inside tasks; everything else is DataFrame functions.
    own = [p for p in PACKAGE.rglob("*.py") if PACKAGE / "llm" not in p.parents]
    text = "\n".join(p.read_text() for p in own)
    for word in ("udf(", "applyInPandas", "mapInPandas", ".rdd", "localCheckpoint", "crossJoin", ".toPandas("):
        assert word not in text, word


def test_all_checks_are_stated_and_pass_on_the_bound_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = suites.run_checks(audit_tables(World(spark, sf, staged=True)), bound_known(spark, sf)).collect()
    assert [(r["check_name"], r["expected"], r["actual"]) for r in rows if not r["passed"]] == []
    names = [(r["suite"], r["check_name"]) for r in rows]
    assert len(names) == len(set(names)) == 67
    per_suite = {s: sum(n[0] == s for n in names) for s in suites.SUITES}
    assert per_suite == {"bronze_reconciliation": 19, "silver_reconciliation": 26, "gold_reconciliation": 22}


def test_default_figures_appear_in_the_check_names(spark):
    known = suites.Known()
    row = known.figures(spark).first()
    assert (row["known_history_rows"], row["known_history_drain"]) == (6362620, 8018)


def fake_session(master, folder):
    conf = SimpleNamespace(get=lambda key, default=None: folder if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_follows_the_session_setting():
    session = fake_session("yarn", "hdfs://shared/tmp/")
    a, b = scratch_dir(session, "x"), scratch_dir(session, "x")
    assert a != b and a.startswith("hdfs://shared/tmp/x-")


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(fake_session("yarn", None), "x")
    assert scratch_dir(fake_session("local[2]", None), "x")


def test_the_wide_fact_is_not_shuffled_by_key_for_the_burst_rule(spark):
    """Crowded moments come from transfers alone, aggregated before their shuffle."""
    from auditlake.operators.keyed import crowded_points

    df = spark.range(10).select(F.lit("a").alias("k"), F.current_timestamp().alias("ts"), F.lit("x").alias("wide"), F.lit(True).alias("c"))
    plan = crowded_points(df, "k", "ts", F.col("c"), 60, 60, 2)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "wide" not in plan.split("Exchange")[-1].split("\n")[0]
