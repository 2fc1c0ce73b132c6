"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from auditlake.plans.queries import QUERIES
from auditlake.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")

# One or more per operator family.
HEADLINES = (
    "kpi_daily",
    "kpi_by_type",
    "rule_effectiveness",
    "unusual_activity",
    "count_within",
    "unify_sources",
    "quarantine",
    "scd1_lineitem",
    "scd2_orders_profile",
    "pit_join_lineitem",
    "pit_join_linear",
    "fact_transactions",
    "asof_recompute",
    "scd2_integrity",
    "snapshot_replace",
    "read_contract",
    "read_evolving_stream",
    "scd1_stream",
    "scd2_stream",
    "control_totals",
    "check_suites",
    "expectations_report",
    "fingerprint",
    "validate_payloads",
    "scan_lines",
    "profile_counts",
    "clustered_layout",
    "star_metrics_sender",
)


def main() -> None:
    spark = build_session(
        f"local[{CPUS}]",
        "auditlake-bench",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.log.level": "ERROR",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="auditlake-bench-"),
        },
    )
    names = [n for n in HEADLINES if len(sys.argv) < 2 or n in sys.argv[1:]]
    # Start-up and code generation are not part of any query's time.
    QUERIES["kpi_by_type"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        began = time.perf_counter()
        # Every column of every row is computed and handed to a sink that drops it.
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
