"""Compare a registered query with its SQL in DuckDB, row by row, without regard to order."""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    return float(value) if isinstance(value, Decimal) else value


def _key(row):
    return tuple((v is not None, type(v).__name__, str(v)) for v in row)


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=_key)


def differences(spark_df, con, sql: str) -> list[str]:
    """Messages about what differs; empty when the results are equal."""
    names, mine = rows_by_name(spark_df.columns, spark_df.collect())
    result = con.execute(sql)
    their_names, theirs = rows_by_name([c[0] for c in result.description], result.fetchall())
    if names != their_names:
        return [f"columns {names} <> {their_names}"]
    found = [] if len(mine) == len(theirs) else [f"rows {len(mine)} <> {len(theirs)}"]
    # Counted, so that a row too often on one side shows.
    my_rows, their_rows = Counter(mine), Counter(theirs)
    for label, rows in (("only in Spark", my_rows - their_rows), ("only in SQL", their_rows - my_rows)):
        if rows:
            found.append(f"{rows.total()} {label}: {[dict(zip(names, r)) for r in sorted(rows, key=_key)[:2]]}")
    if not found:
        types = [{type(v) for v in col if v is not None} for col in zip(*mine)]
        their_types = [{type(v) for v in col if v is not None} for col in zip(*theirs)]
        if types != their_types:
            found.append(f"value types differ: {[(n, a, b) for n, a, b in zip(names, types, their_types) if a != b]}")
    return found


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from auditlake.session import build_session

    sf_dir = sys.argv[1]
    session = build_session(
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g", "spark.log.level": "ERROR"},
    )
    con, sqls = connect(sf_dir), oracle_sql()
    bad = 0
    for name, run in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            df = run(session, sf_dir)
            found = differences(df, con, sqls[name]) if name in sqls else [f"no SQL; {df.count()} rows"]
        except Exception as error:  # noqa: BLE001
            found = [f"ERROR {str(error)[:1500]}"]
        bad += bool(found) and name in sqls
        print(f"{'ok ' if not found else 'BAD'} {name} {time.time() - began:.1f}s {found or ''}", flush=True)
    print("mismatches:", bad)
