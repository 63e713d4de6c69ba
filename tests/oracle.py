"""Runs a registered query in Spark and its SQL in DuckDB, and compares the results."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from workload.registry import ORACLE, SPARK  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


SECONDS: dict[str, float] = {}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _kind(t: pa.DataType) -> str:
    if pa.types.is_large_string(t) or pa.types.is_string(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp"
    return str(t).replace("decimal128", "decimal")


def _rows(t: pa.Table) -> list[str]:
    names = sorted(t.column_names)
    return sorted(repr(r) for r in zip(*(t.column(n).to_pylist() for n in names))) if names else []


def differences(spark, con, name: str, folder: str) -> list[str]:
    """Empty when both agree on columns, types, row count and values."""
    start = time.time()
    got = SPARK[name](spark, folder).toArrow()
    SECONDS[name] = time.time() - start
    want = con.sql(ORACLE[name]).to_arrow_table()
    found = []
    if sorted(got.column_names) != sorted(want.column_names):
        return [f"columns {sorted(got.column_names)} != {sorted(want.column_names)}"]
    for n in sorted(got.column_names):
        a, b = _kind(got.schema.field(n).type), _kind(want.schema.field(n).type)
        if a != b:
            found.append(f"type of {n}: {a} != {b}")
    if got.num_rows != want.num_rows:
        found.append(f"rows {got.num_rows} != {want.num_rows}")
    if got.num_rows == 0:
        found.append("empty result")
    a, b = _rows(got), _rows(want)
    if a != b:
        left, right = set(a) - set(b), set(b) - set(a)
        found.append(f"values: {len(left)} only here, e.g. {sorted(left)[:2]}; {len(right)} only there, "
                     f"e.g. {sorted(right)[:2]}")
    return found


if __name__ == "__main__":
    import workload.all_queries  # noqa: F401
    from ledgerloom.session import local_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    session, connection = local_session("8"), duck(folder)
    bad = 0
    for query in [q for q in SPARK if not wanted or any(w in q for w in wanted)]:
        start = time.time()
        try:
            if query in ORACLE:
                diff = differences(session, connection, query, folder)
            else:
                diff = [] if SPARK[query](session, folder).count() else ["empty result"]
        except Exception as error:  # noqa: BLE001
            diff = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {query} {time.time() - start:.1f}s, Spark {SECONDS.get(query, 0):.1f}s", *diff, sep="\n     ", flush=True)
    print("failed:", bad)
