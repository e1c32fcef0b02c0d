"""Runs registered queries next to their DuckDB twins and compares values."""

from __future__ import annotations

import math
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(canonical(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, fn, sql, sf_dir):
    """(ok, message)."""
    started = time.time()
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - started
    if sql is None:
        return len(got) > 0, f"rows={len(got)} {took:.1f}s no oracle"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns differ: spark {sorted(df.columns)} sql {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a == b:
        return True, f"rows={len(a)} {took:.1f}s"
    diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
    return False, f"rows spark={len(a)} sql={len(b)} {took:.1f}s first diffs: {diff}"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from reviewmill.session import build_session, drop_intermediate

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="16g",
                          spark__ui__showConsoleProgress="false",
                          spark__checkpoint__dir=tempfile.mkdtemp(prefix="harness-"))
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if wanted and not any(w == name or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        try:
            ok, note = compare(spark, con, fn, oracles.get(name), sf_dir)
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not ok
        drop_intermediate(spark)
        print("ok  " if ok else "FAIL", name, note if not ok or len(note) < 200 else note[:200], flush=True)
    print("failed:", bad)
