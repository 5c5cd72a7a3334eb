"""Side-by-side check of every registered query: Spark result against DuckDB result."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


def norm(v: object) -> str:
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, Decimal)):
        return f"{float(v):.6f}".rstrip("0").rstrip(".").replace("-0", "0") if float(v) == 0 else f"{float(v):.9g}"
    if isinstance(v, datetime):
        return v.isoformat()
    if isinstance(v, date):
        return v.isoformat()
    return str(v)


def rows_of(columns: list[str], data: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in data)


def compare(spark, con, name: str, query, sql: str | None, sf: str) -> tuple[str, str]:
    t0 = time.time()
    df = query(spark, sf)
    got = df.collect()
    took = time.time() - t0
    if sql is None:
        return ("ROWS", f"{len(got)} rows, {took:.1f}s")
    t0 = time.time()
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    want = cur.fetchall()
    duck = time.time() - t0
    info = f"{len(got)} rows, spark {took:.1f}s, duckdb {duck:.1f}s"
    if sorted(cols) != sorted(df.columns):
        return ("FAIL", f"columns differ: spark-only {sorted(set(df.columns) - set(cols))}, sql-only {sorted(set(cols) - set(df.columns))}")
    a, b = rows_of(df.columns, [tuple(r) for r in got]), rows_of(cols, want)
    if a == b:
        return ("OK" if got else "EMPTY", info)
    names = sorted(cols)
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    detail = f"{info}; sql {len(want)} rows"
    for x, y in list(zip(only_a, only_b))[:2]:
        detail += "\n     " + "; ".join(f"{n}: {p} | {q}" for n, p, q in zip(names, x, y) if p != q)[:600]
    if only_a and not only_b:
        detail += f"\n     spark-only {dict(zip(names, only_a[0]))}"[:600]
    if only_b and not only_a:
        detail += f"\n     sql-only {dict(zip(names, only_b[0]))}"[:600]
    return ("FAIL", detail)


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from tideline.session import build_session

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = set(argv[1:])
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if wanted and name not in wanted:
            continue
        try:
            state, info = compare(spark, con, name, query, oracle.get(name), sf)
        except Exception as e:  # report and go on with the next query
            state, info = "ERROR", f"{type(e).__name__}: {str(e)[:700]}"
        bad += state in ("FAIL", "ERROR")
        print(f"{state:6} {name:26} {info}", flush=True)
    print(f"{bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
