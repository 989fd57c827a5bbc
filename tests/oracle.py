"""Compare registered queries with their SQL on DuckDB.

Usage: python tests/oracle.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

EXACT = False

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def plain(value):
    """A comparable form that keeps type differences visible only where they matter."""
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        if EXACT:
            return repr(value)
        return f"{value:.9g}" if value else "0"
    if isinstance(value, decimal.Decimal):
        return f"{float(value):.9g}"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        if EXACT:
            return str(value)
        return f"{float(value):.9g}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    if hasattr(value, "asDict"):
        return plain(value.asDict())
    if isinstance(value, dict):
        return "{" + ",".join(f"{k}:{plain(v)}" for k, v in sorted(value.items())) + "}"
    return repr(value)


def canonical(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, query, sql: str | None, sf_dir: str) -> tuple[bool, str]:
    start = time.time()
    df = query(spark, sf_dir)
    rows = [tuple(row) for row in df.collect()]
    seconds = time.time() - start
    note = f"{len(rows)} rows {seconds:.1f}s"
    if sql is None:
        return bool(rows), note + " (no SQL)"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    kinds = {d[0]: str(d[1]) for d in result.description}
    ours = dict(df.dtypes)
    left, right = canonical(df.columns, rows), canonical(columns, expected)
    if left != right:
        ours, theirs = set(left), set(right)
        only_left = [row for row in left if row not in theirs][:3]
        only_right = [row for row in right if row not in ours][:3]
        return False, f"{note}; SQL {len(right)} rows\n   {sorted(df.columns)}\n   spark {only_left}\n   sql   {only_right}"
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}
    odd = {c: (ours[c], kinds[c]) for c in ours if ours[c] in same and same[ours[c]] != kinds[c]}
    return True, note + (f" TYPES {odd}" if odd else "")


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--exact", action="store_true", help="compare doubles bit by bit")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    global EXACT
    EXACT = args.exact
    import __spark_entry__ as contract
    from jobtide.session import build_session

    spark = build_session(
        "oracle", "local[8]", spark__ui__enabled="false", spark__driver__memory="12g", spark__sql__shuffle__partitions="8",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    queries, sql = contract.queries(), contract.oracle_sql()
    bad = []
    for name in args.names or queries:
        try:
            ok, note = compare(spark, con, name, queries[name], sql.get(name), args.sf)
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print("ok  " if ok else "FAIL", name, note, flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(bad)} failed: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
