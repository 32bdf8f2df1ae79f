"""Run registered queries next to their DuckDB twins and compare the results.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(_plain(row[i]) for i in order) for row in rows]
    key = [tuple((v is None, round(v, 6) if isinstance(v, float) else str(v)) for v in r) for r in body]
    return [columns[i] for i in order], [r for _, r in sorted(zip(key, body), key=lambda p: repr(p[0]))]


def _same(a, b):
    if isinstance(a, float) or isinstance(b, float):
        if a is None or b is None:
            return a is b
        return a == b or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return a == b


def difference(spark_rows, spark_cols, duck_rows, duck_cols):
    """None when equal, else a short description."""
    cols_a, a = table(spark_cols, spark_rows)
    cols_b, b = table(duck_cols, duck_rows)
    if cols_a != cols_b:
        return f"columns {cols_a} / {cols_b}"
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    inexact = 0
    for left, right in zip(a, b):
        if not all(_same(x, y) for x, y in zip(left, right)):
            return f"{dict(zip(cols_a, left))} / {dict(zip(cols_b, right))}"
        if any(type(x) is not type(y) for x, y in zip(left, right)):
            return f"types {left} / {right}"
        inexact += left != right
    return f"{inexact} rows differ in the last digits" if inexact else None


def check(spark, con, sf_dir, name, function, twin):
    df = function(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if twin is None:
        return len(rows), None if rows else "no rows"
    cursor = con.execute(twin)
    columns = [d[0] for d in cursor.description]
    return len(rows), difference(rows, df.columns, cursor.fetchall(), columns)


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tillstream import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = session.build("compare", "local[8]", 8, {"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, twins, bad = oracle(sf_dir), entry.oracle_sql(), 0
    for name, function in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            rows, problem = check(spark, con, sf_dir, name, function, twins.get(name))
        except Exception as error:  # one broken query must not hide the others
            rows, problem = 0, f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        kind = "sql " if name in twins else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {name:32} {rows:8} rows "
              f"{time.time() - start:6.2f} s  {problem or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
