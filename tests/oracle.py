"""Compares registered queries with their SQL checks: ``python tests/oracle.py [sf] [prefix ...]``."""

from __future__ import annotations

import math
import pathlib
import sys
import time
from collections import Counter

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

DATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def kind(value):
    if value is None:
        return None
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    if isinstance(value, list):
        return tuple(kind(v) for v in value)
    return value


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns {sorted(spark_cols)} != {sorted(duck_cols)}"
    s_at = [spark_cols.index(c) for c in sorted(spark_cols)]
    d_at = [duck_cols.index(c) for c in sorted(duck_cols)]
    left = Counter(tuple(kind(row[i]) for i in s_at) for row in spark_rows)
    right = Counter(tuple(kind(row[i]) for i in d_at) for row in duck_rows)
    if sum(left.values()) != sum(right.values()):
        return f"rows {sum(left.values())} != {sum(right.values())}; e.g. {list((left - right))[:2]} {list((right - left))[:2]}"
    if left != right:
        return f"{sum((left - right).values())} rows differ, e.g. {list((left - right))[:2]} | {list((right - left))[:2]}"
    types = {type(v) for row in left for v in row if v is not None}
    other = {type(v) for row in right for v in row if v is not None}
    return "" if types == other else f"value types {types} != {other}"


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def check(spark, key, fn, sql, folder):
    started = time.time()
    df = fn(spark, folder)
    rows = df.collect()
    took = time.time() - started
    if not sql:
        return took, len(rows), "" if rows else "no rows"
    cur = duck(folder).execute(sql)
    names = [d[0] for d in cur.description]
    return took, len(rows), compare(rows, df.columns, cur.fetchall(), names)


def main():
    from __spark_entry__ import oracle_sql, queries
    from millrace.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("OFF")
    checks, bad, total = oracle_sql(), 0, 0.0
    for key, fn in queries().items():
        if wanted and not any(key == w or key.startswith(w) for w in wanted):
            continue
        try:
            took, n, fault = check(spark, key, fn, checks.get(key), f"{DATA}/{sf}")
        except Exception as error:  # the report goes on with the next query
            took, n, fault = 0.0, 0, f"{type(error).__name__}: " + " ".join(str(error).split())[:1500]
        total += took
        bad += bool(fault)
        state = "FAIL" if fault else ("ok" if key in checks else "ran")
        print(f"{state:4} {key:40} {n:7} rows {took:6.2f}s {fault}", flush=True)
    print(f"{bad} failed, {total:.1f}s")


if __name__ == "__main__":
    main()
