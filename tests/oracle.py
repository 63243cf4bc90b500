"""Compare registered queries with their DuckDB text, as unordered rows."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return f"{type(v).__name__}:{v}"


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


def compare(con, df, sql: str):
    """None when equal, else a short text on the difference."""
    got_rows = df.collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_rows = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(df.columns)} / {sorted(names)}", len(got_rows)
    got, want = rows_of(df.columns, got_rows), rows_of(names, want_rows)
    if got == want:
        return None, len(got_rows)
    extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
    return (
        f"rows {len(got_rows)} / {len(want_rows)}; columns {sorted(names)}\n  only spark {extra}\n  only duckdb {missing}",
        len(got_rows),
    )


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from cargolens.catalog import ORACLES, QUERIES

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            if name in ORACLES:
                diff, n = compare(con, fn(spark, sf_dir), ORACLES[name])
            else:
                diff, n = None, len(fn(spark, sf_dir).collect())
        except Exception as e:  # noqa: BLE001
            diff, n = f"{type(e).__name__}: {str(e)[:1500]}", -1
        flag = "ok  " if diff is None else "FAIL"
        bad += diff is not None
        print(f"{flag} {name:28s} rows={n:<7} {time.time() - start:6.2f}s {'' if name in ORACLES else '(no oracle)'}")
        if diff:
            print("   ", diff)
    print("failed:", bad)
    spark.stop()
