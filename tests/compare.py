"""Run registered queries in Spark and their oracle SQL in DuckDB, compare.

Usage: python tests/compare.py [sf_dir] [name ...]
Prints one line per query: rows, schema and an order-insensitive value hash.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def frame_digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def duck(sf_dir: str, sql: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from pyspark.sql import SparkSession

    import __spark_entry__ as E

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        t1 = time.time()
        if name not in oracle:
            print(f"{name:32s} spark rows={len(srows)} (no oracle) {t1 - t0:.1f}s")
            continue
        ocols, orows = duck(sf_dir, oracle[name])
        ok_cols = sorted(scols) == sorted(ocols)
        ok_rows = len(srows) == len(orows)
        sd, od = frame_digest(scols, srows), frame_digest(ocols, orows)
        ok = ok_cols and ok_rows and sd == od
        bad += not ok
        print(
            f"{name:32s} {'OK ' if ok else 'BAD'} rows {len(srows)}/{len(orows)} "
            f"cols {'=' if ok_cols else sorted(set(scols) ^ set(ocols))} hash {sd}/{od} {t1 - t0:.1f}s"
        )
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv))
