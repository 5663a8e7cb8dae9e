"""Compare registered queries with their SQL twins in an in-process DuckDB.

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .appName("tallyhouse-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return ("f", f"{v:.9g}")
    return (type(v).__name__, v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark: SparkSession, con, query, sf_dir: str) -> tuple[bool, str]:
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if query.sql is None:
        return len(got) > 0, f"{len(got)} rows (rows only)"
    cur = con.execute(query.oracle())
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        lack = [r for r in want if r not in set(got)][:2]
        return False, f"{len(got)} rows vs {len(want)}; spark only {extra}; sql only {lack}"
    return len(got) > 0, f"{len(got)} rows"


def main() -> int:
    from tallyhouse.catalog import all_queries

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.001"
    wanted = set(args[1:])
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for q in all_queries():
        if wanted and q.name not in wanted and not any(q.name.startswith(w[:-1]) for w in wanted if w.endswith("*")):
            continue
        t = time.time()
        try:
            ok, note = compare(spark, con, q, sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:1200]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {q.name:36s} {time.time() - t:6.2f}s {note}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
