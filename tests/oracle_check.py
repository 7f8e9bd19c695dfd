"""Runs registered queries beside their SQL in DuckDB and compares the rows."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(str(r[i]) for i in order) for r in rows))


def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def expected(con, sql):
    result = con.execute(sql)
    return sorted_rows([d[0] for d in result.description], result.fetchall())


def actual(frame):
    return sorted_rows(frame.columns, frame.collect())


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as contract
    from gameflow.session import build_session

    sf_dir = sys.argv[1]
    names = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
                                                "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = duck(sf_dir), contract.oracle_sql()
    for name, run in contract.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            got = actual(run(spark, sf_dir))
        except Exception as problem:
            print(f"FAIL {name}: {str(problem)[:1500]}")
            continue
        took = time.time() - started
        want = expected(con, oracle[name]) if name in oracle else None
        if want is None or got == want:
            print(f"ok   {name:26s} {len(got[1]):8d} rows {took:6.2f}s{'' if want else ' (no SQL)'}")
            continue
        print(f"DIFF {name}: columns {got[0]} / {want[0]}, rows {len(got[1])} / {len(want[1])}")
        for g, w in [(g, w) for g, w in zip(got[1], want[1]) if g != w][:3]:
            print("   got ", g, "\n   want", w)
