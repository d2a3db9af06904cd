"""Run registered queries next to their SQL oracle: python tests/check.py [sf] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def session(cores: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.log.level", "ERROR").getOrCreate()
    )
    return spark


def connect(folder: str):
    con = duckdb.connect()
    for f in sorted(os.listdir(folder)):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{folder}/{f}'")
    return con


def text(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(text(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    """Empty text when both agree, else what differs."""
    got = normalised(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want = normalised([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} vs {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} vs {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(bad)} of {len(got[1])} rows differ: {got[0]} {bad[:2]}" if bad else ""


def main() -> None:
    from merchlens.plans import all_queries

    folder = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.001'}"
    chosen = sys.argv[2:] or list(all_queries())
    spark, con = session(), connect(folder)
    failed = []
    for name in chosen:
        query, start = all_queries()[name], time.time()
        try:
            df, sql = query.run(spark, folder), query.oracle()
            why = compare(df, con, sql) if sql else ""
            note = "" if sql else f" rows={df.count()}"
        except Exception as e:  # keep going: one report for all queries
            why, note = f"{type(e).__name__}: {str(e)[:600]}", ""
            if os.environ.get("TRACE"):
                traceback.print_exc()
        print(f"{'FAIL' if why else 'ok'} {name} {time.time() - start:.1f}s{note} {why}", flush=True)
        if why:
            failed.append(name)
    print(f"{len(chosen) - len(failed)} of {len(chosen)} ok; failed: {' '.join(failed)}")


if __name__ == "__main__":
    main()
