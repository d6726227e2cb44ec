"""Run registered queries against their SQL in DuckDB: python tests/check_oracle.py [sf] [names]."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def same(left, right) -> bool:
    if left is None or right is None:
        return left is right
    if isinstance(left, float) or isinstance(right, float):
        if isinstance(left, float) and isinstance(right, float) and math.isnan(left) and math.isnan(right):
            return True
        return float(left) == float(right)
    return left == right


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted(frame.itertuples(index=False, name=None), key=lambda r: tuple(map(str, r)))


def difference(spark, sf_dir: str, query, sql: str) -> str:
    """Empty if both give the same rows, else what differs."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    expected = con.execute(sql).df()
    got = query(spark, sf_dir).toPandas()
    if sorted(got.columns) != sorted(expected.columns):
        return f"columns {sorted(got.columns)} != {sorted(expected.columns)}"
    left, right = rows_of(got), rows_of(expected)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    for a, b in zip(left, right):
        if not all(same(x, y) for x, y in zip(a, b)):
            return f"{a} != {b}"
    kinds = [
        f"{c}: {got[c].dtype} != {expected[c].dtype}"
        for c in got.columns
        if got[c].dtype != expected[c].dtype
        and {got[c].dtype.kind, expected[c].dtype.kind} != {"M"}
        and not (expected[c].hasnans and str(expected[c].dtype).lower() == "int64")  # Spark's go through floats
    ]
    return "" if not kinds else f"types differ: {kinds}"


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    names = sys.argv[2:] or list(entry.queries())
    shared = os.environ.get("SHARED_DIR", os.path.abspath("spark-warehouse"))
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{shared}/_scratch")
        .config("spark.sql.warehouse.dir", shared)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        start = time.time()
        sql = entry.oracle_sql().get(name)
        try:
            if sql is None:
                note = f"rows only: {entry.queries()[name](spark, sf_dir).count()}"
            else:
                note = difference(spark, sf_dir, entry.queries()[name], sql)
                bad += bool(note)
                note = note or "equal"
        except Exception as failure:  # report and go on
            bad += 1
            note = f"FAILED {type(failure).__name__}: {str(failure)[:600]}"
        print(f"{name:32s} {time.time() - start:6.2f}s {note}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
