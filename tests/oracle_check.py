"""Compare registered queries with their oracle SQL in DuckDB.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _normal(value):
    if isinstance(value, float):
        return round(value, 6)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([tuple(_normal(row[i]) for i in order) for row in rows]), key=repr)


def differences(spark, con, name: str, run, sql: str, sf_dir: str) -> str | None:
    frame = run(spark, sf_dir)
    ours = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = rows_of(columns, result.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, oracle {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} rows differ, e.g. {wrong[0]}" if wrong else None


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    builder = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
    spark = builder.config("spark.sql.shuffle.partitions", "8").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if "MAX_ROWS_PER_SLICE" in os.environ:
        spark.conf.set("spark.tidemark.maxRowsPerSlice", os.environ["MAX_ROWS_PER_SLICE"])
    con, oracles = connect(sf_dir), entry.oracle_sql()
    failed = 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = differences(spark, con, name, run, oracles[name], sf_dir) if name in oracles else "no oracle"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
