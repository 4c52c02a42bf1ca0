"""Run registered queries in Spark and their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


# Seconds of the last comparison: Spark, SQL.
TIMES: list[float] = []


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def rows_of(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(r[i] for i in order) for r in rows)


def difference(spark, con, folder: str, query, sql: str) -> str | None:
    """None when both sides agree, else a description of the first differences."""
    begin = time.time()
    df = query(spark, folder)
    left_cols, left = rows_of(df.columns, df.collect())
    middle = time.time()
    result = con.execute(sql)
    right_cols, right = rows_of([d[0] for d in result.description], result.fetchall())
    TIMES[:] = [middle - begin, time.time() - middle]
    if left_cols != right_cols:
        return f"columns {left_cols} / {right_cols}"
    if left != right:
        return (
            f"{sum(left.values())} / {sum(right.values())} rows; only Spark "
            f"{str(list((left - right).items())[:2])[:1200]}; only SQL "
            f"{str(list((right - left).items())[:2])[:1200]}"
        )
    return None


def main() -> int:
    import __spark_entry__ as entry
    from folioforge.session import build_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark = build_session("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        try:
            diff = difference(spark, con, folder, query, sqls[name])
        except Exception as error:  # reported, and the rest goes on
            diff = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {name} {[round(t, 1) for t in TIMES]} {diff or ''}",
              flush=True)
    print("differences:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
