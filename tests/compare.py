"""Order-insensitive comparison of a Spark result with the checking SQL."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    got = spark_df.collect()
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(columns) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} vs {sorted(columns)}"]
    if len(got) != len(want):
        return [f"{len(got)} rows vs {len(want)}"]
    a, b = rows_of(spark_df.columns, got), rows_of(columns, want)
    return [f"{x} vs {y}" for x, y in zip(a, b) if x != y or [type(v) for v in x] != [type(v) for v in y]]
