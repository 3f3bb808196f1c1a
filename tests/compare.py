"""Runs a query in Spark and its SQL in DuckDB and compares the rows."""

from __future__ import annotations

import duckdb

from snapmart.driver_tables import DRIVER_TABLES


def connection(sf_dir: str):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return f"{value:.10g}"
    return str(value)


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str) -> str | None:
    rows = spark_df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    got, want = normal(rows, spark_df.columns), normal(expected, names)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; extra {[r for r in got if r not in set(want)][:2]}; missing {[r for r in want if r not in set(got)][:2]}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]}"
    return None
