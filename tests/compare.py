"""Runs registered queries next to their SQL in DuckDB."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x:.6g}"
    return str(x)


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None if both give the same rows, else what differs."""
    df = query(spark, sf_dir)
    names, left = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    other, right = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if names != other:
        return f"columns {names} and {other}"
    if left != right:
        a, b = sorted(set(left) - set(right)), sorted(set(right) - set(left))
        return f"{len(left)} and {len(right)} rows; only Spark: {a[:3]}; only SQL: {b[:3]}"
    return None
