"""Compares every registered query with its SQL: columns, row count and values."""

from __future__ import annotations

import datetime as dt
import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def compare(spark, con, query, sql: str, sf_dir: str) -> tuple[bool, str]:
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        return False, f"{len(got)} rows against {len(want)}; {got[:2]} against {want[:2]}"
    return True, f"{len(got)} rows"
