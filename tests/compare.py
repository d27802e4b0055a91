"""Compare a Spark result with its DuckDB SQL, order-insensitively."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, (int, float)):
        return float(value)
    if hasattr(value, "is_finite"):
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    return value


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(type(v)), str(v)) for v in r))


def spark_rows(df):
    names = sorted(df.columns)
    return names, _sorted(tuple(_cell(r[n]) for n in names) for r in df.collect())


def duck_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    names = sorted(columns)
    order = [columns.index(n) for n in names]
    return names, _sorted(tuple(_cell(r[i]) for i in order) for r in cursor.fetchall())


def difference(df, con, sql):
    """None when equal, else a short description."""
    names, left = spark_rows(df)
    duck_names, right = duck_rows(con, sql)
    if names != duck_names:
        return f"columns {names} != {duck_names}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}; spark {left[:2]} duck {right[:2]}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)}/{len(left)} rows differ, e.g. {wrong[:2]}" if wrong else None
