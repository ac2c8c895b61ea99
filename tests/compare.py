"""Compare a registered query with its SQL on one data folder."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if value is None or value is pd.NA or value is pd.NaT:
        return None
    if isinstance(value, float) and value != value:
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, bool):
        return value
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def rows_of(columns: list[str], records) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(rec[i]) for i in order) for rec in records]
    return sorted(out, key=lambda t: tuple((v is None, str(type(v)), v if v is not None else 0) for v in t))


def differences(spark_df, con, sql: str) -> list[str]:
    names = spark_df.columns
    got = rows_of(names, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    sql_names = [d[0] for d in cursor.description]
    want = rows_of(sql_names, cursor.fetchall())
    problems = []
    if sorted(names) != sorted(sql_names):
        return [f"columns {sorted(names)} != {sorted(sql_names)}"]
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if not want:
        problems.append("no rows")
    for g, w in zip(got, want, strict=False):
        if g != w or [type(a) for a in g] != [type(a) for a in w]:
            problems.append(f"{g}\n  != {w}")
            if len(problems) > 3:
                break
    return problems
