"""Compares a DataFrame with a DuckDB result, rows in any order."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return value.normalize()
    if isinstance(value, float):
        return decimal.Decimal(repr(value)).normalize()
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return decimal.Decimal(value).normalize()
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(names, result.fetchall())
    found = []
    if ours.total() != theirs.total():
        found.append(f"{ours.total()} rows != {theirs.total()}")
    only_ours, only_theirs = ours - theirs, theirs - ours
    if only_ours or only_theirs:
        a, b = next(iter(only_ours), None), next(iter(only_theirs), None)
        found.append(f"{only_ours.total()} rows only here, {only_theirs.total()} only there, e.g. {a} / {b}")
    return found
