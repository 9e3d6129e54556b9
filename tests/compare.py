"""Runs a registered query on Spark and its SQL on DuckDB and compares the rows."""

from __future__ import annotations

import datetime
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, Decimal):
        return ("decimal", value)
    return value


def _kind(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, datetime.datetime):
        return "timestamp"
    return type(value).__name__


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_plain(row[i]) for i in order) for row in rows]
    table.sort(key=lambda r: tuple((v is not None, str(type(v)), str(v)) for v in r))
    return [columns[i] for i in order], table


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duckdb_rows(con, sql):
    cursor = con.execute(sql)
    return canonical([d[0] for d in cursor.description], cursor.fetchall())


def differences(left, right, limit: int = 4) -> list[str]:
    """Messages on how two canonical tables differ; empty when they are equal."""
    (names, rows), (other_names, other_rows) = left, right
    if names != other_names:
        return [f"columns {names} != {other_names}"]
    messages = []
    if len(rows) != len(other_rows):
        messages.append(f"{len(rows)} rows != {len(other_rows)} rows")
    for i, name in enumerate(names):
        kinds = {_kind(r[i]) for r in rows} - {None}, {_kind(r[i]) for r in other_rows} - {None}
        if kinds[0] != kinds[1] and all(kinds):
            messages.append(f"type of {name}: {kinds[0]} != {kinds[1]}")
    if rows != other_rows:
        mine, theirs = set(rows), set(other_rows)
        messages += [f"spark only {r}" for r in sorted(mine - theirs, key=str)[:limit]]
        messages += [f"sql only   {r}" for r in sorted(theirs - mine, key=str)[:limit]]
        if len(messages) == 0:
            messages.append("row multiplicities differ")
    return messages
