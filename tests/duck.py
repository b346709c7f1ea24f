"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is not None, str(type(v)), v) for v in row))


def difference(df, con, sql: str) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    ours = _sorted_rows(df.columns, [tuple(row) for row in df.collect()])
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    theirs = _sorted_rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    for mine, other in zip(ours, theirs):
        if mine != other or list(map(type, mine)) != list(map(type, other)):
            return f"{mine} and {other}"
    return None
