"""Comparison of a Spark result with the reference SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value: object) -> object:
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def rows(columns: list[str], data: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in data)


_KINDS = {
    "BIGINT": "integer",
    "INTEGER": "integer",
    "HUGEINT": "integer",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "TIMESTAMP": "time",
    "BOOLEAN": "boolean",
    "bigint": "integer",
    "int": "integer",
    "double": "double",
    "string": "string",
    "date": "date",
    "timestamp": "time",
    "timestamp_ntz": "time",
    "boolean": "boolean",
}


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None: column names and kinds, row count, every value."""
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    expected_types = {r[0]: _KINDS.get(r[1], r[1]) for r in described}
    actual_types = {f.name: _KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if expected_types != actual_types:
        return f"columns: spark {actual_types}, sql {expected_types}"
    expected = rows([r[0] for r in described], con.execute(sql).fetchall())
    actual = rows(df.columns, [tuple(r) for r in df.collect()])
    if expected == actual:
        return None
    only_sql = list((expected - actual).items())[:3]
    only_spark = list((actual - expected).items())[:3]
    return (
        f"rows: spark {actual.total()}, sql {expected.total()}; columns {sorted(df.columns)}; "
        f"only spark {only_spark}; only sql {only_sql}"
    )
