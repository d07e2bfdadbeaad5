"""Compare a registered query's rows with its oracle's in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from .fixtures import GIVEN


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, decimal.Decimal):
        return float(f"{float(value):.10g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


_KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
    "double": "DOUBLE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "void": "INTEGER",
}


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if columns, types and the multisets of rows are equal, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    wrong = {c: (t, kinds[c]) for c, t in df.dtypes if _KINDS.get(t, t).split("(")[0] != kinds[c].split("(")[0]}
    order = sorted(names)
    want = Counter(tuple(_plain(row[names.index(c)]) for c in order) for row in result.fetchall())
    got = Counter(tuple(_plain(row[c]) for c in order) for row in df.collect())
    if got != want:
        return (f"rows {sum(got.values())} vs {sum(want.values())}, only spark {list((got - want).items())[:3]}, "
                f"only oracle {list((want - got).items())[:3]} {order}")
    return f"types {wrong}" if wrong else None
