"""Rows of a Spark query against rows of its SQL in DuckDB, as bags over columns sorted by name."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, int):
        return value
    return str(value)


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(row[i]) for i in order) for row in rows)


_KINDS = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean",
}


def differences(df, connection, sql: str) -> list[str]:
    """What differs, in words; an empty list if nothing does."""
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    kinds = {d[0]: _KINDS.get(str(d[1]), str(d[1])) for d in cursor.description}
    expected = _bag(columns, cursor.fetchall())
    actual = _bag(df.columns, df.collect())
    found = []
    if actual[0] != expected[0]:
        return [f"columns {actual[0]} != {expected[0]}"]
    if dict(df.dtypes) != kinds:
        found.append(f"types {[(c, t, kinds[c]) for c, t in df.dtypes if kinds[c] != t]}")
    if actual[1] != expected[1]:
        extra, missing = actual[1] - expected[1], expected[1] - actual[1]
        found.append(
            f"rows {sum(actual[1].values())} != {sum(expected[1].values())}; "
            f"extra {list(extra)[:3]}; missing {list(missing)[:3]}"
        )
    return found
