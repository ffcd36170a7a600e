"""Compare the named queries with their SQL twins on the same parquet tables."""

from __future__ import annotations

import decimal
import glob
import math
import os

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def differences(spark_df, connection, sql: str) -> str | None:
    """A description of the first difference, or None."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    kinds = {column[0]: str(column[1]) for column in result.description}
    expected = result.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    loose = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "boolean": "BOOLEAN"}
    for name, kind in spark_df.dtypes:
        if loose.get(kind) != kinds[name]:
            return f"type of {name}: {kind} against {kinds[name]}"
    got = _sorted_rows(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    want = _sorted_rows(names, expected)
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for a, b in zip(got, want):
        if repr(a) != repr(b):
            return f"{str(a)[:600]}\n  against\n{str(b)[:600]}"
    return None
