"""Run a registered query and its oracle SQL side by side and report differences."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else ("inf" if math.isinf(value) else round(value, 9) + 0.0)
    if isinstance(value, int):
        return value
    return str(value)


def _key(row):
    return tuple((v is None, str(type(v).__name__), str(v)) for v in row)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=_key)


def differences(spark_df, con, sql: str) -> str | None:
    """None when both sides agree, else a short description."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _rows(names, cursor.fetchall())
    got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(names) != sorted(spark_df.columns):
        return f"columns: spark {sorted(spark_df.columns)} oracle {sorted(names)}"
    if len(got) != len(expected):
        return f"rows: spark {len(got)} oracle {len(expected)}"
    for a, b in zip(got, expected, strict=True):
        if a != b:
            return f"values {sorted(names)}: spark {a} oracle {b}"
    return None
