"""Run one registered query in Spark and DuckDB and compare the results as bags of rows."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in sorted(value.items()))
    if isinstance(value, int):
        return value
    return str(value)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark, sf_dir, query, oracle):
    """Empty string when both engines agree on columns, types of numbers and rows."""
    frame = query(spark, sf_dir)
    result = connect(sf_dir).execute(oracle)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns differ: {sorted(frame.columns)} != {sorted(columns)}"
    ours, theirs = bag(frame.columns, [tuple(r) for r in frame.collect()]), bag(columns, result.fetchall())
    if ours == theirs:
        return "" if ours else "both results are empty"
    return (f"rows {sum(ours.values())} vs {sum(theirs.values())}; only spark {list((ours - theirs).items())[:3]}; "
            f"only duckdb {list((theirs - ours).items())[:3]}")
