"""Run a query and its SQL on the same tables and compare names, counts and values."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings labels "
    "pages benchmark conversations"
).split()


def connect(folder: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    return v


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=_key)


SPARK_KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(df, db, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    names = df.columns
    spark_rows = _rows(names, [tuple(r) for r in df.collect()])
    cursor = db.execute(sql)
    their_names = [d[0] for d in cursor.description]
    their_rows = _rows(their_names, cursor.fetchall())
    if sorted(names) != sorted(their_names):
        return f"columns {sorted(names)} / {sorted(their_names)}"
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    for name, kind in df.dtypes:
        if SPARK_KINDS.get(kind, kind) != kinds[name]:
            return f"type of {name}: {kind} / {kinds[name]}"
    if len(spark_rows) != len(their_rows):
        return f"rows {len(spark_rows)} / {len(their_rows)}"
    for a, b in zip(spark_rows, their_rows):
        if a != b:
            return f"values {a} / {b}"
    return None
