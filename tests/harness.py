"""Compare a Spark query with its SQL in DuckDB: columns, rows and values."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


SPARK_KIND = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
              "date": "DATE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "smallint": "SMALLINT"}


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    expected = con.execute(sql)
    names = [c[0] for c in expected.description]
    kinds = {c[0]: str(c[1]) for c in expected.description}
    want = expected.fetchall()
    got = [tuple(r) for r in df.collect()]
    if sorted(names) != sorted(df.columns):
        return f"columns: spark only {set(df.columns) - set(names)}, sql only {set(names) - set(df.columns)}"
    odd = {c: (t, kinds[c]) for c, t in df.dtypes if SPARK_KIND.get(t, t) != kinds[c]}
    if odd:
        described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
        odd = {c: (t, described[c]) for c, (t, _) in odd.items() if SPARK_KIND.get(t, t) != described[c]}
    a, b = _rows(df.columns, got), _rows(names, want)
    if a != b:
        return f"rows: spark {len(got)}, sql {len(want)}; spark only {list((a - b))[:2]}; sql only {list((b - a))[:2]}; order {sorted(names)}"
    if odd:
        return f"types: {odd}"
    return None
