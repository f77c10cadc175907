"""Runs a query and its SQL twin and compares the two results."""

import math
from decimal import Decimal

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(df, con, sql: str) -> str | None:
    """None where both sides agree, else what differs first."""
    left_cols, left = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    right_cols, right = rows_of([c[0] for c in cur.description], cur.fetchall())
    if left_cols != right_cols:
        return f"columns {left_cols} <> {right_cols}"
    if len(left) != len(right):
        extra = sorted(set(left) - set(right), key=str)[:3]
        return f"rows {len(left)} <> {len(right)}; only here {extra}; only there {sorted(set(right) - set(left), key=str)[:3]}"
    for a, b in zip(left, right):
        if a != b:
            return f"values {a} <> {b}"
    types = [type(x) for x in left[0]] if left else []
    if left and types != [type(x) for x in right[0]] and None not in left[0] + right[0]:
        return f"types {types} <> {[type(x) for x in right[0]]}"
    return None
