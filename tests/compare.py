"""Run a registered query and its SQL counterpart and compare whole results."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle(sql: str, sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    return names, rel.fetchall()


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(df, sql: str, sf_dir: str) -> str:
    """Empty when equal, otherwise what differs."""
    names, rows = oracle(sql, sf_dir)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    theirs = canonical(names, rows)
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs, strict=True) if a != b]
    return f"{len(wrong)} of {len(mine)} rows differ, e.g. {sorted(names)}\n {wrong[0][0]}\n {wrong[0][1]}" if wrong else ""
