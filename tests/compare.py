"""Run registered queries next to their SQL twin and compare all values."""

from __future__ import annotations

import glob
import math
import os
import time

import duckdb


def _connection(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(os.path.join(sf_dir, "*.parquet"))):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def differences(spark, sf_dir: str, name: str, query, sql: str) -> list[str]:
    """Human-readable differences; empty if both sides agree."""
    began = time.time()
    frame = query(spark, sf_dir)
    mine = _normal(frame.columns, [tuple(r) for r in frame.collect()])
    spent = time.time() - began
    con = _connection(sf_dir)
    cursor = con.execute(sql)
    theirs = _normal([d[0] for d in cursor.description], cursor.fetchall())
    problems = []
    if mine[0] != theirs[0]:
        problems.append(f"columns {mine[0]} != {theirs[0]}")
    if len(mine[1]) != len(theirs[1]):
        problems.append(f"{len(mine[1])} rows != {len(theirs[1])}")
    if not problems:
        bad = [(a, b) for a, b in zip(mine[1], theirs[1]) if repr(a) != repr(b)]
        if bad:
            problems.append(f"{len(bad)} rows differ, first: {bad[0]}")
    print(f"{name}: {len(mine[1])} rows, {spent:.2f}s {'OK' if not problems else problems}", flush=True)
    return problems
