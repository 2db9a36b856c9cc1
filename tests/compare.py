"""Run registered queries and their SQL twins and compare the results."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    return str(v)


def _family(t: str) -> str:
    t = t.lower()
    for name, members in {
        "int": ("bigint", "int", "integer", "smallint", "tinyint", "hugeint", "long"),
        "float": ("double", "float"),
        "text": ("varchar", "string"),
        "bool": ("boolean",),
    }.items():
        if t in members:
            return name
    return t


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> str:
    """'' when equal, else a description of the first difference."""
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.select(*sorted(df.columns)).collect()]
    if sql is None:
        return ""
    rel = con.sql(sql)
    columns = sorted(rel.columns)
    if columns != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {columns}"
    types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for col, t in df.dtypes:
        if _family(t) != _family(types[col]) or (t == "int") != (types[col] == "INTEGER"):
            return f"type of {col}: {t} != {types[col]}"
    want = rel.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    a = sorted([tuple(map(_norm, r)) for r in got], key=repr)
    b = sorted([tuple(map(_norm, r)) for r in want], key=repr)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"{columns}: {x} != {y}"
    return "" if a else "no rows"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from offerloom.session import local_session

    wanted = sys.argv[1:]
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    session, con = local_session("compare"), duck(sf)
    oracles = oracle_sql()
    bad = 0
    for key, fn in queries().items():
        if wanted and not any(key.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            out = compare(session, con, key, fn, oracles.get(key), sf)
        except Exception as e:  # noqa: BLE001
            out = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(out)
        print(f"{'FAIL' if out else 'ok'} {key} {time.time() - start:.1f}s {out}", flush=True)
    print("failed", bad)
