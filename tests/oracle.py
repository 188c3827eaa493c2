"""Runs a registered query and its SQL side by side and compares the values."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "asDict"):
        return _plain(list(v))
    if isinstance(v, dict):
        return _plain(list(v.values()))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_plain(x) for x in v) + "]"
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return repr(float(v))
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat() if hasattr(v, "tzinfo") else v.isoformat()
    return str(v)


def compare(spark, con, sf_dir: str, fn, sql: str) -> list[str]:
    """Differences between the two results; an empty list means they agree."""
    df = fn(spark, sf_dir)
    names = sorted(df.columns)
    got = sorted(tuple(_plain(r[c]) for c in names) for r in df.collect())
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    if sorted(cols) != names:
        return [f"columns {names} against {sorted(cols)}"]
    at = [cols.index(c) for c in names]
    want = sorted(tuple(_plain(r[i]) for i in at) for r in cur.fetchall())
    if got == want:
        return []
    out = [f"{len(got)} rows against {len(want)}"]
    a, b = set(got), set(want)
    out += [f"only here  {dict(zip(names, r))}" for r in sorted(a - b)[:3]]
    out += [f"only in SQL {dict(zip(names, r))}" for r in sorted(b - a)[:3]]
    out.append(f"{len(a - b)} and {len(b - a)} rows differ")
    return out
