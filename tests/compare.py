"""Spark results against DuckDB's on the same tables."""

from __future__ import annotations

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir: str = SF):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


def same(df, con, sql: str) -> None:
    """Fails unless both have the same columns and, in any order, the same rows."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    cols = sorted(names)
    want = sorted(repr(tuple(plain(r[names.index(c)]) for c in cols)) for r in cur.fetchall())
    got = sorted(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())
    assert got == want
