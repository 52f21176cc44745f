"""Compare a query with its SQL, as sorted rows."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def views(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(df, con, sql):
    names = sorted(df.columns)
    got = _sorted(tuple(r[c] for c in names) for r in df.collect())
    rel = con.sql(sql)
    assert sorted(rel.columns) == names
    at = [list(rel.columns).index(c) for c in names]
    assert got == _sorted(tuple(r[i] for i in at) for r in rel.fetchall())
