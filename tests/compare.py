"""Rows of a Spark frame against rows of DuckDB, order apart."""

import os

import duckdb


def connect(sf_dir):
    c = duckdb.connect()
    for name in os.listdir(sf_dir):
        path = f"{sf_dir}/{name}" + ("/*.parquet" if os.path.isdir(f"{sf_dir}/{name}") else "")
        c.sql(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{path}'")
    return c


def norm(v):
    return float(f"{v:.9g}") if isinstance(v, float) else v


def same(df, sql, sf_dir):
    cols = sorted(df.columns)
    rel = connect(sf_dir).sql(sql)
    names = rel.columns
    assert sorted(names) == cols
    ours = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    theirs = sorted((tuple(norm(dict(zip(names, r, strict=True))[c]) for c in cols) for r in rel.fetchall()), key=repr)
    assert ours == theirs
