"""Rows of Spark and DuckDB in one comparable form."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


def spark_rows(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    got = con.execute(sql)
    return rows([c[0] for c in got.description], got.fetchall())
