"""Runs a query's SQL in DuckDB and compares it with Spark's rows."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def by_sql(sql, folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    got = con.execute(sql)
    return rows_of([d[0] for d in got.description], got.fetchall())


def by_spark(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])
