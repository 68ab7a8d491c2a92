"""Runs a registered query and its SQL side by side and compares rows, by column name and without order."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def _plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    return float(x) if type(x).__name__ == "Decimal" else x


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark_df, con, sql):
    """None if equal, else what differs."""
    a = _rows(spark_df.columns, spark_df.collect())
    rel = con.sql(sql)
    b = _rows(rel.columns, rel.fetchall())
    if a[0] != b[0]:
        return f"columns {a[0]} and {b[0]}"
    if len(a[1]) != len(b[1]):
        return f"{len(a[1])} rows and {len(b[1])}: {a[1][:2]} {b[1][:2]}"
    return next((f"{x} and {y}" for x, y in zip(a[1], b[1]) if x != y), None)
