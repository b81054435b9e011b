"""Run a registered query on Spark and its SQL on DuckDB, and compare."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if hasattr(value, "item"):
        return canonical(value.item())
    if hasattr(value, "isoformat"):
        return value.isoformat()[:10]
    return value


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, Counter(tuple(map(canonical, r)) for r in df.select(*columns).collect())


def sql_rows(con, sql: str):
    result = con.sql(sql)
    order = sorted(range(len(result.columns)), key=lambda i: result.columns[i])
    columns = [result.columns[i] for i in order]
    return columns, Counter(tuple(canonical(r[i]) for i in order) for r in result.fetchall())


_KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}


def kinds(df, con, sql: str):
    spark = {n: _KINDS.get(t, t) for n, t in df.dtypes}
    result = con.sql(sql)
    duck = dict(zip(result.columns, map(str, result.types)))
    return {n: (spark.get(n), duck.get(n)) for n in {*spark, *duck} if spark.get(n) != duck.get(n)}
