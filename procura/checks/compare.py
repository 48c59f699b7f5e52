"""Compare a registered Spark query with its DuckDB oracle.

Row count, column names and an order-insensitive multiset of rows (values
normalised to text) are compared; used by the tests and ``scripts/check.py``.
"""

from __future__ import annotations

import datetime as _dt
import decimal
from collections import Counter

from pyspark.sql import SparkSession

from .oracle import stage_sql
from .registry import run

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else str(v)
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, _dt.datetime) else v.isoformat()
    return str(v)


def duckdb_rows(sf_dir: str, sql: str):
    import duckdb

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(spark: SparkSession, name: str, sf_dir: str) -> dict:
    df = run(name, spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    o_cols, o_rows = duckdb_rows(sf_dir, stage_sql(name))
    out = {"query": name, "spark_rows": len(s_rows), "oracle_rows": len(o_rows)}
    out["columns_match"] = sorted(s_cols) == sorted(o_cols)
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, o_cols
        out["match"] = False
        return out
    idx = [o_cols.index(c) for c in s_cols]
    s_bag = Counter(tuple(_norm(v) for v in r) for r in s_rows)
    o_bag = Counter(tuple(_norm(r[i]) for i in idx) for r in o_rows)
    out["match"] = s_bag == o_bag
    if not out["match"]:
        out["only_spark"] = list((s_bag - o_bag).items())[:3]
        out["only_oracle"] = list((o_bag - s_bag).items())[:3]
    return out
