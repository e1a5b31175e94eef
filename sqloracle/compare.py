"""Run a Spark DataFrame and a DuckDB query side by side and compare results."""

from __future__ import annotations

import datetime as _dt
import decimal
import math
from collections import Counter

import duckdb

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(_norm(r[i]) for i in order) for r in rel.fetchall()]


def compare(df, con, sql) -> dict:
    scols, srows = rows_of_spark(df)
    dcols, drows = rows_of_duck(con, sql)
    out = {"spark_rows": len(srows), "oracle_rows": len(drows), "columns_match": scols == dcols}
    if scols != dcols:
        out["spark_cols"], out["oracle_cols"] = scols, dcols
    cs, cd = Counter(srows), Counter(drows)
    out["values_match"] = cs == cd
    if cs != cd:
        out["only_spark"] = list((cs - cd).elements())[:5]
        out["only_oracle"] = list((cd - cs).elements())[:5]
    out["ok"] = out["columns_match"] and out["values_match"]
    return out
