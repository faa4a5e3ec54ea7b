"""Run a Spark query and its oracle SQL side by side and compare (rows, columns, values)."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float) and math.isnan(v):
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        return f"{float(v):.6f}"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return sorted(columns), len(rows), h, lines


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    sc, sn, sh, sl = digest(s_cols, s_rows)
    oc, on, oh, ol = digest(o_cols, o_rows)
    return {"columns": sc == oc, "rows": (sn, on), "hash": sh == oh,
            "ok": sc == oc and sn == on and sh == oh,
            "only_spark": sorted(set(sl) - set(ol))[:3], "only_oracle": sorted(set(ol) - set(sl))[:3],
            "col_diff": (sorted(set(sc) - set(oc)), sorted(set(oc) - set(sc)))}
