"""Order-insensitive comparison of a Spark result with DuckDB oracle rows."""

from __future__ import annotations

import decimal
import math

import duckdb

from ..sources.driver import DRIVER_TABLES


def duckdb_views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 3)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 3)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canonical(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark_df, con, sql: str):
    """Return (match, spark_rows, oracle_rows, message)."""
    srows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    scols = spark_df.columns
    if sorted(scols) != sorted(ocols):
        return False, len(srows), len(orows), (f"columns differ: spark-only {sorted(set(scols) - set(ocols))}, "
                                              f"oracle-only {sorted(set(ocols) - set(scols))}")
    a, b = canonical(scols, srows), canonical(ocols, orows)
    if a == b:
        return True, len(srows), len(orows), ""
    sa, sb = set(a), set(b)
    return False, len(srows), len(orows), f"spark-only {list(sa - sb)[:2]} oracle-only {list(sb - sa)[:2]}"
