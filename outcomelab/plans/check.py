"""Side-by-side check of a Spark query against its DuckDB twin."""

from __future__ import annotations

import math

from outcomelab.sources.tables import TABLES


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits)
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    return v


def _rows(pdf, digits: int):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v, digits) for v in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df, duck_sql: str, con, digits: int = 6) -> dict:
    """Row count, column names and order-insensitive values."""
    spdf = spark_df.toPandas()
    dpdf = con.execute(duck_sql).fetchdf()
    res = {"spark_rows": len(spdf), "oracle_rows": len(dpdf)}
    s_cols, s_rows = _rows(spdf, digits)
    d_cols, d_rows = _rows(dpdf.astype(object).where(dpdf.notna(), None), digits)
    res["columns_match"] = s_cols == d_cols
    res["rows_match"] = len(spdf) == len(dpdf)
    res["values_match"] = res["columns_match"] and s_rows == d_rows
    if not res["values_match"]:
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        res["first_diffs"] = diff
    return res
