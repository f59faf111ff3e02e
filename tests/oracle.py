"""Spark-vs-DuckDB comparison used by the tests (same rules as the driver's check)."""

from __future__ import annotations

import hashlib
import math

import duckdb

from riskframe.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def _norm(v):
    if v is None:
        return "None"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        if math.isnan(v):
            return "None"
        return repr(round(v, 6) + 0.0)
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def rows_hash(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = dict(zip(d_cols, [str(t) for t in rel.types]))
    d_rows = rel.fetchall()
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in spark_df.schema.fields}
    res = {"spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols),
           "types_match": all(s_types[c] == d_types.get(c) for c in s_cols)}
    if not res["types_match"]:
        res["type_diff"] = [(c, s_types[c], d_types.get(c)) for c in s_cols if s_types[c] != d_types.get(c)][:5]
    hs, ls = rows_hash(s_cols, s_rows)
    hd, ld = rows_hash(d_cols, d_rows)
    res["hash_match"] = hs == hd
    if not res["hash_match"]:
        a, b = set(ls), set(ld)
        res["only_spark"] = sorted(a - b)[:3]
        res["only_duck"] = sorted(b - a)[:3]
    if not res["cols_match"]:
        res["spark_cols"] = sorted(s_cols)
        res["duck_cols"] = sorted(d_cols)
    return res
