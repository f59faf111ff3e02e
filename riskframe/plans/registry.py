"""Registry of named queries and their DuckDB twins.

A query is ``fn(spark, sf_dir) -> DataFrame``. Its oracle, when the result
is expressible in SQL, is a DuckDB statement over the same parquet tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskframe.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def bigint_counts(sql: str) -> str:
    """Type alignment for the DuckDB twins: ``count_if`` returns HUGEINT there, bigint in Spark."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(key) - 1
        while True:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            if depth == 0:
                break
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k + 1] + " AS BIGINT)")
        i = k + 1


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = bigint_counts(sql)
        return run
    return deco


def load_all() -> None:
    """Import every catalog module (each registers its queries on import)."""
    from riskframe.plans import (catalog_features, catalog_io, catalog_ml,  # noqa: F401
                                 catalog_monitoring, catalog_observability, catalog_store)
    from riskframe.streaming import catalog_streams  # noqa: F401
