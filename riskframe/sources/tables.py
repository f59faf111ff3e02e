"""Reading the input tables.

All readers go through ``spark.read`` so Parquet column pruning and filter
pushdown reach the scan; NaN is turned into null at the boundary (pandas
semantics of "missing", which Spark aggregates would otherwise be poisoned by).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table as a DataFrame, NaN as null (lazy; nothing is read here)."""
    return clean_nan(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def clean_nan(df: DataFrame) -> DataFrame:
    """H3: NaN to null on every floating column, other columns untouched."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def read_collection(spark: SparkSession, path: str, required: list[str] | None = None,
                    limit: int | None = None, fmt: str = "parquet") -> DataFrame:
    """SRC-02: a stored collection; ``_id`` dropped, required columns asserted; an empty one raises (at most one row is read for that).

    ``limit`` is an explicit operator (the reference limited every read to
    1,000 rows; here no limit is applied unless asked for).
    """
    df = spark.read.format(fmt).load(path)
    if "_id" in df.columns:
        df = df.drop("_id")
    missing = [c for c in (required or []) if c not in df.columns]
    if missing:
        raise KeyError(f"collection {path} lacks required columns {missing}")
    assert_not_empty(df, f"collection {path}")
    if limit is not None:
        df = df.limit(limit)
    return clean_nan(df)


def assert_not_empty(df: DataFrame, what: str) -> DataFrame:
    """Emptiness test that reads at most one row (``isEmpty`` is a limit-1 job)."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def read_csv_tables(spark: SparkSession, paths: dict[str, str],
                    schemas: dict[str, T.StructType]) -> dict[str, DataFrame]:
    """SRC-01: header CSV files with declared schemas; every named file must exist."""
    jvm_fs = spark._jvm.org.apache.hadoop.fs  # path existence only, no data read
    conf = spark._jsc.hadoopConfiguration()
    missing = []
    for name, p in paths.items():
        hp = jvm_fs.Path(p)
        if not hp.getFileSystem(conf).exists(hp):
            missing.append(name)
    if missing:
        raise FileNotFoundError(f"required tables missing: {missing}")
    return {name: spark.read.option("header", True).schema(schemas[name]).csv(p)
            for name, p in paths.items()}


def table_row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """SRC-10: one row per table with its row count (one aggregate job per table, unioned)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
