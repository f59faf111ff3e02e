"""Table profiling (AGG-12, AGG-13) and skew-safe per-group top-k (TOP-05)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from riskframe.functions.time import epoch_micros
from riskframe.operators.keys import shuffle_partitions


def missing_counts(df: DataFrame) -> DataFrame:
    """AGG-12: null count per column (only columns with missing values) plus a ``*`` total row.

    One aggregate over all columns, then an in-row unpivot of the single result row.
    """
    cols = df.columns
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing")) for c in cols])
    long = one.select(F.inline(cells))
    total = long.agg(F.lit("*").alias("column_name"), F.sum("missing").cast("bigint").alias("missing"))
    return long.where(F.col("missing") > 0).unionByName(total)


def describe(df: DataFrame, quartiles=(0.25, 0.5, 0.75)) -> DataFrame:
    """AGG-13: count, mean, std, min, exact quartiles and max per numeric column (one aggregate)."""
    from riskframe.operators.metrics import quantiles
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    aggs = []
    for c in num:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    one = df.agg(*aggs)
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__count").alias("count"),
                               F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"),
                               F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max")) for c in num])
    moments = one.select(F.inline(cells))
    # quartiles of all columns in one ranked pass over the unpivoted values
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x"))
                                        for c in num])))
    q = quantiles(long, "x", list(quartiles), ["column_name"], ["p25", "p50", "p75"], few_groups=True)
    return moments.join(q, "column_name", "left").select("column_name", "count", "mean", "std", "min",
                                                          "p25", "p50", "p75", "max")


def top_k_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int,
                    salt_buckets: int | None = None, salt_of: Column | None = None) -> DataFrame:
    """First ``k`` rows per group in ``order`` without ever sorting a whole group in one task.

    Level 1 ranks inside ``(group, salt)`` sub-groups (salt = hash of the row
    key), keeping k per sub-group; level 2 ranks the at most ``k * salts``
    survivors per group. ``order`` must be a total order.
    """
    s = salt_buckets or shuffle_partitions(df.sparkSession)
    salt = F.pmod(F.xxhash64(*(salt_of if isinstance(salt_of, list) else [salt_of] if salt_of is not None
                              else [F.col(c) for c in df.columns])), F.lit(s))
    w1 = Window.partitionBy(*groups, "__salt").orderBy(*order)
    cand = df.withColumn("__salt", salt).withColumn("__r", F.row_number().over(w1)).where(F.col("__r") <= k)
    w2 = Window.partitionBy(*groups).orderBy(*order)
    return cand.withColumn("__r", F.row_number().over(w2)).where(F.col("__r") <= k).drop("__salt", "__r")


def shape(df: DataFrame, ts: str) -> DataFrame:
    """AGG-13: one row with the table's row and column counts, its columns as ``name:type`` and its time range."""
    us = epoch_micros(F.col(ts))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(us).alias("first_us"), F.max(us).alias("last_us")).withColumns({
        "n_columns": F.lit(len(df.columns)).cast("bigint"),
        "columns": F.lit(",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields))})
