"""Key statistics, lookups and global order (helpers H1, H2 and JON-02).

H1 ``running_totals`` / ``row_index``: a global prefix sum without a
single-partition window. Rows are range-partitioned on the order key into as
many ranges as there are shuffle partitions, the assignment is made durable
with a reliable checkpoint (so both passes see the same ranges), each range
is summed locally with a window, and a tiny table of per-range totals adds
the offset of the earlier ranges. The order key must be a total order
(unique per row) where ties would matter.

H2 ``key_stats``: any number of key columns in one aggregate: the columns
are unpivoted to ``(feature, key)`` and grouped once; Spark's partial
aggregation pre-combines hot keys before the shuffle.

JON-02 ``lookup``: LEFT join of a frame to a fitted stats table. The stats
side is broadcast only when its counted size is under the bound; otherwise
it is a shuffle join (AQE splits skewed partitions of the big side).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import cut_lineage

# Broadcast bound for fitted lookup tables (bytes, estimated from the row count).
BROADCAST_BYTES = 64 * 1024 * 1024
BYTES_PER_STATS_ROW = 96


def shuffle_partitions(spark) -> int:
    v = spark.conf.get("spark.sql.shuffle.partitions", "200")
    try:
        return max(1, int(v))
    except ValueError:  # "auto" on some platforms
        return max(1, spark.sparkContext.defaultParallelism)


def running_totals(df: DataFrame, order: Sequence[str], measures: Mapping[str, Column],
                   groups: Sequence[str] = (), ranges: int | None = None,
                   inclusive: bool = True, few_groups: bool = False) -> DataFrame:
    """Add, for each measure, its running total in ``order`` (restarting per ``groups``).

    ``inclusive=True`` counts the current row. Output keeps every input column
    plus one column per measure name. ``few_groups`` tells that the groups are
    few by construction (features, classes), so the offsets table
    (ranges x groups rows) may be broadcast.
    """
    spark = df.sparkSession
    k = ranges or shuffle_partitions(spark)
    order_cols = [*groups, *order]
    frame = (Window.unboundedPreceding, Window.currentRow) if inclusive else (Window.unboundedPreceding, -1)
    tmp = {name: f"__m_{i}" for i, name in enumerate(measures)}
    base = df.select("*", *[m.alias(tmp[name]) for name, m in measures.items()])
    if k <= 1:
        w = Window.partitionBy(*groups).orderBy(*order_cols).rowsBetween(*frame) if groups \
            else Window.orderBy(*order_cols).rowsBetween(*frame)
        out = base.select("*", *[F.coalesce(F.sum(tmp[n]).over(w), F.lit(0)).alias(n) for n in measures])
        return out.drop(*tmp.values())
    ranged = base.repartitionByRange(k, *order_cols).withColumn("__r", F.spark_partition_id())
    ranged = cut_lineage(ranged)
    wl = Window.partitionBy("__r", *groups).orderBy(*order_cols).rowsBetween(*frame)
    local = ranged.select("*", *[F.sum(tmp[n]).over(wl).alias(f"__l_{tmp[n]}") for n in measures])
    tot = ranged.groupBy("__r", *groups).agg(*[F.sum(tmp[n]).alias(f"__t_{tmp[n]}") for n in measures])
    # per-range totals: at most ranges x groups rows, so this window is tiny
    wo = (Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))) \
        .orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select("__r", *groups, *[F.sum(f"__t_{tmp[n]}").over(wo).alias(f"__o_{tmp[n]}") for n in measures])
    # without groups the offsets table has at most ``ranges`` rows (safe to broadcast);
    # with groups it grows with the number of groups, so the planner decides
    j = local.join(F.broadcast(off) if (not groups or few_groups) else off, ["__r", *groups], "left")
    res = j.select(*[c for c in df.columns],
                   *[(F.coalesce(F.col(f"__o_{tmp[n]}"), F.lit(0)) +
                      F.coalesce(F.col(f"__l_{tmp[n]}"), F.lit(0))).alias(n) for n in measures])
    return res


def row_index(df: DataFrame, order: Sequence[str], name: str = "row_idx", start: int = 1,
              ranges: int | None = None) -> DataFrame:
    """Global 1-based (or ``start``-based) row number in ``order`` (must be a total order)."""
    out = running_totals(df, order, {name: F.lit(1).cast("bigint")}, ranges=ranges)
    return out.withColumn(name, (F.col(name) + F.lit(start - 1)).cast("bigint"))


def dense_codes(values: DataFrame, key: str, name: str = "code", ranges: int | None = None) -> DataFrame:
    """Dense 0-based code of each distinct ``key`` in binary string order (FUN-06 fit)."""
    distinct = values.select(key).where(F.col(key).isNotNull()).distinct()
    return row_index(distinct, [key], name=name, start=0, ranges=ranges)


def unpivot_keys(df: DataFrame, cols: Iterable[str], carry: Sequence[str] = (),
                 token: str | None = None) -> DataFrame:
    """Wide key columns to long ``(feature, key)`` text pairs; null keys dropped unless ``token``."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df.sparkSession.createDataFrame([], f"{', '.join(f'{c} {df.schema[c].dataType.simpleString()}' for c in carry)}"
                                               f"{', ' if carry else ''}feature string, key string")
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"),
                               (F.coalesce(F.col(c).cast("string"), F.lit(token)) if token is not None
                                else F.col(c).cast("string")).alias("key")) for c in cols])
    long = df.select(*carry, F.inline(pairs))
    return long.where(F.col("key").isNotNull())


STAT_MEASURES = ("count", "id_count", "nunique", "sum", "mean", "std", "min", "max")


def key_stats(df: DataFrame, cols: Iterable[str], id_col: str | None = None,
              value_col: str | None = None, measures: Sequence[str] = ("count",),
              approx_distinct: bool = False) -> DataFrame:
    """H2 / AGG-01..05: per (feature, key) statistics of many key columns in one aggregate.

    Measures: ``count`` (rows), ``share`` (rows / non-null rows of that column),
    ``id_count`` (non-null ids), ``nunique`` (distinct values), ``sum``, ``mean``,
    ``std`` (sample), ``min``, ``max`` of ``value_col``. Null keys are excluded,
    as in a pandas value count.
    """
    carry = [c for c in (id_col, value_col) if c]
    long = unpivot_keys(df, cols, carry)
    v = F.col(value_col) if value_col else None
    aggs = {
        "count": lambda: F.count(F.lit(1)).alias("count"),
        "share": lambda: F.count(F.lit(1)).alias("__n"),
        "id_count": lambda: F.count(F.col(id_col)).alias("id_count"),
        "nunique": lambda: (F.approx_count_distinct(v) if approx_distinct else F.count_distinct(v)).alias("nunique"),
        "sum": lambda: F.sum(v).alias("sum"),
        "mean": lambda: F.avg(v).alias("mean"),
        "std": lambda: F.stddev_samp(v).alias("std"),
        "min": lambda: F.min(v).alias("min"),
        "max": lambda: F.max(v).alias("max"),
    }
    stats = long.groupBy("feature", "key").agg(*[aggs[m]() for m in measures])
    if "share" in measures:
        totals = stats.groupBy("feature").agg(F.sum("__n").alias("__tot"))
        stats = (stats.join(F.broadcast(totals), "feature")
                 .withColumn("share", F.col("__n") / F.col("__tot")).drop("__n", "__tot"))
    return stats


def stats_sizes(stats: DataFrame) -> dict[str, int]:
    """Size of each feature's table in rows of BYTES_PER_STATS_ROW, the keys' own bytes added (a tiny collect: one row per feature)."""
    size = F.count(F.lit(1)) + F.ceil(F.coalesce(F.sum(F.octet_length("key")), F.lit(0)) / BYTES_PER_STATS_ROW)
    return {r["feature"]: r["n"] for r in stats.groupBy("feature").agg(size.cast("bigint").alias("n")).collect()}


def broadcastable(rows: int | None) -> bool:
    """True when a lookup table of ``rows`` rows is under the broadcast bound."""
    return rows is not None and rows * BYTES_PER_STATS_ROW <= BROADCAST_BYTES


def lookup(df: DataFrame, table: DataFrame, df_key: Column, table_key: str,
           values: Mapping[str, str], rows: int | None = None, fill=None) -> DataFrame:
    """JON-02: LEFT join ``df`` to ``table`` on a key; unseen and null keys give null (or ``fill``).

    ``values`` maps table columns to output names. ``rows`` (counted by the
    caller) decides broadcast vs shuffle join.
    """
    t = table.select(F.col(table_key).alias("__lk"), *[F.col(s).alias(o) for s, o in values.items()])
    if broadcastable(rows):
        t = F.broadcast(t)
    out = df.withColumn("__lk", df_key).join(t, "__lk", "left").drop("__lk")
    if fill is not None:
        out = out.fillna({o: fill for o in values.values()})
    return out


def apply_stats(df: DataFrame, stats: DataFrame, cols: Iterable[str], measure_names: Mapping[str, str],
                sizes: Mapping[str, int] | None = None, fill=None, token: str | None = None) -> DataFrame:
    """Map every key column through its fitted statistics: ``{col}_{suffix}`` per measure."""
    for c in cols:
        if c not in df.columns:
            continue
        per = stats.where(F.col("feature") == c)
        key = F.col(c).cast("string") if token is None else F.coalesce(F.col(c).cast("string"), F.lit(token))
        df = lookup(df, per, key, "key", {m: f"{c}_{suffix}" for m, suffix in measure_names.items()},
                    rows=(sizes or {}).get(c), fill=fill)
    return df
