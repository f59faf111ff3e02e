"""Backward as-of join with TTL (JON-03 / WIN-02, FST-01), built from unions, aggregates and windows.

Spark has no DataFrame as-of API, and a plain ``last(...) over (partition by
key order by ts)`` puts every row of a hot key into one task. Here time is
cut into buckets of ``bucket_seconds``, and the entities meet all feature
tables of one key in a single pass:

1. entities and the rows of every feature table are unioned (one carried
   struct per table) and dealt once by ``(key, bucket)``; inside a bucket rows
   are ordered by ``(ts, side, created)`` (feature rows before entity rows at
   equal time, newest ``created`` last) and the last row of each table is
   carried forward;
2. the same exchange, reused, gives one row per ``(key, bucket)`` with each
   table's last row; carried over the buckets of a key it tells what every
   bucket starts with. It has a row per key and active bucket, not per row;
3. the in-bucket match wins over the earlier-bucket one; a match older than
   its table's TTL (inclusive bound) is dropped, giving null.

Scans: every table once, and the entities once, whatever the number of tables.
Exchanges: three for each key column. Entity rows are never dropped; rows
without a key or time match nothing and are spread by their hash. Of rows that
tie in ``(ts, created)`` the one with the larger hash of its values wins; a null
``created`` counts as newest.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.time import epoch_micros

#: Rows that match nothing are dealt into so many groups.
SPREAD = 1024


@dataclass(frozen=True)
class AsofTable:
    """One feature table of a join: its rows, times, value columns, TTL and the prefix of the joined columns."""
    rows: DataFrame
    ts: str
    values: Sequence[str]
    created: str | None = None
    ttl_seconds: float | None = None
    prefix: str = ""


def asof_join_all(entities: DataFrame, tables: Sequence[AsofTable], key: str, entity_ts: str,
                  bucket_seconds: float = 3600.0) -> DataFrame:
    """Each entity row plus, from every table, its latest row with ``ts <= entity_ts`` within the TTL.

    ``bucket_seconds`` bounds the rows one task sees (one key's rows of one
    bucket); the carried-over table grows with the number of active buckets per
    key, not with the rows, so small buckets are cheap.
    """
    width = int(bucket_seconds * 1_000_000)
    # keys are wrapped in a struct, which is never null: else Catalyst would infer isnotnull(key) for one side of the last
    # join and push it into that side's scans, and the exchange below could not be shared
    known = F.col(key).isNotNull() & F.col(entity_ts).isNotNull()
    t = epoch_micros(F.col(entity_ts))
    sides = [entities.select(
        F.struct(F.when(known, F.col(key)).alias("k")).alias("__k"),
        F.when(known, F.floor(t / width)).otherwise(F.pmod(F.xxhash64(*entities.columns), F.lit(SPREAD))).alias("__b"),
        t.alias("__t"), F.lit(1).alias("__s"), F.lit(None).cast("bigint").alias("__c"), F.lit(0).cast("bigint").alias("__h"),
        F.struct(*[F.col(c) for c in entities.columns]).alias("__e"))]
    for i, x in enumerate(tables):
        ft = epoch_micros(F.col(x.ts))
        sides.append(x.rows.where(F.col(key).isNotNull() & F.col(x.ts).isNotNull()).select(
            F.struct(F.col(key).alias("k")).alias("__k"), F.floor(ft / width).alias("__b"), ft.alias("__t"), F.lit(0).alias("__s"),
            epoch_micros(F.col(x.created or x.ts)).alias("__c"), F.xxhash64(*x.values).alias("__h"),
            F.struct(*[F.col(c).alias(c) for c in x.values], ft.alias("__t")).alias(f"__v{i}")))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides).repartition("__k", "__b")
    held = [f"__v{i}" for i in range(len(tables))]

    # (1) inside the bucket
    w = (Window.partitionBy("__k", "__b").orderBy("__t", "__s", F.col("__c").asc_nulls_last(), "__h")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = rows.select("__k", "__b", "__t", "__s", "__e", *[F.last(v, ignorenulls=True).over(w).alias(v) for v in held]).where("__s = 1")

    # (2) what each bucket of the entities starts with: the same columns as (1), so that the exchange is the same
    newest = F.struct("__t", F.col("__c").isNull(), "__c", "__h")
    ends = rows.groupBy("__k", "__b").agg(F.max(F.col("__e").isNotNull() & (F.col("__s") == 1)).alias("asked"),
                                          *[F.max_by(v, F.when(F.col(v).isNotNull(), newest)).alias(v) for v in held])
    before = Window.partitionBy("__k").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    prior = ends.select("__k", "__b", "asked", *[F.last(v, ignorenulls=True).over(before).alias(f"__p{v}") for v in held]).where("asked").drop("asked")

    # (3) the newer of both, within the TTL
    j = inside.join(prior, ["__k", "__b"], "left")
    found = []
    for v, x in zip(held, tables):
        m = F.coalesce(F.col(v), F.col(f"__p{v}"))
        if x.ttl_seconds is not None:
            m = F.when(F.col("__t") - m["__t"] <= F.lit(int(x.ttl_seconds * 1_000_000)), m)
        found.append(m.alias(v))
    out = j.select("__e.*", *found)
    return out.select(*entities.columns, *[F.col(f"{v}.{c}").alias(f"{x.prefix}{c}") for v, x in zip(held, tables) for c in x.values])


def asof_join(entities: DataFrame, features: DataFrame, key: str, entity_ts: str, feature_ts: str,
              values: Sequence[str], created: str | None = None, ttl_seconds: float | None = None,
              bucket_seconds: float = 3600.0, prefix: str = "") -> DataFrame:
    """``asof_join_all`` with one feature table."""
    table = AsofTable(features, feature_ts, values, created, ttl_seconds, prefix)
    return asof_join_all(entities, [table], key, entity_ts, bucket_seconds)
