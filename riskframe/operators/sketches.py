"""Mergeable sketches per time step and group (AGG-04, AGG-13, AGG-20, AGG-21: the approximate way).

A table of sketches has one row per step (an hour, say) and group: the row count, a KLL quantile sketch of each value
column and a HyperLogLog sketch of each counted column, all built by Spark's own aggregates. It is written once;
a question about any range of steps then merges stored sketches and reads no event again. Sketches of parts merge to
the sketch of the whole, so late files are further rows of the table, not a rebuild.

``QUANTILE_ERROR`` bounds the rank error of a quantile at the default size with high confidence, ``DISTINCT_ERROR``
three standard errors of a distinct count at ``HLL_BITS``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KLL_SIZE = 400
HLL_BITS = 14
QUANTILE_ERROR = 0.01
DISTINCT_ERROR = 3 * 1.04 / 2 ** (HLL_BITS / 2)


def build(df: DataFrame, ts: str, step_seconds: int, groups: Sequence[str], values: Sequence[str] = (), distinct: Sequence[str] = ()) -> DataFrame:
    """(step, groups, n, q_<value>, d_<column>): one row of sketches per step and group; nulls are in no sketch, rows without a time in no step."""
    step = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(step_seconds * 1_000_000)).cast("bigint")
    return df.where(F.col(ts).isNotNull()).groupBy(step.alias("step"), *groups).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.kll_sketch_agg_double(F.col(v).cast("double"), F.lit(KLL_SIZE)).alias(f"q_{v}") for v in values],
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(HLL_BITS)).alias(f"d_{c}") for c in distinct])


def merge(sketches: DataFrame, groups: Sequence[str], first: int | None = None, last: int | None = None) -> DataFrame:
    """The sketches of the steps from ``first`` to ``last`` (both included), merged per group."""
    s = sketches
    if first is not None:
        s = s.where(F.col("step") >= first)
    if last is not None:
        s = s.where(F.col("step") <= last)
    aggs = [F.sum("n").alias("n")]
    aggs += [F.kll_merge_agg_double(c, F.lit(KLL_SIZE)).alias(c) for c in s.columns if c.startswith("q_")]
    aggs += [F.hll_union_agg(c).alias(c) for c in s.columns if c.startswith("d_")]
    return s.groupBy(*groups).agg(*aggs)


def read(merged: DataFrame, groups: Sequence[str], quantiles: Mapping[str, Sequence[float]]) -> DataFrame:
    """Estimates of merged sketches: ``<value>_p<q>`` per quantile asked for, ``<column>_distinct`` per distinct sketch."""
    out = []
    for v, qs in quantiles.items():
        some = F.kll_sketch_get_n_double(f"q_{v}") > 0
        out += [F.when(some, F.kll_sketch_get_quantile_double(f"q_{v}", F.lit(float(q)))).alias(f"{v}_p{q * 100:g}".replace(".", "_")) for q in qs]
    out += [F.hll_sketch_estimate(c).alias(f"{c[2:]}_distinct") for c in merged.columns if c.startswith("d_")]
    return merged.select(*groups, "n", *out)
