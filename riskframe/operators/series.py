"""Time-series operators over raw events and counter samples (WIN-03, WIN-05, WIN-06, OBS-01..05)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_instant(c) -> Column:
    """TIMESTAMP_NTZ to TIMESTAMP under the UTC session zone (event-time windows, watermarks)."""
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp")


def window_counts(df: DataFrame, ts: str, size: str, slide: str | None = None, groups: Sequence = (),
                  aggs: Sequence[Column] = ()) -> DataFrame:
    """Tumbling (or sliding) event-time windows with counts and extra aggregates per group.

    Output has ``window_start_us`` (epoch micros) instead of the window struct.
    """
    w = F.window(as_instant(ts), size, slide) if slide else F.window(as_instant(ts), size)
    g = df.groupBy(w.alias("w"), *groups).agg(F.count(F.lit(1)).alias("n"), *aggs)
    return g.withColumn("window_start_us", F.unix_micros(F.col("w.start"))).drop("w")


def window_rate(df: DataFrame, ts: str, size_seconds: int, slide_seconds: int, groups: Sequence = ()) -> DataFrame:
    """OBS-01 / WIN-03 on raw events: events per second over a sliding window.

    Events are counted per slide step first; only those counts are copied to
    the windows that hold the step (``size`` must be a multiple of ``slide``).
    """
    if size_seconds % slide_seconds:
        raise ValueError("the window must be a multiple of its slide")
    step = F.floor(F.unix_micros(as_instant(ts)) / F.lit(slide_seconds * 1_000_000)).cast("bigint")
    g = df.where(F.col(ts).isNotNull()).groupBy(step.alias("__step"), *groups).agg(F.count(F.lit(1)).alias("__n"))
    g = g.withColumn("__w", F.explode(F.sequence(F.col("__step") - (size_seconds // slide_seconds - 1), F.col("__step"))))
    g = g.groupBy("__w", *groups).agg(F.sum("__n").alias("n"))
    g = g.withColumn("window_start_us", F.col("__w") * F.lit(slide_seconds * 1_000_000)).drop("__w")
    return g.withColumn("rate", F.col("n") / F.lit(float(size_seconds)))


def counter_deltas(samples: DataFrame, series: Sequence[str], ts: str, value: str, bucket: int) -> DataFrame:
    """Add ``__b`` (time bucket of ``bucket`` units) and ``__d``: what a counter grew by since the sample before.

    After a reset (value went down) the growth is the value itself; a series' first sample has none. A series is cut into
    time buckets, each a partition of its own; the value before a bucket is the last of the buckets before, from one row
    per series and bucket. So a series with very many samples is many tasks.
    """
    rows = samples.withColumn("__b", F.floor(F.col(ts) / F.lit(bucket)).cast("bigint"))
    w = Window.partitionBy(*series, "__b").orderBy(ts, value)
    last = rows.groupBy(*series, "__b").agg(F.max_by(value, F.struct(ts, value)).alias("__v"))
    before = Window.partitionBy(*series).orderBy("__b")
    carried = last.select(*[F.col(c).alias(f"__s{i}") for i, c in enumerate(series)], F.col("__b").alias("__sb"), F.lag("__v").over(before).alias("__before"))
    own = rows.withColumn("__prev", F.lag(value).over(w))
    same = [F.col(c).eqNullSafe(F.col(f"__s{i}")) for i, c in enumerate(series)] + [F.col("__b") == F.col("__sb")]
    on = same[0]
    for c in same[1:]:
        on = on & c
    prev = F.coalesce("__prev", "__before")
    return own.join(carried, on, "left").select(*samples.columns, "__b", F.when(prev.isNull(), F.lit(0)).when(F.col(value) < prev, F.col(value))
                                                .otherwise(F.col(value) - prev).alias("__d"))


def _with_range_before(deltas: DataFrame) -> DataFrame:
    """Every row in its own bucket, and once more (``__own`` false) in the next, whose ranges reach back to it."""
    return deltas.withColumn("__x", F.explode(F.array(F.struct(F.col("__b").alias("at"), F.lit(True).alias("own")),
                                                      F.struct((F.col("__b") + 1).alias("at"), F.lit(False).alias("own"))))) \
                 .withColumn("__at", F.col("__x.at")).withColumn("__own", F.col("__x.own")).drop("__x")


def counter_increase(samples: DataFrame, series: Sequence[str], ts_us: str, value: str,
                     range_us: int, bucket_us: int | None = None) -> DataFrame:
    """WIN-03 on counter samples: increase over a trailing range, resets handled.

    The increase is the sum of the growths (``counter_deltas``) in ``(t - range, t]``. The window works in time buckets of
    at least the range, together with the bucket before, so no task holds a whole series.
    """
    bucket = max(range_us, bucket_us or 64 * range_us)
    d = _with_range_before(counter_deltas(samples, series, ts_us, value, bucket))
    wr = Window.partitionBy(*series, "__at").orderBy(ts_us).rangeBetween(-(range_us - 1), 0)
    return d.withColumn("increase", F.sum("__d").over(wr)).where("__own").select(*samples.columns, "increase")


def counter_rate(samples: DataFrame, series: Sequence[str], ts_us: str, value: str, range_us: int, units_per_second: float = 1e6,
                 bucket_us: int | None = None) -> DataFrame:
    """WIN-03 as a monitoring query means ``rate(counter[range])``: growth per second at every sample, its edges handled.

    The growth between the first and the last sample of ``(t - range, t]`` is carried on to the ends of the range: on
    either side by the gap to it, or by half the samples' mean spacing if the gap is more than 1.1 of it, and
    backwards never beyond where the counter would have been 0. Fewer than two samples give null.
    """
    bucket = max(range_us, bucket_us or 64 * range_us)
    d = _with_range_before(counter_deltas(samples, series, ts_us, value, bucket))
    wr = Window.partitionBy(*series, "__at").orderBy(ts_us).rangeBetween(-(range_us - 1), 0)
    d = d.select("*", F.count(F.lit(1)).over(wr).alias("__n"), F.min(ts_us).over(wr).alias("__t0"), F.first("__d").over(wr).alias("__d0"),
                 F.first(value).over(wr).alias("__v0"), F.sum("__d").over(wr).alias("__sum")).where("__own")
    span = (F.col(ts_us) - F.col("__t0")).cast("double")
    grown = (F.col("__sum") - F.col("__d0")).cast("double")
    spacing = span / (F.col("__n") - 1)
    gap = (F.col("__t0") - (F.col(ts_us) - F.lit(range_us))).cast("double")
    to_zero = F.when((grown > 0) & (F.col("__v0") >= 0), span * F.col("__v0") / grown)
    start = F.least(F.when(gap < spacing * 1.1, gap).otherwise(spacing / 2), to_zero)
    rate = grown * (span + start) / span / F.lit(range_us / units_per_second)
    return d.select(*samples.columns, F.when((F.col("__n") > 1) & (span > 0), rate).alias("rate"))


def islands(df: DataFrame, groups: Sequence[str], step_col: str, cond: Column, min_steps: int = 1) -> DataFrame:
    """WIN-05 gaps-and-islands: runs of consecutive integer steps where ``cond`` holds.

    Returns one row per run: ``start_step``, ``end_step``, ``steps``; runs
    shorter than ``min_steps`` are dropped (the "for" duration of an alert).
    """
    t = df.where(cond).select(*groups, step_col)
    w = Window.partitionBy(*groups).orderBy(step_col)
    t = t.withColumn("__grp", F.col(step_col) - F.row_number().over(w))
    r = t.groupBy(*groups, "__grp").agg(F.min(step_col).alias("start_step"), F.max(step_col).alias("end_step"),
                                        F.count(F.lit(1)).alias("steps"))
    return r.where(F.col("steps") >= min_steps).drop("__grp")


def spikes(df: DataFrame, groups: Sequence[str], step_col: str, count_col: str, ratio: float = 1.5) -> DataFrame:
    """WIN-06: count at least ``ratio`` x the previous step's count (same group, consecutive step)."""
    w = Window.partitionBy(*groups).orderBy(step_col)
    prev = F.lag(count_col).over(w)
    prev_step = F.lag(step_col).over(w)
    x = df.withColumn("prev_count", F.when(prev_step == F.col(step_col) - 1, prev))
    return x.withColumn("spike", F.coalesce(F.col(count_col) >= F.col("prev_count") * ratio, F.lit(False)))


def apdex(duration: Column, threshold: float) -> tuple[Column, Column]:
    """Satisfied (<= T) and tolerating (<= 4T) indicators for the Apdex score."""
    return (duration <= threshold).cast("int"), ((duration > threshold) & (duration <= 4 * threshold)).cast("int")
