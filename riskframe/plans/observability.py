"""Observability plans: parsed logs, request series and alert evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.functions.logs import parse_log_line, parse_request_fields
from riskframe.functions.time import epoch_micros
from riskframe.operators import metrics as M
from riskframe.session import cut_lineage
from riskframe.sources import fixtures as X

MINUTE_US = 60_000_000


def parsed_logs(spark: SparkSession, d: str, lines: DataFrame | None = None) -> DataFrame:
    """M5 lines (or the given ones) parsed into fields (FUN-14 + FUN-15)."""
    p = parse_request_fields(parse_log_line(X.log_lines(spark, d) if lines is None else lines))
    return p.withColumn("log_us", epoch_micros(F.col("log_ts")))


# The alert rules (window and hold time in minutes).
RULES = (
    # name, window, threshold, hold
    ("HighErrorRate", 5, 0.05, 2),
    ("HighFraudRate", 10, 0.5, 10),
    ("SlowPredictions", 5, 1.0, 5),
)
#: P95 of a request above this many seconds (5-minute window) is an alert without hold time.
SLOW_REQUEST_SECONDS = 0.5


#: Longest span of an evaluation grid in days; a wrong timestamp beyond it is an error, not a huge table.
MAX_DAYS = 3660
DAY_MINUTES = 1440
_BUCKETS = [f"le{i}" for i in range(len(M.PREDICTION_SECONDS))] + ["timed"]


def every_minute(series: DataFrame, max_days: int = MAX_DAYS) -> DataFrame:
    """The minutes from the first to the last of ``series`` (one row each; the span in minutes, whatever the rows).

    Days are laid out first, then the minutes of each, so no row holds the whole span; more than ``max_days`` raise.
    """
    ends = series.agg(F.min("minute").alias("lo"), F.max("minute").alias("hi")).where("lo IS NOT NULL")
    day = lambda c: F.floor(F.col(c) / DAY_MINUTES).cast("bigint")
    wide = day("hi") - day("lo") >= max_days
    message = F.concat(F.lit(f"the requests span more than {max_days} days: minutes "), F.col("lo").cast("string"), F.lit(" to "), F.col("hi").cast("string"))
    hi = F.when(wide, F.raise_error(message).cast("bigint")).otherwise(F.col("hi"))
    days = ends.withColumn("hi", hi).select("lo", "hi", F.explode(F.sequence(day("lo"), day("hi"))).alias("day"))
    minutes = days.select("lo", "hi", F.explode(F.sequence(F.col("day") * DAY_MINUTES, F.col("day") * DAY_MINUTES + DAY_MINUTES - 1)).alias("minute"))
    return minutes.where((F.col("minute") >= F.col("lo")) & (F.col("minute") <= F.col("hi"))).select("minute")


def minute_series(req: DataFrame) -> DataFrame:
    """Request aggregates and duration buckets of every minute, 0 in minutes without requests: all that the alert rules need.

    The requests are aggregated once; the table (a row per minute) is written, and the rules read it only.
    """
    m = F.floor(epoch_micros(F.col("ts")) / MINUTE_US).cast("bigint")
    scored = F.col("status") != 500
    seen = cut_lineage(req.groupBy(m.alias("minute")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("status") >= 500).alias("errors"),
        F.count_if(scored).alias("scored"),
        F.count_if(scored & (F.col("probability") >= 0.5)).alias("frauds"),
        *[c.alias(b) for b, c in zip(_BUCKETS, M.bucket_counts(F.col("duration_s"), M.PREDICTION_SECONDS))]))
    return cut_lineage(every_minute(seen).join(seen, "minute", "left").fillna(0))


def trailing(series: DataFrame, minutes: int, cols) -> DataFrame:
    """Sums over the trailing ``minutes`` (RANGE frame on the minute index).

    The input is already one row per minute, so this window's single
    partition grows with the time span, not with the data volume.
    """
    w = Window.orderBy("minute").rangeBetween(-(minutes - 1), 0)
    return series.select("minute", *[F.sum(c).over(w).alias(f"{c}_w") for c in cols])


def rule_minutes(req: DataFrame) -> dict[str, tuple[DataFrame, object]]:
    """Per rule of RULES: its evaluated minutes and the condition (null where its window has no data)."""
    by = {name: (window, limit) for name, window, limit, _ in RULES}
    s = minute_series(req)
    window, limit = by["HighErrorRate"]
    errors = trailing(s, window, ["n", "errors"]), F.try_divide("errors_w", "n_w") > limit
    window, limit = by["HighFraudRate"]
    frauds = trailing(s, window, ["scored", "frauds"]), F.try_divide("frauds_w", "scored_w") > limit
    window, limit = by["SlowPredictions"]
    return {"HighErrorRate": errors, "HighFraudRate": frauds, "SlowPredictions": (_p95(s, window), F.col("p95") > limit)}


def p95_trailing(req: DataFrame, minutes: int, q: float = 0.95) -> DataFrame:
    """Histogram-bucket P95 over the trailing window, for every minute whose window has requests."""
    return _p95(minute_series(req), minutes, q)


def _p95(series: DataFrame, minutes: int, q: float = 0.95) -> DataFrame:
    t = trailing(series, minutes, _BUCKETS)
    return t.select("minute", M.quantile_of_counts([f"{b}_w" for b in _BUCKETS], M.PREDICTION_SECONDS, q).alias("p95")).where("p95 IS NOT NULL")
