"""Queries over logs (M5), spans (M6) and request metrics (M7)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskframe.functions import logs as L
from riskframe.functions import scalar as S
from riskframe.functions.time import epoch_micros
from riskframe.operators import metrics as M
from riskframe.operators import series as SE
from riskframe.operators import sketches as SKT
from riskframe.operators import traces as TR
from riskframe.plans import observability as OB
from riskframe.plans.catalog_monitoring import _CM_SQL, _RATES_SQL, _hist_sql
from riskframe.plans.registry import register
from riskframe.session import scratch_path
from riskframe.sources import fixtures as X

W = X.with_ctes
LP = L.LINE_PATTERN


def _x(i: int, pat: str = LP, src: str = "value") -> str:
    return f"NULLIF(regexp_extract({src}, '{pat}', {i}), '')"


PARSED_SQL = W("logs") + f"""
, p0 AS (SELECT line_no, value, {_x(1)} AS t1, {_x(2)} AS ms, {_x(3)} AS logger, {_x(4)} AS level,
                {_x(5)} AS function, TRY_CAST({_x(6)} AS INTEGER) AS line, {_x(7)} AS message,
                {_x(1, L.TRACE_PATTERN)} AS trace_id, {_x(1, L.REQUEST_PATTERN)} AS kind,
                {_x(2, L.REQUEST_PATTERN)} AS method, {_x(3, L.REQUEST_PATTERN)} AS path,
                TRY_CAST({_x(1, L.STATUS_PATTERN)} AS INTEGER) AS status,
                TRY_CAST({_x(1, L.DURATION_PATTERN)} AS DOUBLE) AS dur, {_x(2, L.DURATION_PATTERN)} AS unit
         FROM logs)
, pl AS (SELECT *, epoch_us(strptime(t1, '%Y-%m-%d %H:%M:%S') + to_milliseconds(COALESCE(CAST(ms AS INTEGER), 0))) AS log_us,
                CASE WHEN unit = 'ms' THEN dur / 1000.0 ELSE dur END AS duration_s FROM p0)
"""
SPANS = W("spans")
REQ = W("req")
CALLS_SQL = (PARSED_SQL.replace("WITH logs AS (" + X.SQL["logs"] + ")", "WITH logs AS (" + X.SQL["calls"] + ")", 1).replace(
    f"{_x(2, L.DURATION_PATTERN)} AS unit", f"{_x(2, L.DURATION_PATTERN)} AS unit, {_x(1, L.CLIENT_PATTERN)} AS client, {_x(1, L.PROBABILITY_PATTERN)} AS prob"))


def _logs(spark, d):
    return OB.parsed_logs(spark, d)


# ---------------------------------------------------------------- FUN-14, FUN-15
@register("fun_14_parse_log_line", PARSED_SQL + "SELECT line_no, log_us, logger, level, function, line, message FROM pl")
def fun_14_parse_log_line(spark, d):
    """Log line to time (milliseconds optional), logger, level, function, line and message."""
    return _logs(spark, d).select("line_no", "log_us", "logger", "level", "function", "line", "message")


@register("fun_15_request_fields", PARSED_SQL + """
SELECT line_no, trace_id, kind, method, path, status, round(duration_s, 6) AS duration_s FROM pl""")
def fun_15_request_fields(spark, d):
    """Trace id, kind, method, path, status and duration extracted from the message."""
    p = _logs(spark, d)
    return p.select("line_no", "trace_id", "kind", "method", "path", "status",
                    F.round("duration_s", 6).alias("duration_s"))


# ---------------------------------------------------------------- FLT-02 .. FLT-07
@register("flt_02_label_filters", REQ + """
SELECT event_id, status, service, endpoint FROM req
WHERE regexp_full_match(CAST(status AS VARCHAR), '5..')
  AND regexp_full_match(service, 'fraud_detection_api|preprocessing_service') AND endpoint <> '/view'""")
def flt_02_label_filters(spark, d):
    """Label matchers: status =~ "5..", service =~ "a|b" (anchored), endpoint != "/view"."""
    r = X.requests(spark, d)
    cond = (F.col("status").cast("string").rlike("^(?:5..)$")
            & F.col("service").rlike("^(?:fraud_detection_api|preprocessing_service)$")
            & (F.col("endpoint") != "/view"))
    return r.where(cond).select("event_id", "status", "service", "endpoint")


@register("flt_02_level_at_least", PARSED_SQL + """
SELECT line_no, level FROM pl WHERE level IN ('WARNING', 'ERROR', 'CRITICAL')""")
def flt_02_level_at_least(spark, d):
    """Severity at or above WARNING."""
    p = _logs(spark, d)
    return p.where(L.level_rank("level") >= L.LEVELS.index("WARNING")).select("line_no", "level")


@register("flt_03_line_filters", W("logs") + """
SELECT line_no FROM logs
WHERE (contains(value, 'Status: 500') OR contains(value, 'Status: 404')) AND NOT contains(value, '/metrics')
  AND regexp_matches(value, 'Duration: [1-4][0-9]{2}\\.')""")
def flt_03_line_filters(spark, d):
    """Line filters: contains (OR of two), not contains, regex."""
    lg = X.log_lines(spark, d)
    v = F.col("value")
    cond = ((v.contains("Status: 500") | v.contains("Status: 404")) & ~v.contains("/metrics")
            & v.rlike(r"Duration: [1-4][0-9]{2}\."))
    return lg.where(cond).select("line_no")


@register("flt_04_parsed_number", PARSED_SQL + "SELECT line_no, round(duration_s, 6) AS duration_s FROM pl WHERE duration_s > 0.25")
def flt_04_parsed_number(spark, d):
    """A number parsed out of the text, then filtered (duration > 250 ms)."""
    p = _logs(spark, d)
    return p.where(F.col("duration_s") > 0.25).select("line_no", F.round("duration_s", 6).alias("duration_s"))


@register("flt_05_span_filter", SPANS + """
SELECT span_id FROM spans
WHERE service = 'fraud-detection-api' AND status = 'error' AND duration_ms > 100 AND attr_user_id < 100""")
def flt_05_span_filter(spark, d):
    """Span predicates: service, status, duration and an attribute comparison, ANDed."""
    s = X.spans(spark, d)
    cond = ((F.col("service") == "fraud-detection-api") & (F.col("status") == "error")
            & (F.col("duration_ms") > 100) & (F.col("attributes")["user_id"].try_cast("int") < 100))
    return s.where(cond).select("span_id")


@register("flt_06_exception_filter", PARSED_SQL + """
SELECT line_no, level, CASE WHEN logger = 'fraud_detection_api' THEN 'api' ELSE 'preprocessing' END AS service_type
FROM pl WHERE level IN ('ERROR', 'WARNING') AND NOT contains(message, '404')""")
def flt_06_exception_filter(spark, d):
    """Exceptions without "404" kept and tagged with a service type (tag map extended with map_concat)."""
    p = _logs(spark, d).where(F.col("level").isin("ERROR", "WARNING") & ~F.col("message").contains("404"))
    tags = F.map_concat(F.create_map(F.lit("logger"), F.col("logger")),
                        F.create_map(F.lit("service_type"),
                                     F.when(F.col("logger") == "fraud_detection_api", "api").otherwise("preprocessing")))
    return p.select("line_no", "level", tags["service_type"].alias("service_type"))


@register("flt_07_time_range", PARSED_SQL + """
SELECT line_no FROM pl WHERE log_us >= epoch_us(TIMESTAMP '2024-01-10') AND log_us < epoch_us(TIMESTAMP '2024-01-11')""")
def flt_07_time_range(spark, d):
    """Log lines in [from, to)."""
    p = _logs(spark, d)
    lo, hi = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-11 00:00:00").cast("timestamp_ntz")
    return p.where((F.col("log_ts") >= lo) & (F.col("log_ts") < hi)).select("line_no")


# ---------------------------------------------------------------- AGG-19, TOP-03
@register("agg_19_level_counts", PARSED_SQL + "SELECT level, count(*) AS n FROM pl GROUP BY level")
def agg_19_level_counts(spark, d):
    """Log lines by level."""
    return _logs(spark, d).groupBy("level").agg(F.count(F.lit(1)).alias("n"))


@register("agg_19_errors_per_hour", PARSED_SQL + """
SELECT (log_us // 3600000000) * 3600000000 AS hour_us, count(*) AS errors FROM pl WHERE level = 'ERROR' GROUP BY 1""")
def agg_19_errors_per_hour(spark, d):
    """ERROR lines per hour."""
    p = _logs(spark, d).where(F.col("level") == "ERROR")
    g = SE.window_counts(p, "log_ts", "1 hour")
    return g.select(F.col("window_start_us").alias("hour_us"), F.col("n").alias("errors"))


@register("agg_19_mean_duration", PARSED_SQL + "SELECT path, round(avg(duration_s), 6) AS mean_duration_s FROM pl GROUP BY path")
def agg_19_mean_duration(spark, d):
    """Mean parsed duration per path."""
    p = _logs(spark, d)
    return p.groupBy("path").agg(F.round(F.avg("duration_s"), 6).alias("mean_duration_s"))


_MSG = r"Response: \S+ \S+ - Status: \d{3}"


@register("top_03_common_errors", PARSED_SQL + f"""
SELECT regexp_extract(message, '{_MSG}', 0) AS error, count(*) AS n FROM pl WHERE level IN ('ERROR', 'WARNING')
GROUP BY 1 ORDER BY n DESC, error LIMIT 10""")
def top_03_common_errors(spark, d):
    """Ten most common error messages (request part of the message)."""
    p = _logs(spark, d).where(F.col("level").isin("ERROR", "WARNING"))
    g = p.groupBy(F.regexp_extract("message", _MSG, 0).alias("error")).agg(F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.col("n").desc(), "error").limit(10)


@register("fun_15_call_fields", CALLS_SQL + """
SELECT line_no, trace_id, kind, method, path, client, status, round(duration_s, 6) AS duration_s,
       CASE WHEN prob LIKE '%\\%' ESCAPE '\\' THEN TRY_CAST(rtrim(prob, '%') AS DOUBLE) / 100 ELSE TRY_CAST(prob AS DOUBLE) END AS probability FROM pl""")
def fun_15_call_fields(spark, d):
    """All fields of request, response and prediction lines, client and probability (in percent) included."""
    p = OB.parsed_logs(spark, d, X.call_lines(spark, d))
    return p.select("line_no", "trace_id", "kind", "method", "path", "client", "status", F.round("duration_s", 6).alias("duration_s"), "probability")


# ---------------------------------------------------------------- JON-05 .. JON-08
@register("jon_05_logs_spans", PARSED_SQL.replace("WITH ", "WITH spans AS (" + X.SQL["spans"] + "),\n", 1) + """
SELECT pl.line_no, s.span_id FROM pl JOIN spans s ON CAST(pl.trace_id AS BIGINT) = s.trace_id
WHERE abs(pl.log_us - epoch_us(s.start_ts)) <= 60000000""")
def jon_05_logs_spans(spark, d):
    """Log lines joined to spans of the same trace with log time within +-1 minute of the span start."""
    # join keys made non-null (a negative key of its own never matches a span): otherwise Catalyst infers
    # isnotnull(key) filters and pushes them into the scan, re-running the whole parse there
    p = _logs(spark, d).select("line_no", F.coalesce(F.col("trace_id").try_cast("bigint"), -1 - F.col("line_no"), F.lit(-1)).alias("trace_id"),
                               F.coalesce(F.col("log_us"), F.lit(-1)).alias("log_us"))
    p = p.withColumn("bucket", F.coalesce(F.floor(F.col("log_us") / 60_000_000).cast("bigint"), F.lit(-1).cast("bigint")))
    s = X.spans(spark, d).select("trace_id", "span_id", epoch_micros(F.col("start_ts")).alias("span_us"))
    b = F.floor(F.col("span_us") / 60_000_000).cast("bigint")
    s = s.withColumn("bucket", F.explode(F.sequence(b - 1, b + 1)))
    # (trace, minute) keys: pairs are formed only between rows at most two minutes apart,
    # never across a whole (possibly huge) trace; the exact +-1 minute test follows
    j = p.join(s, ["trace_id", "bucket"]).where(F.abs(F.col("log_us") - F.col("span_us")) <= 60_000_000)
    return j.select("line_no", "span_id")


@register("jon_06_spans_metrics", W("spans", "req") + """
, mw AS (SELECT service, (epoch_us(ts) // 60000000) * 60000000 AS window_start_us, count(*) AS n FROM req GROUP BY ALL)
SELECT s.span_id, mw.window_start_us, mw.n FROM spans s JOIN mw ON replace(s.service, '-', '_') = mw.service
WHERE abs(mw.window_start_us - epoch_us(s.start_ts)) <= 60000000""")
def jon_06_spans_metrics(spark, d):
    """Spans joined to per-minute metric windows of the same service within +-1 minute.

    Equi-join on (service, minute bucket) with the windows, one row per service
    and minute, exploded to their three neighbouring buckets, then the exact
    range test: no range join, and every span is read once.
    """
    mw = SE.window_counts(X.requests(spark, d), "ts", "1 minute", groups=["service"])
    at = F.floor(F.col("window_start_us") / 60_000_000).cast("bigint")
    mw = mw.withColumn("bucket", F.explode(F.sequence(at - 1, at + 1)))
    s = X.spans(spark, d).select("span_id", F.regexp_replace("service", "-", "_").alias("service"),
                                  epoch_micros(F.col("start_ts")).alias("span_us"))
    s = s.withColumn("bucket", F.floor(F.col("span_us") / 60_000_000).cast("bigint"))
    j = s.join(mw, ["service", "bucket"]).where(F.abs(F.col("window_start_us") - F.col("span_us")) <= 60_000_000)
    return j.select("span_id", "window_start_us", "n")


@register("jon_07_request_response", PARSED_SQL + """
SELECT CAST(trace_id AS BIGINT) AS trace_id, arg_min(line_no, (log_us, line_no)) AS first_line,
       arg_max(line_no, (log_us, line_no)) AS last_line, max(log_us) - min(log_us) AS span_us
FROM pl GROUP BY 1""")
def jon_07_request_response(spark, d):
    """First and last log line of each trace (request / response pair) and the time between them."""
    p = _logs(spark, d)
    o = F.struct("log_us", "line_no")
    return p.groupBy(F.col("trace_id").try_cast("bigint").alias("trace_id")).agg(
        F.min_by("line_no", o).alias("first_line"), F.max_by("line_no", o).alias("last_line"),
        (F.max("log_us") - F.min("log_us")).alias("span_us"))


@register("jon_07_paired_calls", CALLS_SQL + """
, r AS (SELECT *, row_number() OVER (PARTITION BY trace_id, method, path, kind ORDER BY log_us, line_no) AS k FROM pl WHERE kind IS NOT NULL)
, q AS (SELECT * FROM r WHERE kind = 'Request'), p AS (SELECT * FROM r WHERE kind = 'Response')
SELECT coalesce(q.trace_id, p.trace_id) AS trace_id, coalesce(q.method, p.method) AS method, coalesce(q.path, p.path) AS path, coalesce(q.k, p.k) AS k,
       q.line_no AS request_line_no, p.line_no AS response_line_no, p.status, round((p.log_us - q.log_us) / 1e6, 6) AS seconds,
       CASE WHEN q.k IS NULL THEN 'lost' WHEN p.k IS NULL THEN 'open' ELSE 'paired' END AS status_pair
FROM q FULL JOIN p ON q.trace_id = p.trace_id AND q.method = p.method AND q.path = p.path AND q.k = p.k""")
def jon_07_paired_calls(spark, d):
    """Requests paired with their responses inside a trace, open and lost ones kept, and the seconds between."""
    pairs = L.pair_requests(OB.parsed_logs(spark, d, X.call_lines(spark, d)))
    return pairs.select("trace_id", "method", "path", "k", "request_line_no", "response_line_no", "status",
                        F.round((F.col("response_log_us") - F.col("request_log_us")) / 1e6, 6).alias("seconds"), "status_pair")


@register("jon_08_parent_child", SPANS + """
SELECT c.trace_id, c.parent_span_id, c.span_id AS child_span_id, c.service AS child_service, p.service AS parent_service
FROM spans c JOIN spans p ON c.trace_id = p.trace_id AND c.parent_span_id = p.span_id""")
def jon_08_parent_child(spark, d):
    """Parent span to child span edges within a trace."""
    e = TR.edges(X.spans(spark, d))
    return e.select("trace_id", "parent_span_id", "child_span_id", "child_service", "parent_service")


# ---------------------------------------------------------------- WIN-07, AGG-20 .. AGG-23
@register("win_07_span_depth_offset", SPANS + """
, t0 AS (SELECT trace_id, min(epoch_us(start_ts)) AS t0 FROM spans GROUP BY trace_id)
SELECT s.span_id, epoch_us(s.start_ts) - t0.t0 AS offset_us,
       CAST(floor(log2(s.span_id % 5 + 1)) AS INTEGER) AS depth
FROM spans s JOIN t0 USING (trace_id)""")
def win_07_span_depth_offset(spark, d):
    """Offset of each span from its trace start and its depth in the trace tree (level-by-level joins)."""
    s = TR.offsets(X.spans(spark, d))
    dep = TR.depths(s)
    return dep.select("span_id", "offset_us", "depth")


@register("agg_20_span_stats", SPANS + """
SELECT service, name, count(*) AS n, round(avg(duration_ms), 6) AS mean_ms,
       round(quantile_cont(duration_ms, 0.95), 6) AS p95_ms FROM spans GROUP BY ALL""")
def agg_20_span_stats(spark, d):
    """Span count, mean and P95 duration by service and operation."""
    s = X.spans(spark, d)
    g = s.groupBy("service", "name").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("duration_ms"), 6).alias("mean_ms"))
    q = M.quantiles(s, "duration_ms", [0.95], ["service", "name"], ["p95_ms"])
    return g.join(q, ["service", "name"]).withColumn("p95_ms", F.round("p95_ms", 6))


APDEX_T = 0.1


@register("agg_21_transaction_perf", REQ + f"""
SELECT endpoint, count(*) AS n,
       round(quantile_cont(duration_s, 0.5), 6) AS p50, round(quantile_cont(duration_s, 0.75), 6) AS p75,
       round(quantile_cont(duration_s, 0.95), 6) AS p95, round(quantile_cont(duration_s, 0.99), 6) AS p99,
       round(count(*) / NULLIF((max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6, 0), 9) AS throughput_per_s,
       round(count_if(status >= 500) / count(*), 6) AS failure_rate,
       round((count_if(duration_s <= {APDEX_T}) + count_if(duration_s > {APDEX_T} AND duration_s <= {4 * APDEX_T}) / 2.0)
             / count(*), 6) AS apdex
FROM req GROUP BY endpoint""")
def agg_21_transaction_perf(spark, d):
    """Per endpoint: P50/75/95/99, throughput, failure rate and Apdex (T = 0.1 s)."""
    r = X.requests(spark, d)
    sat, tol = SE.apdex(F.col("duration_s"), APDEX_T)
    us = epoch_micros(F.col("ts"))
    qs = M.quantiles(r, "duration_s", [0.5, 0.75, 0.95, 0.99], ["endpoint"])
    qs = qs.select("endpoint", *[F.round(c, 6).alias(c) for c in ("p50", "p75", "p95", "p99")])
    return qs.join(r.groupBy("endpoint").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.try_divide(F.count(F.lit(1)), (F.max(us) - F.min(us)) / 1e6), 9).alias("throughput_per_s"),
        F.round(F.count_if(F.col("status") >= 500) / F.count(F.lit(1)), 6).alias("failure_rate"),
        F.round((F.sum(sat) + F.sum(tol) / 2.0) / F.count(F.lit(1)), 6).alias("apdex")), "endpoint")


SKETCH_FIRST, SKETCH_LAST = 473424, 473760   # hours: two weeks of January 2024


@register("agg_21_sketched_range", REQ + f"""
SELECT endpoint, count(*) AS n, true AS p50_in_bound, true AS p95_in_bound, true AS p99_in_bound, true AS users_in_bound
FROM req WHERE epoch_us(ts) // 3600000000 BETWEEN {SKETCH_FIRST} AND {SKETCH_LAST} GROUP BY endpoint""")
def agg_21_sketched_range(spark, d):
    """Quantiles and distinct users per endpoint over a range of hours from stored sketches, held against the rows' own ranks and counts."""
    r = X.requests(spark, d)
    path = scratch_path(spark, "sketches")
    SKT.build(r, "ts", 3600, ["endpoint"], ["duration_s"], ["user_id"]).write.parquet(path)
    qs = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    est = SKT.read(SKT.merge(spark.read.parquet(path), ["endpoint"], SKETCH_FIRST, SKETCH_LAST), ["endpoint"], {"duration_s": qs.values()})
    hour = F.floor(epoch_micros(F.col("ts")) / 3_600_000_000)
    rows = r.where((hour >= SKETCH_FIRST) & (hour <= SKETCH_LAST)).select("endpoint", "duration_s", "user_id").join(est, "endpoint")
    # the share of rows below and up to an estimate has to hold its quantile, give or take the bound
    ranks = rows.groupBy("endpoint", "n", "user_id_distinct").agg(
        F.count_distinct("user_id").alias("users"),
        *[c.alias(f"{name}_{side}") for name in qs for side, c in (
            ("below", F.count_if(F.col("duration_s") < F.col(f"duration_s_{name}")) / F.count("duration_s")),
            ("upto", F.count_if(F.col("duration_s") <= F.col(f"duration_s_{name}")) / F.count("duration_s")))])
    return ranks.select("endpoint", "n", *[((F.col(f"{name}_below") <= q + SKT.QUANTILE_ERROR) & (F.col(f"{name}_upto") >= q - SKT.QUANTILE_ERROR))
                                           .alias(f"{name}_in_bound") for name, q in qs.items()],
                        (F.abs(F.col("user_id_distinct") - F.col("users")) <= F.greatest(F.lit(1.0), F.col("users") * SKT.DISTINCT_ERROR)).alias("users_in_bound"))


_RELEASE_CUT = "2024-01-15 00:00:00"


@register("agg_22_issues", REQ + f"""
SELECT endpoint || ' ' || CAST(status AS VARCHAR) AS error_type,
       CASE WHEN ts < TIMESTAMP '{_RELEASE_CUT}' THEN 'v1' ELSE 'v2' END AS release,
       count(*) AS n, min(epoch_us(ts)) AS first_seen_us, max(epoch_us(ts)) AS last_seen_us
FROM req WHERE status >= 400 GROUP BY ALL""")
def agg_22_issues(spark, d):
    """Issues: frequency, first and last seen, by error type and release."""
    r = X.requests(spark, d).where(F.col("status") >= 400)
    us = epoch_micros(F.col("ts"))
    rel = F.when(F.col("ts") < F.lit(_RELEASE_CUT).cast("timestamp_ntz"), "v1").otherwise("v2")
    return r.groupBy(F.concat_ws(" ", "endpoint", F.col("status").cast("string")).alias("error_type"),
                     rel.alias("release")).agg(F.count(F.lit(1)).alias("n"), F.min(us).alias("first_seen_us"),
                                               F.max(us).alias("last_seen_us"))


@register("agg_23_service_graph", SPANS + """
SELECT p.service AS parent_service, c.service AS child_service, count(*) AS calls,
       round(count_if(c.status = 'error') / count(*), 6) AS error_rate
FROM spans c JOIN spans p ON c.trace_id = p.trace_id AND c.parent_span_id = p.span_id GROUP BY ALL""")
def agg_23_service_graph(spark, d):
    """Service graph edges with call count and error rate."""
    g = TR.service_graph(X.spans(spark, d))
    return g.withColumn("error_rate", F.round("error_rate", 6))


# ---------------------------------------------------------------- FUN-19, TOP-04
@register("fun_19_trace_sampling", SPANS + """
SELECT DISTINCT trace_id, substr(md5(CAST(trace_id AS VARCHAR)), 1, 4) < '4000' AS sampled FROM spans""")
def fun_19_trace_sampling(spark, d):
    """Whole-trace sampling at ratio 0.25 by md5 of the trace id."""
    s = X.spans(spark, d).select("trace_id").distinct()
    return s.select("trace_id", S.trace_sampled(F.col("trace_id"), 0.25).alias("sampled"))


@register("top_04_slowest_spans", SPANS + """
SELECT span_id, duration_ms FROM spans WHERE duration_ms > 400 ORDER BY duration_ms DESC, span_id LIMIT 20""")
def top_04_slowest_spans(spark, d):
    """Slowest 20 spans above 400 ms, slowest first."""
    s = X.spans(spark, d).where(F.col("duration_ms") > 400)
    return s.orderBy(F.col("duration_ms").desc(), "span_id").limit(20).select("span_id", "duration_ms")


@register("top_04_newest_traces", SPANS + """
SELECT trace_id, epoch_us(min(start_ts)) AS start_us FROM spans GROUP BY trace_id ORDER BY start_us DESC, trace_id LIMIT 20""")
def top_04_newest_traces(spark, d):
    """Newest 20 traces by start time."""
    s = X.spans(spark, d).groupBy("trace_id").agg(F.min(epoch_micros(F.col("start_ts"))).alias("start_us"))
    return s.orderBy(F.col("start_us").desc(), "trace_id").limit(20)


# ---------------------------------------------------------------- WIN-03, OBS-01 .. OBS-07
@register("win_03_window_rate", REQ + """
, b AS (SELECT *, epoch_us(ts) // 60000000 AS m FROM req)
, x AS (SELECT service, (m - k) * 60000000 AS window_start_us FROM b, range(0, 5) t(k))
SELECT service, window_start_us, count(*) AS n, round(count(*) / 300.0, 9) AS rate FROM x GROUP BY ALL""")
def win_03_window_rate(spark, d):
    """Request rate per second over 5-minute windows sliding by 1 minute, per service (OBS-01)."""
    r = SE.window_rate(X.requests(spark, d), "ts", 300, 60, ["service"])
    return r.select("service", "window_start_us", "n", F.round("rate", 9).alias("rate"))


_COUNTER_SQL = REQ + """
, pm AS (SELECT service, epoch_us(ts) // 60000000 AS minute, count(*) AS k FROM req GROUP BY ALL)
, samples AS (SELECT service, minute, CAST(sum(k) OVER (PARTITION BY service, minute // 1440 ORDER BY minute) AS BIGINT) AS counter FROM pm)
, d AS (SELECT *, CASE WHEN lag(counter) OVER w IS NULL THEN 0 WHEN counter < lag(counter) OVER w THEN counter
                       ELSE counter - lag(counter) OVER w END AS delta
        FROM samples WINDOW w AS (PARTITION BY service ORDER BY minute))
SELECT service, minute, counter, CAST(sum(delta) OVER (PARTITION BY service ORDER BY minute RANGE BETWEEN 4 PRECEDING AND CURRENT ROW) AS BIGINT) AS increase
FROM d"""


@register("win_03_counter_increase", _COUNTER_SQL)
def win_03_counter_increase(spark, d):
    """Counter samples (per-service request counter restarting daily) -> 5-minute increase with resets."""
    return SE.counter_increase(_counter_samples(spark, d), ["service"], "minute", "counter", 5)


def _counter_samples(spark, d):
    """Per service and minute, the requests of the day so far."""
    pm = X.requests(spark, d).groupBy("service", F.floor(epoch_micros(F.col("ts")) / 60_000_000).cast("bigint").alias("minute")) \
          .agg(F.count(F.lit(1)).alias("k"))
    w = Window.partitionBy("service", F.floor(F.col("minute") / 1440)).orderBy("minute")
    return pm.select("service", "minute", F.sum("k").over(w).alias("counter"))


@register("win_03_counter_rate", _COUNTER_SQL[:_COUNTER_SQL.index("SELECT service, minute, counter, CAST(sum(delta)")] + """
, r AS (SELECT service, minute, counter, count(*) OVER w AS n, min(minute) OVER w AS t0, first(delta) OVER w AS d0, first(counter) OVER w AS v0,
               sum(delta) OVER w AS total FROM d WINDOW w AS (PARTITION BY service ORDER BY minute RANGE BETWEEN 4 PRECEDING AND CURRENT ROW))
, e AS (SELECT *, CAST(minute - t0 AS DOUBLE) AS span, CAST(total - d0 AS DOUBLE) AS grown, CAST(t0 - (minute - 5) AS DOUBLE) AS gap FROM r)
SELECT service, minute, counter, CASE WHEN n > 1 THEN round(grown * (span + least(
         CASE WHEN gap < span / (n - 1) * 1.1 THEN gap ELSE span / (n - 1) / 2 END, CASE WHEN grown > 0 THEN span * v0 / grown END)) / span / 300.0, 9) END AS rate
FROM e""")
def win_03_counter_rate(spark, d):
    """Counter samples -> growth per second over 5 minutes, resets and the ends of the range handled."""
    r = SE.counter_rate(_counter_samples(spark, d), ["service"], "minute", "counter", 5, units_per_second=1 / 60)
    return r.withColumn("rate", F.round("rate", 9))


OBS02_SQL = REQ + f"""
, h AS ({_hist_sql("(SELECT *, (epoch_us(ts) // 300000000) * 300000000 AS window_start_us FROM req)",
                   "duration_s", M.PREDICTION_SECONDS, "window_start_us")})
, l AS (SELECT *, lag(upper) OVER w AS lower, lag(cumulative_count) OVER w AS prev FROM h
        WINDOW w AS (PARTITION BY window_start_us ORDER BY upper NULLS LAST))
, q AS (SELECT window_start_us, qq,
               arg_min({{'upper': upper, 'lower': lower, 'prev': prev, 'cum': cumulative_count, 'n': count}},
                       COALESCE(upper, 'inf'::DOUBLE)) AS b
        FROM l, (VALUES (0.5), (0.95), (0.99)) v(qq) WHERE cumulative_count >= count * qq AND count > 0 GROUP BY ALL)
, r AS (SELECT window_start_us, qq, CASE WHEN b.upper IS NULL THEN b.lower ELSE
               COALESCE(b.lower, 0) + (b.upper - COALESCE(b.lower, 0)) * (b.n * qq - COALESCE(b.prev, 0)) / (b.cum - COALESCE(b.prev, 0)) END AS v
        FROM q)
SELECT window_start_us, round(max(v) FILTER (WHERE qq = 0.5), 6) AS p50, round(max(v) FILTER (WHERE qq = 0.95), 6) AS p95,
       round(max(v) FILTER (WHERE qq = 0.99), 6) AS p99 FROM r GROUP BY window_start_us"""


@register("obs_02_bucket_quantiles", OBS02_SQL)
def obs_02_bucket_quantiles(spark, d):
    """P50 / P95 / P99 of request duration per 5-minute window, estimated from the fixed buckets."""
    start = F.floor(epoch_micros(F.col("ts")) / 300_000_000).cast("bigint") * 300_000_000
    bounds = M.PREDICTION_SECONDS
    names = [f"b{i}" for i in range(len(bounds) + 1)]
    g = X.requests(spark, d).groupBy(start.alias("window_start_us")).agg(*[c.alias(n) for n, c in zip(names, M.bucket_counts(F.col("duration_s"), bounds))])
    qs = {f"p{int(round(q * 100))}": F.round(M.quantile_of_counts(names, bounds, q), 6) for q in (0.5, 0.95, 0.99)}
    return g.where(F.col(names[-1]) > 0).select("window_start_us", *[c.alias(n) for n, c in qs.items()])


@register("obs_03_ratios", REQ + """
SELECT (epoch_us(ts) // 300000000) * 300000000 AS window_start_us,
       round(count_if(status <> 500 AND probability >= 0.5) / NULLIF(count_if(status <> 500), 0), 6) AS fraud_rate,
       round(count_if(status >= 500) / count(*), 6) AS error_rate
FROM req GROUP BY 1""")
def obs_03_ratios(spark, d):
    """Fraud rate and 5xx error rate per 5-minute window."""
    r = X.requests(spark, d)
    ok = F.col("status") != 500
    g = SE.window_counts(r, "ts", "5 minutes", aggs=[
        F.count_if(ok & (F.col("probability") >= 0.5)).alias("fr"), F.count_if(ok).alias("sc"),
        F.count_if(F.col("status") >= 500).alias("er")])
    return g.select("window_start_us", F.round(F.try_divide(F.col("fr"), F.col("sc")), 6).alias("fraud_rate"),
                    F.round(F.col("er") / F.col("n"), 6).alias("error_rate"))


# The rules by their text: error rate over 5% in 5 minutes for 2 minutes, fraud rate over 50% in 10 minutes for 10 minutes,
# P95 over 1 s in 5 minutes for 5 minutes; evaluated every minute, also in minutes without requests.
_MINUTES_SQL = REQ + f"""
, pm AS (SELECT epoch_us(ts) // 60000000 AS minute, count(*) AS n, count_if(status >= 500) AS errors,
                count_if(status <> 500) AS scored, count_if(status <> 500 AND probability >= 0.5) AS frauds
         FROM req GROUP BY 1)
, mm AS (SELECT unnest(generate_series(min(minute), max(minute))) AS minute FROM pm)
, dm AS (SELECT minute, COALESCE(n, 0) AS n, COALESCE(errors, 0) AS errors, COALESCE(scored, 0) AS scored, COALESCE(frauds, 0) AS frauds
         FROM mm LEFT JOIN pm USING (minute))
, tw AS (SELECT minute, sum(errors) OVER w5 / NULLIF(sum(n) OVER w5, 0) AS error_rate, sum(frauds) OVER w10 / NULLIF(sum(scored) OVER w10, 0) AS fraud_rate
         FROM dm WINDOW w5 AS (ORDER BY minute RANGE BETWEEN 4 PRECEDING AND CURRENT ROW), w10 AS (ORDER BY minute RANGE BETWEEN 9 PRECEDING AND CURRENT ROW))
, ub AS (SELECT unnest([{', '.join(map(str, M.PREDICTION_SECONDS))}, 'inf'::DOUBLE]) AS upper)
, pb AS (SELECT epoch_us(ts) // 60000000 AS minute, upper, count_if(duration_s <= upper) AS k, count(duration_s) AS n FROM req, ub GROUP BY ALL)
, hb AS (SELECT minute, upper, sum(COALESCE(k, 0)) OVER w AS cum, sum(COALESCE(n, 0)) OVER w AS n
         FROM (SELECT * FROM mm, ub) LEFT JOIN pb USING (minute, upper) WINDOW w AS (PARTITION BY upper ORDER BY minute RANGE BETWEEN 4 PRECEDING AND CURRENT ROW))
, lb AS (SELECT *, COALESCE(lag(upper) OVER w, 0) AS lower, COALESCE(lag(cum) OVER w, 0) AS prev FROM hb WINDOW w AS (PARTITION BY minute ORDER BY upper))
, p95 AS (SELECT minute, arg_min(CASE WHEN isinf(upper) THEN lower ELSE lower + (upper - lower) * (n * 0.95 - prev) / NULLIF(cum - prev, 0) END, upper) AS p95
          FROM lb WHERE n > 0 AND cum >= n * 0.95 GROUP BY minute)
"""
_ALERT_SQL = _MINUTES_SQL + """
, conds AS (SELECT 'HighErrorRate' AS alert, 2 AS for_m, minute FROM tw WHERE error_rate > 0.05
            UNION ALL SELECT 'HighFraudRate', 10, minute FROM tw WHERE fraud_rate > 0.5
            UNION ALL SELECT 'SlowPredictions', 5, minute FROM p95 WHERE p95 > 1.0)
, g AS (SELECT *, minute - row_number() OVER (PARTITION BY alert ORDER BY minute) AS grp FROM conds)
SELECT alert, min(minute) AS start_step, max(minute) AS end_step, count(*) AS steps, min(minute) + any_value(for_m) AS fired_step
FROM g GROUP BY alert, grp HAVING count(*) >= any_value(for_m) + 1"""


def _runs(req, held: bool):
    """Runs of every rule; ``held``: only those that last for the rule's hold time."""
    out = None
    minutes = OB.rule_minutes(req)
    for name, _, _, hold in OB.RULES:
        series, cond = minutes[name]
        runs = SE.islands(series, [], "minute", cond, hold + 1 if held else 1).select(
            F.lit(name).alias("alert"), "start_step", "end_step", "steps", (F.col("start_step") + hold).alias("fired_step"))
        out = runs if out is None else out.unionByName(runs)
    return out


@register("obs_04_alerts", _ALERT_SQL)
def obs_04_alerts(spark, d):
    """Alert runs of the three rules: error rate, fraud rate, P95 of predictions."""
    return _runs(X.requests(spark, d), held=True)


@register("win_05_islands", _ALERT_SQL.replace("HAVING count(*) >= any_value(for_m) + 1", "HAVING true"))
def win_05_islands(spark, d):
    """Gaps-and-islands: every run of consecutive minutes where an alert condition holds."""
    return _runs(X.requests(spark, d), held=False)


@register("obs_05_slow_requests", _MINUTES_SQL + "SELECT minute, round(p95, 6) AS p95 FROM p95 WHERE p95 > 0.5")
def obs_05_slow_requests(spark, d):
    """Minutes whose trailing 5-minute P95 is over half a second."""
    p = OB.p95_trailing(X.requests(spark, d), 5)
    return p.where(F.col("p95") > OB.SLOW_REQUEST_SECONDS).select("minute", F.round("p95", 6).alias("p95"))


@register("obs_05_error_bursts", REQ + """
, pm AS (SELECT epoch_us(ts) // 60000000 AS minute, count(*) AS errors FROM req WHERE status >= 500 GROUP BY 1)
, w5 AS (SELECT minute, sum(errors) OVER (ORDER BY minute RANGE BETWEEN 4 PRECEDING AND CURRENT ROW) AS e FROM pm)
, hr AS (SELECT minute // 60 AS hour, sum(errors) AS e FROM pm GROUP BY 1)
SELECT 'ErrorsIn5m' AS alert, minute AS step, CAST(e AS BIGINT) AS errors FROM w5 WHERE e > 10
UNION ALL SELECT 'ErrorsPerHour', hour, CAST(e AS BIGINT) FROM hr WHERE e > 10""")
def obs_05_error_bursts(spark, d):
    """More than 10 errors in 5 minutes (per minute) or in an hour."""
    r = X.requests(spark, d).where(F.col("status") >= 500)
    pm = r.groupBy(F.floor(epoch_micros(F.col("ts")) / 60_000_000).cast("bigint").alias("minute")) \
          .agg(F.count(F.lit(1)).alias("errors"))
    w5 = OB.trailing(pm, 5, ["errors"]).where(F.col("errors_w") > 10).select(
        F.lit("ErrorsIn5m").alias("alert"), F.col("minute").alias("step"), F.col("errors_w").alias("errors"))
    hr = pm.groupBy(F.floor(F.col("minute") / 60).cast("bigint").alias("step")).agg(F.sum("errors").alias("errors")) \
           .where(F.col("errors") > 10).select(F.lit("ErrorsPerHour").alias("alert"), "step", "errors")
    return w5.unionByName(hr)


@register("obs_05_new_issues", REQ + """
SELECT endpoint || ' ' || CAST(status AS VARCHAR) AS issue, min(epoch_us(ts)) AS first_seen_us FROM req
WHERE status >= 400 GROUP BY 1""")
def obs_05_new_issues(spark, d):
    """New-issue alert: first time each error type is seen."""
    r = X.requests(spark, d).where(F.col("status") >= 400)
    return r.groupBy(F.concat_ws(" ", "endpoint", F.col("status").cast("string")).alias("issue")).agg(
        F.min(epoch_micros(F.col("ts"))).alias("first_seen_us"))


@register("win_06_spikes", REQ + """
, h AS (SELECT endpoint || ' ' || CAST(status AS VARCHAR) AS issue, epoch_us(ts) // 3600000000 AS hour, count(*) AS n
        FROM req WHERE status >= 400 GROUP BY ALL)
, l AS (SELECT *, CASE WHEN lag(hour) OVER w = hour - 1 THEN lag(n) OVER w END AS prev_count FROM h
        WINDOW w AS (PARTITION BY issue ORDER BY hour))
SELECT issue, hour, n, prev_count, COALESCE(n >= prev_count * 1.5, false) AS spike FROM l""")
def win_06_spikes(spark, d):
    """Hourly issue counts with a 50% spike flag against the previous hour."""
    r = X.requests(spark, d).where(F.col("status") >= 400)
    h = r.groupBy(F.concat_ws(" ", "endpoint", F.col("status").cast("string")).alias("issue"),
                  F.floor(epoch_micros(F.col("ts")) / 3_600_000_000).cast("bigint").alias("hour")) \
         .agg(F.count(F.lit(1)).alias("n"))
    return SE.spikes(h, ["issue"], "hour", "n", 1.5)


# Fixed colour bands of the dashboards.
FRAUD_BANDS = ((0.3, "green"), (0.6, "yellow"))


@register("obs_06_latest_gauge", REQ + """
SELECT service, arg_max(probability, (ts, event_id)) AS latest_probability,
       CASE WHEN arg_max(probability, (ts, event_id)) < 0.3 THEN 'green'
            WHEN arg_max(probability, (ts, event_id)) < 0.6 THEN 'yellow' ELSE 'red' END AS band
FROM req GROUP BY service""")
def obs_06_latest_gauge(spark, d):
    """Latest fraud-probability gauge per service with its colour band."""
    r = X.requests(spark, d)
    g = r.groupBy("service").agg(F.max_by("probability", F.struct("ts", "event_id")).alias("latest_probability"))
    p = F.col("latest_probability")
    return g.withColumn("band", F.when(p < FRAUD_BANDS[0][0], FRAUD_BANDS[0][1])
                        .when(p < FRAUD_BANDS[1][0], FRAUD_BANDS[1][1]).otherwise("red"))


@register("obs_07_quality_over_time", W("pred") + f"""
SELECT epoch_us(pred_ts) // 86400000000 AS day, tp, fp, tn, fn, {_RATES_SQL}
FROM (SELECT epoch_us(pred_ts) // 86400000000 AS dd, any_value(pred_ts) AS pred_ts, {_CM_SQL}
      FROM pred WHERE ground_truth IS NOT NULL GROUP BY dd)""")
def obs_07_quality_over_time(spark, d):
    """Confusion counts and precision / recall / F1 per day of prediction."""
    lab = X.prediction_log(spark, d).where(F.col("ground_truth").isNotNull())
    lab = lab.withColumn("day", F.floor(epoch_micros(F.col("pred_ts")) / 86_400_000_000).cast("bigint"))
    r = M.classification_report(lab, "ground_truth", "prediction", groups=["day"])
    return r.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1", "accuracy")})


@register("obs_01_rate_by_labels", REQ + """
, b AS (SELECT *, epoch_us(ts) // 60000000 AS m FROM req)
, x AS (SELECT method, status, (m - k) * 60000000 AS window_start_us FROM b, range(0, 5) t(k))
SELECT method, status, window_start_us, count(*) AS n, round(count(*) / 300.0, 9) AS rate FROM x GROUP BY ALL""")
def obs_01_rate_by_labels(spark, d):
    """Requests per second over 5 minutes (1-minute step) for every (method, status) label set."""
    r = SE.window_rate(X.requests(spark, d), "ts", 300, 60, ["method", "status"])
    return r.select("method", "status", "window_start_us", "n", F.round("rate", 9).alias("rate"))
