"""Streaming queries: each runs availableNow into a fresh sink and returns the sink read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import boosting as B
from riskframe.operators import drift as DR
from riskframe.operators import metrics as M
from riskframe.plans import features as FE
from riskframe.plans import monitoring as MO
from riskframe.plans.catalog_monitoring import _BIN_SQL, ORACLE_WIN04
from riskframe.plans.catalog_observability import OBS02_SQL
from riskframe.plans.registry import ORACLE, bigint_counts, register
from riskframe.session import scratch_path
from riskframe.sources import fixtures as X
from riskframe.sources.tables import load
from riskframe.streaming import jobs as J
from riskframe.streaming.runner import run_available_now, run_foreach_batch, stream_table

W = X.with_ctes
_TIER = ("CASE WHEN probability < 0.3 THEN 'LOW' WHEN probability < 0.6 THEN 'MEDIUM' "
         "WHEN probability < 0.8 THEN 'HIGH' ELSE 'CRITICAL' END")


@register("str_01_stream_scoring", W("req") + f"""
SELECT event_id, probability, probability >= 0.5 AS is_fraud, {_TIER} AS risk_level,
       'TXN_' || strftime(ts, '%Y%m%d%H%M%S%f') || '_' || CAST(event_id AS VARCHAR) AS transaction_code
FROM req WHERE status <> 500""")
def str_01_stream_scoring(spark, d):
    """Arriving requests scored one by one into an append-only log."""
    out = run_available_now(J.score_stream(stream_table(spark, d, "events")), "scoring")
    return spark.read.parquet(out)


def _stream_transactions(o, c):
    """Arriving orders as transactions, with the identity columns that the service's request has."""
    j = X.identity_join(o, c, "o_custkey", "c_custkey")
    return j.select(F.col("o_orderkey").alias("TransactionID"), F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("TransactionAmt"),
                    F.col("o_custkey").alias("card1"), F.col("o_orderpriority").alias("card4"), F.col("o_orderstatus").alias("card6"),
                    F.col("c_nationkey").alias("addr1"), F.col("c_acctbal").alias("C1"))


SCORING_ROUNDS = 10


def scoring_model(spark, d):
    """A small model on the service's own feature vector, fitted on the training rows."""
    train, _ = X.train_test(spark, d)
    train = train.withColumn("id", F.col("TransactionID"))
    v = FE.row_vector(train, carry=("id", "isFraud"))
    features = [c for c in v.columns if c not in ("id", "isFraud", "TransactionID")]
    return B.fit(v, features, "isFraud", "id", B.Boosting(rounds=SCORING_ROUNDS, max_depth=4, column_share=0.8))


@register("str_01_model_scoring")
def str_01_model_scoring(spark, d):
    """Arriving transactions scored in the stream: identity join, feature vector, model, decision, tier, code, appended to a log."""
    model = scoring_model(spark, d)
    tx = _stream_transactions(stream_table(spark, d, "orders"), load(spark, d, "customer"))
    return spark.read.parquet(run_available_now(J.score_transactions(tx, model), "model-scoring"))


_LE = ", ".join(f"count_if(duration_s <= {b}) AS le_{str(b).replace('.', '_')}" for b in J.PREDICTION_SECONDS)


@register("str_02_windowed_metrics", W("req") + f"""
, g AS (SELECT (epoch_us(ts) // 300000000) * 300000000 AS window_start_us, count(*) AS n,
               count_if(status >= 500) AS errors, count_if(status <> 500) AS scored,
               count_if(status <> 500 AND probability >= 0.5) AS frauds, {_LE}
        FROM req GROUP BY 1)
SELECT * FROM g WHERE window_start_us + 300000000 <= (SELECT epoch_us(max(ts)) FROM req) - 600000000""")
def str_02_windowed_metrics(spark, d):
    """5-minute windows with a 10-minute watermark (append mode: windows closed by the watermark)."""
    out = run_available_now(J.request_metrics(stream_table(spark, d, "events")), "req-metrics")
    return spark.read.parquet(out)


@register("str_03_count_windows", None)
def str_03_count_windows(spark, d):
    """Metrics every 100 labels from a label stream; state = open-window rows and an offset only."""
    preds = X.predictions_of(load(spark, d, "documents").select("doc_id", "n_chars"))
    lab = J.labeled_stream(stream_table(spark, d, "labels"), preds)
    out = scratch_path(spark, "count-windows-out")
    run_foreach_batch(lab, "count-windows", J.CountWindows(scratch_path(spark, "count-windows-state"), out))
    rep = spark.read.parquet(out).drop("b")
    return rep.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1", "accuracy", "auc")})


DRIFT_FEATURES = ["TransactionAmt", "card1"]
_DRIFT_BINS = ", ".join(f"count_if(x >= lo AND x <= hi AND ({_BIN_SQL}) = {i})" for i in range(DR.PSI_BINS))


@register("str_03_prediction_drift", W("train", "test") + f"""
, ref AS (SELECT unnest(['TransactionAmt', 'card1']) AS feature, unnest([TransactionAmt, CAST(card1 AS DOUBLE)]) AS x FROM train)
, w0 AS (SELECT (row_number() OVER (ORDER BY TransactionDT, TransactionID) - 1) // 100 AS window_no, TransactionAmt * {MO.CURRENT_SCALE} AS amt, card1 FROM test)
, w AS (SELECT * FROM w0 WHERE window_no < (SELECT count(*) // 100 FROM test))
, cur AS (SELECT window_no, unnest(['TransactionAmt', 'card1']) AS feature, unnest([amt, CAST(card1 AS DOUBLE)]) AS x FROM w)
, rng AS (SELECT feature, count(*) AS n_ref, CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
                 CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM ref GROUP BY feature)
, r2 AS (SELECT *, (hi - lo) / CAST({DR.PSI_BINS} AS DOUBLE) AS step FROM rng)
, rb AS (SELECT feature, n_ref, [{_DRIFT_BINS}] AS bins FROM ref JOIN r2 USING (feature) GROUP BY ALL)
, cb AS (SELECT window_no, feature, count(*) AS n_cur, [{_DRIFT_BINS}] AS bins FROM cur JOIN r2 USING (feature) GROUP BY ALL)
, p0 AS (SELECT window_no, feature, unnest(rb.bins) / n_ref AS rp, unnest(cb.bins) / n_cur AS cp FROM cb JOIN rb USING (feature))
, psi AS (SELECT window_no, feature, sum((cp - rp) * ln(cp / rp)) AS psi
          FROM (SELECT window_no, feature, CASE WHEN rp = 0 THEN {DR.PSI_EMPTY} ELSE rp END AS rp, CASE WHEN cp = 0 THEN {DR.PSI_EMPTY} ELSE cp END AS cp FROM p0)
          GROUP BY ALL)
, fr AS (SELECT feature, x, sum(count(*)) OVER (PARTITION BY feature ORDER BY x) AS upto, count(*) AS own FROM ref GROUP BY feature, x)
, cv AS (SELECT window_no, feature, x, sum(count(*)) OVER (PARTITION BY window_no, feature ORDER BY x) AS upto, count(*) AS own,
                sum(count(*)) OVER (PARTITION BY window_no, feature) AS n_cur FROM cur GROUP BY window_no, feature, x)
, m AS (SELECT cv.*, coalesce(fr.upto, 0) AS r_upto, CASE WHEN fr.x = cv.x THEN fr.own ELSE 0 END AS r_own
        FROM cv ASOF LEFT JOIN fr ON cv.feature = fr.feature AND cv.x >= fr.x)
, ks AS (SELECT window_no, feature, CAST(n_cur AS BIGINT) AS n_cur, n_ref,
                max(greatest(abs(r_upto / n_ref - upto / n_cur), abs((r_upto - r_own) / n_ref - (upto - own) / n_cur))) AS ks_d
         FROM m JOIN rng USING (feature) GROUP BY ALL)
, kp AS (SELECT *, CASE WHEN lam < 0.05 THEN 1.0
              WHEN lam < 1 THEN 1 - sqrt(2 * pi()) / lam * list_sum([exp(-(2 * k - 1) * (2 * k - 1) * pi() * pi() / (8 * lam * lam)) for k in range(1, 9)])
              ELSE 2.0 * list_sum([pow(-1.0, k - 1) * exp(-2.0 * k * k * lam * lam) for k in range(1, 31)]) END AS p_value
         FROM (SELECT *, sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur)) * ks_d AS lam FROM ks))
SELECT window_no, feature, n_cur, round(psi, 6) AS psi, round(ks_d, 6) AS ks_d, round(p_value, 6) AS p_value, p_value < 0.05 AS drift_detected
FROM kp JOIN psi USING (window_no, feature)""")
def str_03_prediction_drift(spark, d):
    """Drift of the scored transactions' features against the training sample, every 100 predictions."""
    train, _ = X.train_test(spark, d)
    out = scratch_path(spark, "drift-windows-out")
    o = stream_table(spark, d, "orders").where(F.col("o_orderdate") >= F.lit(X.TRAIN_CUTOFF).cast("timestamp_ntz"))
    scored = o.select(F.col("o_orderdate").alias("pred_ts"), F.col("o_orderkey").alias("transaction_id"),
                      (F.col("o_totalprice") * MO.CURRENT_SCALE).alias("TransactionAmt"), F.col("o_custkey").alias("card1"))
    evaluate = J.drift_against(DR.to_long(train, DRIFT_FEATURES), DRIFT_FEATURES)
    run_foreach_batch(scored, "drift-windows", J.CountWindows(
        scratch_path(spark, "drift-windows-state"), out, order=("pred_ts", "transaction_id"), evaluate=evaluate))
    r = spark.read.parquet(out).drop("b", "n_ref")
    return r.withColumns({c: F.round(c, 6) for c in ("psi", "ks_d", "p_value")})


@register("str_04_online_table", """SELECT user_id, arg_max(value, ts) AS view_value, epoch_us(max(ts)) AS ts_us
FROM events WHERE event_type = 'view' GROUP BY user_id""")
def str_04_online_table(spark, d):
    """Latest-value online table kept fresh from a stream of view rows (stateful aggregate, changed keys per batch)."""
    ev = stream_table(spark, d, "events").where(F.col("event_type") == "view").select(
        "user_id", F.col("ts").alias("event_timestamp"), F.col("ts").alias("created"), F.col("value").alias("view_value"))
    spec = ("user_id", "event_timestamp", "created", ["view_value"])
    path = scratch_path(spark, "online-stream")
    run_foreach_batch(J.online_rows(ev, *spec), "online", J.BatchFolders(path), mode="update")
    cur = J.current_rows(spark, path, *spec)
    return cur.select("user_id", "view_value", J.epoch_us(F.col("event_timestamp")).alias("ts_us"))


@register("str_05_label_join", W("pred") + f"""
, l AS (SELECT * FROM pred WHERE ground_truth IS NOT NULL)
SELECT transaction_id, ground_truth AS label, round((epoch_us(label_ts) - epoch_us(pred_ts)) / 3.6e9, 6) AS latency_h,
       CASE WHEN pred_ts IS NULL THEN 'unmatched' WHEN label_ts BETWEEN pred_ts AND pred_ts + INTERVAL {J.LABEL_HORIZON_HOURS} HOURS
            THEN 'in_time' ELSE 'outside_horizon' END AS status FROM l""")
def str_05_label_join(spark, d):
    """Stream-stream join of labels to predictions, then every label that the stream's horizon left out, with a status."""
    p = X.predictions_of(stream_table(spark, d, "documents").select("doc_id", "n_chars"))
    lab = X.labels_of(stream_table(spark, d, "labels"))
    joined = spark.read.parquet(run_available_now(J.label_join(p, lab), "label-join"))
    out = J.reconciled_labels(joined, X.predictions_of(load(spark, d, "documents").select("doc_id", "n_chars")),
                              X.labels_of(load(spark, d, "labels")))
    return out.withColumn("latency_h", F.round("latency_h", 6))


_OUTER_WATERMARK = "(SELECT least(max(pred_ts), (SELECT max(label_ts) FROM l)) - INTERVAL 1 HOUR FROM p)"


@register("str_05_outer_join", W("pred") + f"""
, p AS (SELECT * FROM pred WHERE transaction_id % 5 <> 0)
, l AS (SELECT * FROM pred WHERE ground_truth IS NOT NULL)
SELECT l.transaction_id, l.ground_truth AS label, round((epoch_us(l.label_ts) - epoch_us(p.pred_ts)) / 3.6e9, 6) AS latency_h
FROM l LEFT JOIN p ON p.transaction_id = l.transaction_id AND p.pred_ts <= l.label_ts AND p.pred_ts >= l.label_ts - INTERVAL {J.LABEL_HORIZON_HOURS} HOURS
WHERE p.transaction_id IS NOT NULL OR l.label_ts < {_OUTER_WATERMARK}""")
def str_05_outer_join(spark, d):
    """Stream-stream outer join alone: matches, and labels without a prediction in the horizon that the watermark has passed.

    Predictions of every fifth id never arrive.
    """
    p = X.predictions_of(stream_table(spark, d, "documents").select("doc_id", "n_chars")).where("transaction_id % 5 <> 0")
    out = spark.read.parquet(run_available_now(J.label_join(p, X.labels_of(stream_table(spark, d, "labels"))), "label-outer"))
    return out.withColumn("latency_h", F.round("latency_h", 6))


@register("str_06_first_label_only", "SELECT doc_id AS transaction_id FROM labels")
def str_06_first_label_only(spark, d):
    """Each prediction id is counted once although it is submitted twice, whatever lies between."""
    out = run_available_now(J.first_submissions(J.label_submissions(stream_table(spark, d, "labels"))), "first-labels")
    return spark.read.parquet(out)


@register("str_07_log_level_counts", W("logs") + """
, p AS (SELECT regexp_extract(value, ' - ([A-Z]+) - ', 1) AS level,
               epoch_us(strptime(regexp_extract(value, '^(\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2})', 1), '%Y-%m-%d %H:%M:%S')
                        + to_milliseconds(COALESCE(TRY_CAST(NULLIF(regexp_extract(value, '^\\S+ \\S+,(\\d{3})', 1), '') AS INTEGER), 0))) AS us
        FROM logs)
SELECT (us // 3600000000) * 3600000000 AS window_start_us, level, count(*) AS n FROM p
WHERE (us // 3600000000) * 3600000000 + 3600000000 <= (SELECT max(us) FROM p) - 600000000
GROUP BY ALL""")
def str_07_log_level_counts(spark, d):
    """Log lines from a stream parsed and counted per level and hour (watermark 10 minutes)."""
    out = run_available_now(J.log_level_counts(X.log_lines_of(stream_table(spark, d, "events"))), "log-levels")
    return spark.read.parquet(out)


@register("str_07_tailed_files", ORACLE["str_07_log_level_counts"].replace("SELECT regexp_extract(value, ' - ([A-Z]+) - ', 1) AS level,",
          "SELECT regexp_extract(value, ' - ([A-Z]+) - ', 1) AS level, regexp_extract(value, '^\\S+ \\S+ - (\\S+) - ', 1) AS job,").replace(
          "window_start_us, level, count", "window_start_us, job, level, count"))
def str_07_tailed_files(spark, d):
    """Log files of two services followed as a text stream, labelled by their path, counted per service, level and hour."""
    folder = scratch_path(spark, "logs")
    lines = X.log_lines(spark, d).select("value", F.regexp_extract("value", r" - (\S+) - [A-Z]+ - ", 1).alias("job"))
    lines.write.partitionBy("job").text(folder)
    tailed = J.tail_logs(spark, folder).withColumn("job", F.regexp_replace("job", "^job=", ""))
    return spark.read.parquet(run_available_now(J.log_level_counts(tailed, by=["job"]), "log-files"))


# the count-window stream has the same answer as the batch count windows
ORACLE["str_03_count_windows"] = bigint_counts(ORACLE_WIN04)


@register("src_09_transaction_stream", W("tx") + """
SELECT CAST(TransactionAmt AS DOUBLE) AS TransactionAmt, CAST(card1 AS DOUBLE) AS card1, CAST(NULL AS DOUBLE) AS card2,
       CAST(NULL AS DOUBLE) AS card3, card4, CAST(NULL AS DOUBLE) AS card5, card6, CAST(addr1 AS DOUBLE) AS addr1,
       CAST(NULL AS DOUBLE) AS addr2, CAST(NULL AS VARCHAR) AS ProductCD, P_emaildomain, CAST(NULL AS VARCHAR) AS R_emaildomain
FROM tx""")
def src_09_transaction_stream(spark, d):
    """Transactions arriving as a stream (orders stream joined to the static identity table) as typed records."""
    from riskframe.sources.records import to_request_records
    o = stream_table(spark, d, "orders")
    c = load(spark, d, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    t = j.select(F.col("o_totalprice").alias("TransactionAmt"), F.col("o_custkey").alias("card1"),
                 F.col("o_orderpriority").alias("card4"), F.col("o_orderstatus").alias("card6"),
                 F.col("c_nationkey").alias("addr1"),
                 F.expr(f"nullif(c_mktsegment, '{X.NULL_SEGMENT}')").alias("P_emaildomain"))
    out = run_available_now(to_request_records(t), "tx-stream")
    return spark.read.parquet(out)


@register("str_02_window_quantiles", "SELECT * FROM (" + OBS02_SQL + """)
WHERE window_start_us + 300000000 <= (SELECT epoch_us(max(ts)) FROM events) - 600000000""")
def str_02_window_quantiles(spark, d):
    """P50 / P95 / P99 latency per 5-minute stream window, from the window's bucket counts."""
    out = spark.read.parquet(run_available_now(J.request_metrics(stream_table(spark, d, "events")), "req-q"))
    bounds = J.PREDICTION_SECONDS
    counts = [f"le_{str(b).replace('.', '_')}" for b in bounds] + ["n"]
    qs = {f"p{int(round(q * 100))}": F.round(M.quantile_of_counts(counts, bounds, q), 6) for q in (0.5, 0.95, 0.99)}
    return out.select("window_start_us", *[c.alias(name) for name, c in qs.items()])
