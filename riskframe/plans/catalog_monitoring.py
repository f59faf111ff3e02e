"""Queries of the scoring / model-monitoring / drift area."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions import scalar as S
from riskframe.functions.time import epoch_micros, hours_between
from riskframe.operators import drift as DR
from riskframe.operators import metrics as M
from riskframe.plans import monitoring as MO
from riskframe.plans.features import EXPECTED_FEATURES, row_vector
from riskframe.plans.registry import register
from riskframe.session import scratch_path
from riskframe.sources import fixtures as X
from riskframe.sources import sinks as SK

W = X.with_ctes
LAB = "SELECT * FROM pred WHERE ground_truth IS NOT NULL"
_RATES_SQL = """round(COALESCE(tp / NULLIF(tp + fp, 0), 0), 6) AS precision,
       round(COALESCE(tp / NULLIF(tp + fn, 0), 0), 6) AS recall,
       round(COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0), 6) AS f1,
       round(COALESCE((tp + tn) / NULLIF(tp + fp + tn + fn, 0), 0), 6) AS accuracy"""
_CM_SQL = """count_if(ground_truth = 1 AND prediction = 1) AS tp, count_if(ground_truth = 0 AND prediction = 1) AS fp,
       count_if(ground_truth = 0 AND prediction = 0) AS tn, count_if(ground_truth = 1 AND prediction = 0) AS fn"""


def _auc_sql(src: str, groups: str = "") -> str:
    gsel = f"{groups}, " if groups else ""
    part = f"PARTITION BY {groups} " if groups else ""
    gby = f"GROUP BY {groups}" if groups else ""
    return f"""(SELECT {gsel}CASE WHEN sum(pos) > 0 AND sum(neg) > 0
            THEN round(sum(pos * (COALESCE(below, 0) + 0.5 * neg)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 6) END AS auc
     FROM (SELECT *, sum(neg) OVER ({part}ORDER BY probability ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below
           FROM (SELECT {gsel}probability, count_if(ground_truth = 1) AS pos, count_if(ground_truth = 0) AS neg
                 FROM {src} WHERE probability IS NOT NULL AND ground_truth IS NOT NULL GROUP BY {gsel}probability))
     {gby})"""


def _labeled(spark, d):
    return X.prediction_log(spark, d).where(F.col("ground_truth").isNotNull())


def _round_rates(df):
    return df.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1", "accuracy", "auc") if c in df.columns})


# ---------------------------------------------------------------- FLT-01, AGG-08 .. AGG-11
@register("flt_01_labeled", W("pred") + "SELECT transaction_id, prediction, probability, ground_truth FROM pred "
          "WHERE ground_truth IS NOT NULL")
def flt_01_labeled(spark, d):
    """Predictions that received a label."""
    return _labeled(spark, d).select("transaction_id", "prediction", "probability", "ground_truth")


@register("agg_08_confusion", W("pred") + f"SELECT {_CM_SQL} FROM ({LAB})")
def agg_08_confusion(spark, d):
    """TP / FP / TN / FN of the labeled predictions."""
    return M.confusion(_labeled(spark, d), "ground_truth", "prediction")


@register("agg_09_precision_recall_f1", W("pred") + f"SELECT tp, fp, tn, fn, {_RATES_SQL} FROM (SELECT {_CM_SQL} FROM ({LAB}))")
def agg_09_precision_recall_f1(spark, d):
    """Precision, recall, F1 (0 when undefined) and accuracy."""
    r = M.classification_report(_labeled(spark, d), "ground_truth", "prediction")
    return _round_rates(r)


@register("agg_10_auc", W("pred") + "SELECT * FROM " + _auc_sql(f"({LAB})"))
def agg_10_auc(spark, d):
    """ROC AUC with tie midranks over the labeled predictions."""
    return _round_rates(M.auc(_labeled(spark, d), "ground_truth", "probability"))


@register("agg_10_auc_one_class", W("pred") + "SELECT * FROM " + _auc_sql("(SELECT * FROM pred WHERE ground_truth = 1)"))
def agg_10_auc_one_class(spark, d):
    """AUC is null when only one class is labeled."""
    return M.auc(_labeled(spark, d).where("ground_truth = 1"), "ground_truth", "probability")


@register("agg_11_label_status", W("pred") + """
SELECT count(*) AS total_predictions, count(ground_truth) AS labeled_predictions,
       CASE WHEN count(ground_truth) = 0 THEN 'no_labeled_data' ELSE 'ok' END AS status FROM pred""")
def agg_11_label_status(spark, d):
    """Total and labeled prediction counts with a status."""
    return M.label_status(X.prediction_log(spark, d), "ground_truth")


# Fixed colour bands of the quality panels.
QUALITY_BANDS = ((0.7, "red"), (0.9, "yellow"))


@register("obs_06_quality_bands", W("pred") + f"""
, q AS (SELECT {_RATES_SQL} FROM (SELECT {_CM_SQL} FROM ({LAB})))
SELECT metric, value, CASE WHEN value < 0.7 THEN 'red' WHEN value < 0.9 THEN 'yellow' ELSE 'green' END AS band
FROM (UNPIVOT q ON precision, recall, f1, accuracy INTO NAME metric VALUE value)""")
def obs_06_quality_bands(spark, d):
    """Quality gauges with their colour bands."""
    r = _round_rates(M.classification_report(_labeled(spark, d), "ground_truth", "prediction"))
    names = ("precision", "recall", "f1", "accuracy")
    g = r.select(F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])))
    v = F.col("value")
    return g.withColumn("band", F.when(v < QUALITY_BANDS[0][0], QUALITY_BANDS[0][1]).when(v < QUALITY_BANDS[1][0], QUALITY_BANDS[1][1]).otherwise("green"))


# ---------------------------------------------------------------- SNK-04, JON-04, FUN-13, AGG-16
@register("snk_04_label_attach", W("pred", "label_events") + """
, lat AS (SELECT transaction_id, arg_max(label, label_ts) AS label, max(label_ts) AS label_ts
          FROM label_events GROUP BY transaction_id)
SELECT p.transaction_id, p.prediction, p.probability, lat.label AS ground_truth, epoch_us(lat.label_ts) AS label_us
FROM pred p LEFT JOIN lat ON p.transaction_id = lat.transaction_id""")
def snk_04_label_attach(spark, d):
    """Predictions with their latest submitted label (resubmission overwrites; no file rewrite)."""
    v = MO.attach_labels(X.predictions_only(spark, d), X.label_events(spark, d))
    return v.select("transaction_id", "prediction", "probability", "ground_truth",
                    epoch_micros(F.col("label_ts")).alias("label_us"))


_JOIN_SQL = W("pred", "label_events") + """
, lat AS (SELECT transaction_id, arg_max(label, label_ts) AS label, max(label_ts) AS label_ts
          FROM label_events GROUP BY transaction_id)
, j AS (SELECT lat.transaction_id, lat.label, p.transaction_id IS NOT NULL AS matched,
               (epoch_us(lat.label_ts) - epoch_us(p.pred_ts)) / 3.6e9 AS latency_h
        FROM lat LEFT JOIN pred p ON lat.transaction_id = p.transaction_id)
"""


def _label_join(spark, d):
    lat = MO.latest_labels(X.label_events(spark, d))
    p = X.predictions_only(spark, d).select("transaction_id", "pred_ts", F.lit(True).alias("matched"))
    j = lat.join(p, "transaction_id", "left")
    return j.select("transaction_id", "label", F.coalesce("matched", F.lit(False)).alias("matched"),
                    hours_between(F.col("pred_ts"), F.col("label_ts")).alias("latency_h"))


@register("jon_04_label_join", _JOIN_SQL + "SELECT transaction_id, label, matched, round(latency_h, 6) AS latency_h FROM j")
def jon_04_label_join(spark, d):
    """Latest label per id joined to its prediction, with label latency in hours (FUN-13)."""
    return _label_join(spark, d).withColumn("latency_h", F.round("latency_h", 6))


@register("jon_04_unmatched_count", _JOIN_SQL + "SELECT count_if(matched) AS matched, count_if(NOT matched) AS unmatched FROM j")
def jon_04_unmatched_count(spark, d):
    """Labels with and without a logged prediction (left join + anti join count)."""
    lat = MO.latest_labels(X.label_events(spark, d))
    p = X.predictions_only(spark, d).select("transaction_id", F.lit(True).alias("__p"))
    j = lat.join(p, "transaction_id", "left")
    return j.agg(F.count_if(F.col("__p").isNotNull()).alias("matched"),
                 F.count_if(F.col("__p").isNull()).alias("unmatched"))


def _hist_sql(src: str, value: str, bounds, groups: str = "") -> str:
    gsel = f"{groups}, " if groups else ""
    gby = f"GROUP BY {groups}" if groups else ""
    cells = ", ".join(f"{{'le': '{M.bound_label(b)}', 'upper': CAST({float(b)} AS DOUBLE), "
                      f"'cumulative_count': count_if({value} <= {float(b)})}}" for b in bounds)
    cells += f", {{'le': '+Inf', 'upper': CAST(NULL AS DOUBLE), 'cumulative_count': count({value})}}"
    return f"""SELECT {gsel}s, n AS count, c.le, c.upper, c.cumulative_count FROM (
  SELECT {gsel}round(sum({value}), 6) AS s, count({value}) AS n, unnest([{cells}]) AS c
  FROM {src} WHERE {value} IS NOT NULL {gby})"""


@register("agg_16_label_latency_hist",
          _JOIN_SQL + _hist_sql("(SELECT * FROM j WHERE matched)", "latency_h", M.LABEL_LATENCY_HOURS)
          .replace("SELECT s, n AS count", "SELECT s AS sum, n AS count", 1))
def agg_16_label_latency_hist(spark, d):
    """Cumulative histogram of label latency in hours (buckets 1 .. 168, +Inf)."""
    j = _label_join(spark, d).where("matched")
    h = M.histogram(j, "latency_h", M.LABEL_LATENCY_HOURS)
    return h.withColumn("sum", F.round("sum", 6))


# ---------------------------------------------------------------- WIN-04
ORACLE_WIN04 = W("pred") + f"""
, lab AS (SELECT *, row_number() OVER (ORDER BY label_ts, transaction_id) AS i, count(*) OVER () AS n
          FROM pred WHERE ground_truth IS NOT NULL)
, w AS (SELECT *, (i - 1) // 100 AS window_no FROM lab WHERE i <= (n // 100) * 100)
, cm AS (SELECT window_no, {_CM_SQL} FROM w GROUP BY window_no)
SELECT cm.window_no, tp, fp, tn, fn, {_RATES_SQL}, a.auc
FROM cm LEFT JOIN {_auc_sql('w', 'window_no')} a ON cm.window_no = a.window_no"""


@register("win_04_count_windows", ORACLE_WIN04)
def win_04_count_windows(spark, d):
    """Metrics every 100 labels in arrival order; the incomplete tail is not emitted."""
    return _round_rates(MO.count_windows(_labeled(spark, d)))


# ---------------------------------------------------------------- FUN-10 .. 12, AGG-14, 15, 17, 18
_TIER_SQL = ("CASE WHEN probability < 0.3 THEN 'LOW' WHEN probability < 0.6 THEN 'MEDIUM' "
             "WHEN probability < 0.8 THEN 'HIGH' ELSE 'CRITICAL' END")


def _scored(spark, d):
    r = X.requests(spark, d)
    return r.where(F.col("status") != 500).withColumns(
        {"risk_level": S.risk_level("probability"), "is_fraud": S.is_fraud("probability")})


@register("fun_10_risk_tier", W("req") + f"SELECT event_id, probability, {_TIER_SQL} AS risk_level FROM req")
def fun_10_risk_tier(spark, d):
    """Probability to LOW / MEDIUM / HIGH / CRITICAL."""
    r = X.requests(spark, d)
    return r.select("event_id", "probability", S.risk_level("probability").alias("risk_level"))


@register("fun_11_is_fraud", W("req") + """
SELECT event_id, probability >= 0.5 AS is_fraud,
       CASE WHEN probability >= 0.5 THEN 'fraud' ELSE 'legitimate' END AS label FROM req""")
def fun_11_is_fraud(spark, d):
    """Decision and label name from the predicted value."""
    r = X.requests(spark, d)
    f = S.is_fraud("probability")
    return r.select("event_id", f.alias("is_fraud"), S.label_name(f).alias("label"))


@register("fun_12_transaction_code", W("req") + """
SELECT event_id, 'TXN_' || strftime(ts, '%Y%m%d%H%M%S%f') || '_' || CAST(event_id AS VARCHAR) AS transaction_code FROM req""")
def fun_12_transaction_code(spark, d):
    """TXN_ + timestamp to the microsecond + row key (no same-microsecond collisions)."""
    r = X.requests(spark, d)
    return r.select("event_id", S.transaction_code("ts", "event_id").alias("transaction_code"))


@register("agg_14_batch_summary", W("req") + """
SELECT count(*) AS total, count_if(status <> 500 AND probability >= 0.5) AS fraud_count,
       count_if(status <> 500 AND probability < 0.5) AS legitimate_count, count_if(status = 500) AS error_count
FROM req""")
def agg_14_batch_summary(spark, d):
    """Batch scoring summary: total, fraud, legitimate and failed rows."""
    r = X.requests(spark, d)
    ok = F.col("status") != 500
    return r.agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(ok & S.is_fraud("probability")).alias("fraud_count"),
                 F.count_if(ok & ~S.is_fraud("probability")).alias("legitimate_count"),
                 F.count_if(~ok).alias("error_count"))


@register("agg_15_tier_distribution", W("req") + f"""
SELECT {_TIER_SQL} AS risk_level, count(*) AS n FROM req WHERE status <> 500 GROUP BY 1""")
def agg_15_tier_distribution(spark, d):
    """Predictions per risk tier."""
    return _scored(spark, d).groupBy("risk_level").agg(F.count(F.lit(1)).alias("n"))


@register("agg_17_duration_hist", W("req") + _hist_sql("req", "duration_s", M.PREDICTION_SECONDS, "endpoint")
          .replace("SELECT endpoint, s, n AS count", "SELECT endpoint, s AS sum, n AS count", 1))
def agg_17_duration_hist(spark, d):
    """Prediction-duration histogram per endpoint with the service's fixed buckets."""
    h = M.histogram(X.requests(spark, d), "duration_s", M.PREDICTION_SECONDS, ["endpoint"])
    return h.withColumn("sum", F.round("sum", 6))


@register("agg_17_feature_duration_hist", W("req") + _hist_sql("(SELECT * FROM req WHERE service = 'preprocessing_service')", "duration_s", M.FEATURE_SECONDS)
          .replace("SELECT s, n AS count", "SELECT s AS sum, n AS count", 1))
def agg_17_feature_duration_hist(spark, d):
    """Feature-engineering duration histogram: the preprocessing service's requests in its own fixed buckets."""
    r = X.requests(spark, d).where(F.col("service") == "preprocessing_service")
    return M.histogram(r, "duration_s", M.FEATURE_SECONDS).withColumn("sum", F.round("sum", 6))


@register("agg_18_features_generated", W("tx") + f"""
SELECT count(*) AS requests, CAST(count(*) * {len(EXPECTED_FEATURES)} AS BIGINT) AS features_generated FROM tx""")
def agg_18_features_generated(spark, d):
    """Counter of generated features: the values in the service vectors of all requests."""
    v = row_vector(X.transactions(spark, d))
    made = F.size(F.filter(F.array(*v.columns), lambda x: x.isNotNull()))
    return v.agg(F.count(F.lit(1)).alias("requests"), F.sum(made).cast("bigint").alias("features_generated"))


@register("agg_18_request_counts", W("req") + "SELECT method, endpoint, status, count(*) AS n FROM req GROUP BY ALL")
def agg_18_request_counts(spark, d):
    """Requests by method, endpoint and status."""
    return X.requests(spark, d).groupBy("method", "endpoint", "status").agg(F.count(F.lit(1)).alias("n"))


@register("agg_18_prediction_counts", W("req") + f"""
SELECT CASE WHEN probability >= 0.5 THEN 'fraud' ELSE 'legitimate' END AS prediction, {_TIER_SQL} AS risk_level,
       count(*) AS n FROM req WHERE status <> 500 GROUP BY ALL""")
def agg_18_prediction_counts(spark, d):
    """Predictions by class and tier."""
    s = _scored(spark, d)
    return s.groupBy(S.label_name(F.col("is_fraud")).alias("prediction"), "risk_level").agg(
        F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- DRF-01 .. 05, TOP-01, PRJ-09
_BIN_SQL = " + ".join(f"CAST(x >= CAST({i} AS DOUBLE) * step + lo AS INTEGER)" for i in range(1, DR.PSI_BINS))
_PSI_SQL = W("train", "test") + MO.DRIFT_SQL + f"""
, rng AS (SELECT feature, count(x) AS n_ref,
                 CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
                 CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM ref GROUP BY feature)
, r2 AS (SELECT *, (hi - lo) / CAST({DR.PSI_BINS} AS DOUBLE) AS step FROM rng)
, ncur AS (SELECT feature, count(x) AS n_cur FROM cur GROUP BY feature)
, rb AS (SELECT feature, {_BIN_SQL} AS bin, count(*) AS n FROM ref JOIN r2 USING (feature) WHERE x >= lo AND x <= hi GROUP BY ALL)
, cb AS (SELECT feature, {_BIN_SQL} AS bin, count(*) AS n FROM cur JOIN r2 USING (feature) WHERE x >= lo AND x <= hi GROUP BY ALL)
, grid AS (SELECT feature, n_ref, unnest(range(0, {DR.PSI_BINS})) AS bin FROM r2)
, g AS (SELECT grid.feature, COALESCE(rb.n, 0) / grid.n_ref AS rp, COALESCE(cb.n / ncur.n_cur, 0) AS cp
        FROM grid LEFT JOIN rb ON grid.feature = rb.feature AND grid.bin = rb.bin
        LEFT JOIN cb ON grid.feature = cb.feature AND grid.bin = cb.bin
        LEFT JOIN ncur ON grid.feature = ncur.feature)
, g2 AS (SELECT feature, CASE WHEN rp = 0 THEN {DR.PSI_EMPTY} ELSE rp END AS rp,
                CASE WHEN cp = 0 THEN {DR.PSI_EMPTY} ELSE cp END AS cp FROM g)
, psi AS (SELECT feature, sum((cp - rp) * ln(cp / rp)) AS psi FROM g2 GROUP BY feature)
"""


def _psi(spark, d):
    ref, cur = MO.drift_samples(spark, d)
    return DR.psi(ref, cur)


@register("drf_01_psi", _PSI_SQL + "SELECT feature, round(psi, 6) AS psi FROM psi")
def drf_01_psi(spark, d):
    """PSI per feature between the reference and current samples."""
    return _psi(spark, d).select("feature", F.round("psi", 6).alias("psi"))


@register("drf_02_psi_class", _PSI_SQL + """
SELECT feature, CASE WHEN psi < 0.1 THEN 'none' WHEN psi < 0.2 THEN 'moderate' ELSE 'significant' END AS psi_class FROM psi""")
def drf_02_psi_class(spark, d):
    """PSI band: none / moderate / significant."""
    return _psi(spark, d).select("feature", DR.psi_class("psi").alias("psi_class"))


_KS_SQL = W("train", "test") + MO.DRIFT_SQL + """
, b AS (SELECT feature, x, 1 AS r, 0 AS c FROM ref UNION ALL SELECT feature, x, 0, 1 FROM cur)
, g AS (SELECT feature, x, sum(r) AS nr, sum(c) AS nc FROM b GROUP BY feature, x)
, cum AS (SELECT feature, x, sum(nr) OVER w AS cr, sum(nc) OVER w AS cc FROM g
          WINDOW w AS (PARTITION BY feature ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
, tot AS (SELECT feature, CAST(sum(nr) AS BIGINT) AS n_ref, CAST(sum(nc) AS BIGINT) AS n_cur FROM g GROUP BY feature)
, ks0 AS (SELECT feature, n_ref, n_cur, max(abs(cr / n_ref - cc / n_cur)) AS ks_d FROM cum JOIN tot USING (feature) GROUP BY ALL)
, ks AS (SELECT *, CASE WHEN lam < 0.05 THEN 1.0
              WHEN lam < 1 THEN 1 - sqrt(2 * pi()) / lam * list_sum([exp(-(2 * k - 1) * (2 * k - 1) * pi() * pi() / (8 * lam * lam)) for k in range(1, 9)])
              ELSE 2.0 * list_sum([pow(-1.0, k - 1) * exp(-2.0 * k * k * lam * lam) for k in range(1, 31)]) END AS p_value
         FROM (SELECT *, sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur)) * ks_d AS lam FROM ks0))
"""


def _ks(spark, d):
    ref, cur = MO.drift_samples(spark, d)
    return DR.ks(ref, cur)


@register("drf_03_ks", _KS_SQL + "SELECT feature, n_ref, n_cur, round(ks_d, 6) AS ks_d, round(p_value, 6) AS p_value FROM ks")
def drf_03_ks(spark, d):
    """Two-sample KS statistic D (exact, via global prefix sums) and asymptotic p-value."""
    k = _ks(spark, d)
    return k.select("feature", "n_ref", "n_cur", F.round("ks_d", 6).alias("ks_d"), F.round("p_value", 6).alias("p_value"))


@register("drf_04_drift_flags", _KS_SQL + """
SELECT count(*) AS features, count_if(p_value < 0.05) AS drifted_count,
       count_if(p_value < 0.05) / count(*) >= 0.5 AS dataset_drift FROM ks""")
def drf_04_drift_flags(spark, d):
    """Per-feature drift flags summarised: drifted count and dataset-level flag."""
    return DR.drift_flags(_ks(spark, d))


@register("drf_04_feature_flags", _KS_SQL + "SELECT feature, p_value < 0.05 AS drift_detected FROM ks")
def drf_04_feature_flags(spark, d):
    """Drift flag of every feature."""
    return DR.feature_flags(_ks(spark, d)).select("feature", "drift_detected")


@register("drf_05_drift_summary", W("train", "test") + MO.DRIFT_SQL + """
SELECT (SELECT count(*) FROM ref WHERE feature = 'TransactionAmt') AS reference_samples,
       (SELECT count(DISTINCT feature) FROM ref) AS reference_features,
       (SELECT count(*) FROM cur WHERE feature = 'TransactionAmt') AS current_samples,
       (SELECT count(*) % 100 FROM cur WHERE feature = 'TransactionAmt') AS buffer_size, CAST(100 AS BIGINT) AS buffer_capacity,
       'ok' AS status""")
def drf_05_drift_summary(spark, d):
    """Drift summary: reference size, features, current size, rows waiting for the next check and its size, status."""
    ref, cur = MO.drift_samples(spark, d)
    return MO.drift_summary(ref, cur, "TransactionAmt")


@register("top_01_drift_top10", _KS_SQL + """
SELECT feature, round(ks_d, 6) AS drift_score FROM ks ORDER BY ks_d DESC, feature LIMIT 10""")
def top_01_drift_top10(spark, d):
    """Ten features with the highest drift score."""
    k = _ks(spark, d)
    return k.orderBy(F.col("ks_d").desc(), "feature").limit(10).select(
        "feature", F.round("ks_d", 6).alias("drift_score"))


@register("prj_09_common_columns", W("train", "test") + """
SELECT TransactionAmt, card1, addr1, C1 FROM test""")
def prj_09_common_columns(spark, d):
    """Current sample restricted to the columns of the stored reference sample (its schema is read, not its rows)."""
    train, test = X.train_test(spark, d)
    path = scratch_path(spark, "reference-columns")
    SK.save_reference_sample(train.select("TransactionAmt", "card1", "addr1", "C1", "isFraud"), path)
    return MO.common_columns(SK.read_reference_sample(spark, path), test)


@register("fun_13_latency_hours", W("pred") + """
SELECT transaction_id, round((epoch_us(label_ts) - epoch_us(pred_ts)) / 3.6e9, 6) AS latency_h FROM pred WHERE label_ts IS NOT NULL""")
def fun_13_latency_hours(spark, d):
    """Hours between prediction and label time (microsecond exact)."""
    p = X.prediction_log(spark, d).where(F.col("label_ts").isNotNull())
    return p.select("transaction_id", F.round(hours_between(F.col("pred_ts"), F.col("label_ts")), 6).alias("latency_h"))


# ---------------------------------------------------------------- runs over given data: ML-05, TOP-02, ML-06
# Three classifiers that need no training: the logged probability cut at three heights.
CUTS = (0.3, 0.5, 0.7)
_RUNS_SQL = W("pred") + f"""
, lab AS ({LAB})
, cuts AS (SELECT unnest([{', '.join(map(str, CUTS))}]) AS cut, unnest(range({len(CUTS)})) AS run_order)
, cm AS (SELECT cut, run_order, count_if(ground_truth = 1 AND probability >= cut) AS tp, count_if(ground_truth = 0 AND probability >= cut) AS fp,
                count_if(ground_truth = 0 AND probability < cut) AS tn, count_if(ground_truth = 1 AND probability < cut) AS fn
         FROM cuts, lab GROUP BY ALL)
, runs AS (SELECT 'cut_' || CAST(CAST(cut * 100 AS INTEGER) AS VARCHAR) AS model, CAST(run_order AS INTEGER) AS run_order,
                  (SELECT auc FROM {_auc_sql('lab')}) AS auc, {_RATES_SQL}, tp, fp, tn, fn FROM cm)
, best AS (SELECT * FROM runs ORDER BY f1 DESC, run_order LIMIT 1)
"""


def _cut_runs(spark, d):
    from riskframe.plans import ml as ML
    lab = _labeled(spark, d)
    out = None
    for k, cut in enumerate(CUTS):
        p = lab.withColumn("prediction", (F.col("probability") >= cut).cast("int"))
        r = _round_rates(ML.evaluate(p, "ground_truth", f"cut_{round(cut * 100)}", {"cut": cut}, k))
        out = r if out is None else out.unionByName(r)
    return out


@register("ml_05_runs_of_cuts", _RUNS_SQL + "SELECT model, run_order, auc, precision, recall, f1, tp, fp, tn, fn FROM runs")
def ml_05_runs_of_cuts(spark, d):
    """Runs table of three cuts of the logged probability over the labeled predictions."""
    return _cut_runs(spark, d).drop("params")


@register("top_02_best_cut", _RUNS_SQL + "SELECT model, run_order, f1 FROM best")
def top_02_best_cut(spark, d):
    """Best of these runs by F1 (first on ties)."""
    from riskframe.plans import ml as ML
    return ML.best_run(_cut_runs(spark, d)).select("model", "run_order", "f1")


@register("ml_06_versions_of_cuts", _RUNS_SQL + """
SELECT 'fraud_detector' AS name, CAST(run_order + 1 AS VARCHAR) AS version,
       CASE WHEN model = (SELECT model FROM best) THEN 'Production' ELSE 'None' END AS stage, model FROM runs""")
def ml_06_versions_of_cuts(spark, d):
    """Versions of the registered model, the best run staged for production."""
    from riskframe.plans import ml as ML
    runs = _cut_runs(spark, d)
    return ML.model_versions(runs, ML.best_run(runs))
