"""Learning jobs: split, three models, evaluation, selection, batch scoring (rows-only checks except the split).

A model is fitted by the first query that needs it and kept for the others of the same session and data: run one after another,
``ml_05``, ``ml_06``, ``ml_07``, ``snk_05``, ``top_02`` and ``fun_17`` take the models of ``ml_02`` to ``ml_04``.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Lock

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import functions as F

from riskframe.functions import scalar as S
from riskframe.operators import boosting as B
from riskframe.plans import ml as ML
from riskframe.plans.catalog_features import batch_features
from riskframe.plans.registry import register
from riskframe.session import cut_lineage, scratch_path
from riskframe.sources import fixtures as X

W = X.with_ctes
TABLES = ("orders", "customer", "lineitem", "documents", "labels", "events")


class _Learned:
    """What the learning queries of one application share: the prepared frames and fitted models of one state of the data.

    Another application, folder or change of the files (name, length or time) starts anew and lets the cached frame go.
    """

    def __init__(self):
        self.state, self.held = None, {}

    def of(self, spark, d) -> dict:
        state = (spark.sparkContext.applicationId, d, _files(spark, d))
        if state != self.state:
            if "prep" in self.held and self.state[0] == state[0]:
                self.held["prep"][0].unpersist()
            self.state, self.held = state, {}
        return self.held


_LEARNED = _Learned()
_BINNING = Lock()


def _files(spark, d) -> tuple:
    """(name, length, modification time) of the input tables."""
    out = []
    for t in TABLES:
        hp = spark._jvm.org.apache.hadoop.fs.Path(f"{d.rstrip('/')}/{t}.parquet")
        fs = hp.getFileSystem(spark._jsc.hadoopConfiguration())
        out += [(x.getPath().getName(), x.getLen(), x.getModificationTime()) for x in fs.listStatus(hp)] if fs.exists(hp) else []
    return tuple(out)


def _prepared(spark, d):
    """Engineered features of the labeled rows, split 80/20 per class, matrix nulls = 0."""
    held, key = _LEARNED.of(spark, d), "prep"
    if key not in held:
        bf = batch_features(spark, d)
        train = bf.where(F.col("split") == "train").drop("split")
        test = bf.where(F.col("split") == "test").drop("split", "isFraud")
        cols = ML.matrix_columns(train, test, "isFraud", "TransactionID")
        train = train.select("TransactionID", "isFraud", *cols).na.fill(0)
        test = test.select("TransactionID", *cols).na.fill(0)
        s = ML.stratified_split(train, "isFraud", "TransactionID").persist(StorageLevel.DISK_ONLY)  # memory is left to the fits
        held[key] = (s, test, cols)
    return held[key]


@contextmanager
def _binned(spark, d):
    """The training rows as boosted trees take them: made by the first fit, shared by those at the same time, let go after the last."""
    held = _LEARNED.of(spark, d)
    with _BINNING:
        if "binned" not in held:
            s, _, cols = _prepared(spark, d)
            held["binned"] = [B.Binned(s.where(F.col("split") == "train"), cols, "isFraud", "TransactionID", B.Boosting.bins), 0]
        shared = held["binned"]
        shared[1] += 1
    try:
        yield shared[0]
    finally:
        with _BINNING:
            shared[1] -= 1
            if not shared[1]:
                held.pop("binned")[0].release()


def _model(spark, d, name):
    held, key = _LEARNED.of(spark, d), name
    if key not in held:
        s, _, cols = _prepared(spark, d)
        tr = s.where(F.col("split") == "train")
        if name in ("gbt_a", "gbt_b"):
            params, title = (ML.GBT_A, "gbt_depthwise") if name == "gbt_a" else (ML.GBT_B, "gbt_leafwise")
            with _binned(spark, d) as binned:
                tm = ML.fit_gbt(tr, cols, "isFraud", "TransactionID", params, title, binned)
        else:
            tm = ML.fit_iforest(tr, cols, "TransactionID")
        tm.order = {"gbt_a": 0, "gbt_b": 1, "iforest": 2}[name]
        held[key] = tm
    return held[key]


def _run(spark, d, name):
    s, _, _ = _prepared(spark, d)
    tm = _model(spark, d, name)
    val = s.where(F.col("split") == "validation")
    pred = cut_lineage(ML.predict(tm, val, ["TransactionID", "isFraud"]))   # scored once, for the counts and the AUC
    return ML.evaluate(pred, "isFraud", tm.name, tm.params, tm.order)


def _runs(spark, d):
    """The runs of all three models, which are fitted at the same time: most passes are short and leave cores idle."""
    _prepared(spark, d)
    with ThreadPoolExecutor(3) as pool:
        a, b, c = pool.map(inheritable_thread_target(spark)(lambda name: _run(spark, d, name)), ("gbt_a", "gbt_b", "iforest"))
    return a.unionByName(b).unionByName(c)


@register("ml_01_stratified_split", W("train") + """
, r AS (SELECT TransactionID, isFraud,
               row_number() OVER (PARTITION BY isFraud ORDER BY md5(CAST(TransactionID AS VARCHAR) || ':42'), TransactionID) AS rk,
               count(*) OVER (PARTITION BY isFraud) AS n FROM train)
SELECT TransactionID, isFraud, CASE WHEN rk <= floor(n * 0.2 + 0.5) THEN 'validation' ELSE 'train' END AS split FROM r""")
def ml_01_stratified_split(spark, d):
    """Stratified 80/20 split, seed 42: per class the first 20% in md5(id:seed) order validate."""
    train, _ = X.train_test(spark, d)
    s = ML.stratified_split(train.select("TransactionID", "isFraud"), "isFraud", "TransactionID")
    return s.select("TransactionID", "isFraud", "split")


@register("ml_02_gbt_depthwise")
def ml_02_gbt_depthwise(spark, d):
    """Boosted trees A (depth 6, rate 0.1, 100 rounds, row and column sampling 0.8 per tree): validation metrics."""
    return _run(spark, d, "gbt_a")


@register("ml_03_gbt_leafwise")
def ml_03_gbt_leafwise(spark, d):
    """Boosted trees B (grown leaf by leaf to 31 leaves, rate 0.1, 100 rounds, column sampling 0.8): validation metrics."""
    return _run(spark, d, "gbt_b")


@register("ml_04_isolation_forest")
def ml_04_isolation_forest(spark, d):
    """Isolation forest (100 trees, 256 rows each, contamination 0.1): validation metrics of the anomaly score."""
    return _run(spark, d, "iforest")


@register("fun_17_outlier_flag")
def fun_17_outlier_flag(spark, d):
    """Anomaly score above the contamination threshold -> 1 for every test transaction."""
    _, test, cols = _prepared(spark, d)
    return ML.predict(_model(spark, d, "iforest"), test, ["TransactionID"])


@register("ml_05_runs")
def ml_05_runs(spark, d):
    """Runs table: model, params, AUC, precision, recall, F1 for all three models."""
    return _runs(spark, d)


@register("snk_05_runs_json")
def snk_05_runs_json(spark, d):
    """Runs written as JSON records and read back."""
    path = scratch_path(spark, "runs-json")
    _runs(spark, d).write.json(path)
    return spark.read.json(path)


@register("top_02_best_by_f1")
def top_02_best_by_f1(spark, d):
    """Best run by F1 (first on ties)."""
    return ML.best_run(_runs(spark, d))


@register("ml_06_model_versions")
def ml_06_model_versions(spark, d):
    """Versions of the registered model; latest production version compared as an integer."""
    runs = _runs(spark, d).cache()
    v = ML.model_versions(runs, ML.best_run(runs))
    return ML.latest_version(v, "Production").unionByName(ML.latest_version(v))


@register("ml_07_batch_scoring")
def ml_07_batch_scoring(spark, d):
    """The best model scores every test transaction once: class, probability, decision, tier."""
    best = ML.best_run(_runs(spark, d)).first()["model"]
    name = {"gbt_depthwise": "gbt_a", "gbt_leafwise": "gbt_b"}.get(best, "iforest")
    _, test, _ = _prepared(spark, d)
    p = ML.predict(_model(spark, d, name), test, ["TransactionID"])
    return p.withColumns({"is_fraud": S.is_fraud("prediction"), "risk_level": S.risk_level("probability")})


@register("ml_07_batch_summary")
def ml_07_batch_summary(spark, d):
    """Summary of the batch: total, fraud and legitimate counts."""
    s = ml_07_batch_scoring(spark, d)
    return s.agg(F.count(F.lit(1)).alias("total"), F.count_if("is_fraud").alias("fraud_count"),
                 F.count_if(~F.col("is_fraud")).alias("legitimate_count"))
