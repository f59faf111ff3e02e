"""Streaming operators (STR-01 .. STR-07).

The reference kept 100-item buffers inside a web process; here every stream
is a Structured Streaming query. State lies in Spark's state store, hash-dealt
by key: window aggregates, join sides within their horizon, the latest row per
key and the ids counted so far; count windows keep at most ``size - 1`` open
rows plus one offset.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions import scalar as S
from riskframe.functions.logs import parse_log_line
from riskframe.functions.time import epoch_micros, hours_between
from riskframe.operators import boosting as B
from riskframe.operators import drift as DR
from riskframe.operators.keys import row_index
from riskframe.operators.metrics import PREDICTION_SECONDS, classification_report
from riskframe.plans.features import row_vector
from riskframe.plans.store import latest_per_key
from riskframe.sources import fixtures as X

LABEL_HORIZON_HOURS = 168


def score_stream(events: DataFrame) -> DataFrame:
    """STR-01: each arriving request is scored: decision, tier and transaction code (no state)."""
    r = X.requests_of(events).where(F.col("status") != 500)
    return r.select("event_id", "probability", S.is_fraud("probability").alias("is_fraud"),
                    S.risk_level("probability").alias("risk_level"),
                    S.transaction_code("ts", "event_id").alias("transaction_code"))


def score_transactions(transactions: DataFrame, model: B.Model, id_col: str = "TransactionID", ts: str = "ts") -> DataFrame:
    """STR-01 whole: arriving transactions get their feature vector (each row on its own), the model's probability, decision, tier and code (no state)."""
    v = row_vector(transactions, carry=(id_col, ts))
    p = B.predict(v, model, [id_col, ts])
    return p.select(id_col, "probability", S.is_fraud("probability").alias("is_fraud"), S.risk_level("probability").alias("risk_level"),
                    S.transaction_code(ts, id_col).alias("transaction_code"))


def request_metrics(events: DataFrame, window: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """STR-02: per tumbling window: requests, error rate, fraud rate, duration bucket counts.

    Append mode: a window is emitted once the watermark (max event time
    minus ``delay``) passes its end; later rows for it are dropped by Spark.
    """
    r = X.requests_of(events).withColumn("et", F.col("ts").cast("timestamp")).withWatermark("et", delay)
    ok = F.col("status") != 500
    g = r.groupBy(F.window("et", window).alias("w")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("status") >= 500).alias("errors"),
        F.count_if(ok).alias("scored"),
        F.count_if(ok & (F.col("probability") >= 0.5)).alias("frauds"),
        *[F.count_if(F.col("duration_s") <= b).alias(f"le_{str(b).replace('.', '_')}") for b in PREDICTION_SECONDS])
    return g.withColumn("window_start_us", F.unix_micros(F.col("w.start"))).drop("w")


def labeled_stream(labels: DataFrame, predictions: DataFrame) -> DataFrame:
    """Label arrivals joined to the (static) prediction log: the input of count windows."""
    lab = X.labels_of(labels)
    return lab.join(predictions.drop("pred_ts"), "transaction_id").withColumnRenamed("label", "ground_truth")


def label_metrics(done: DataFrame) -> DataFrame:
    """The classification report of every complete window of labels."""
    return classification_report(done, "ground_truth", "prediction", "probability", groups=["window_no"])


def drift_against(reference: DataFrame, features: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """STR-03 over predictions: PSI, KS and the drift flag of every feature in each complete window.

    ``reference`` is the long ``(feature, x)`` training sample; its rows are counted per value
    once, so a batch joins to that table and never to the sample again.
    """
    held = DR.Reference(reference)

    def evaluate(done: DataFrame) -> DataFrame:
        return held.drift(DR.to_long(done, features, ["window_no"]), "window_no")

    return evaluate


class CountWindows:
    """STR-03: a report every ``size`` rows in arrival order, as ``foreachBatch``.

    ``evaluate`` maps the rows of complete windows (column ``window_no``) to their report:
    label metrics, or drift over predictions (``drift_against``).

    Per micro-batch: the batch rows get global positions after the stored
    offset (H1 row index, in ``order`` inside the batch), rows of the open
    window from the state are added, complete windows are evaluated and
    written, and the rows of the still-open window (fewer than ``size``) plus
    the new offset become the next state version. Each batch overwrites its own
    output folder and state version, so a replayed batch is idempotent; a
    missing state of the batch before is an error.
    """

    def __init__(self, state_path: str, out_path: str, size: int = 100,
                 order=("label_ts", "transaction_id"), evaluate: Callable[[DataFrame], DataFrame] = label_metrics):
        self.state, self.out, self.size, self.order, self.evaluate = state_path, out_path, size, list(order), evaluate

    def _prev(self, spark: SparkSession, batch_id: int):
        fs = spark._jvm.org.apache.hadoop.fs
        p = fs.Path(f"{self.state}/b={batch_id - 1}/meta")
        if batch_id == 0:
            return None, 0
        if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            raise FileNotFoundError(f"no state of batch {batch_id - 1} in {self.state}")
        meta = spark.read.parquet(f"{self.state}/b={batch_id - 1}/meta").first()
        return spark.read.parquet(f"{self.state}/b={batch_id - 1}/open"), int(meta["consumed"])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        open_rows, consumed = self._prev(spark, batch_id)
        n = batch.count()
        new = row_index(batch, self.order, name="pos").withColumn("pos", F.col("pos") + consumed)
        rows = new if open_rows is None else open_rows.unionByName(new)
        rows = rows.withColumn("window_no", F.floor((F.col("pos") - 1) / self.size))
        full = rows.groupBy("window_no").agg(F.count(F.lit(1)).alias("__c")).where(F.col("__c") == self.size)
        done = rows.join(full.select("window_no"), "window_no", "left_semi")
        self.evaluate(done).write.mode("overwrite").parquet(f"{self.out}/b={batch_id}")
        rows.join(full.select("window_no"), "window_no", "left_anti").drop("window_no") \
            .write.mode("overwrite").parquet(f"{self.state}/b={batch_id}/open")
        spark.range(1).select(F.lit(consumed + n).cast("bigint").alias("consumed")) \
            .write.mode("overwrite").parquet(f"{self.state}/b={batch_id}/meta")


class BatchFolders:
    """Sink of a query in update mode, as ``foreachBatch``: a batch's rows go to its own folder, which a replay overwrites."""

    def __init__(self, path: str):
        self.path = path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/b={batch_id}")


def online_rows(pushed: DataFrame, key: str, ts: str, created: str, cols: Sequence[str]) -> DataFrame:
    """STR-04: the latest row per key as a streaming aggregate.

    In update mode a batch emits the keys it changed, so its work follows its own rows; the state
    holds one row per key. ``current_rows`` reads the table from what was emitted.
    """
    return latest_per_key(pushed, key, ts, created, cols)


def current_rows(spark: SparkSession, path: str, key: str, ts: str, created: str, cols: Sequence[str]) -> DataFrame:
    """STR-04: the online table as of the last batch: the newest of the rows emitted per key."""
    return latest_per_key(spark.read.parquet(path), key, ts, created, cols)


def label_join(predictions: DataFrame, labels: DataFrame, delay: str = "1 hour",
               horizon_hours: int = LABEL_HORIZON_HOURS) -> DataFrame:
    """STR-05: stream-stream LEFT OUTER join of labels to predictions made at most ``horizon`` hours before, latency in hours.

    Both sides carry a watermark, so Spark drops join state older than the horizon. A label whose prediction did not come
    is emitted without a latency once the watermark has passed it: no prediction that it could match can follow.
    ``reconciled_labels`` tells those without any prediction from those outside the horizon.
    """
    p = predictions.select(F.col("transaction_id").alias("pid"), "pred_ts", F.col("pred_ts").cast("timestamp").alias("pt")).withWatermark("pt", delay)
    lab = labels.withColumn("lt", F.col("label_ts").cast("timestamp")).withWatermark("lt", delay)
    cond = F.expr(f"transaction_id = pid AND pt <= lt AND pt >= lt - INTERVAL {horizon_hours} HOURS")
    j = lab.join(p, cond, "leftOuter")
    return j.select("transaction_id", "label", hours_between(F.col("pred_ts"), F.col("label_ts")).alias("latency_h"))


def reconciled_labels(joined: DataFrame, predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """STR-05, whole: the stream's joined labels plus, from the stored tables, every label that it left out.

    ``status`` is ``in_time`` for the stream's matches, ``outside_horizon`` for labels that came too late (or before the
    prediction) for the stream's bounded state, and ``unmatched`` for labels without a prediction.
    """
    joined = joined.where("latency_h IS NOT NULL")
    rest = labels.join(joined.select("transaction_id", "label").distinct(), ["transaction_id", "label"], "left_anti")
    rest = rest.join(predictions.select("transaction_id", "pred_ts"), "transaction_id", "left")
    late = hours_between(F.col("pred_ts"), F.col("label_ts"))
    return joined.withColumn("status", F.lit("in_time")).unionByName(rest.select(
        "transaction_id", "label", late.alias("latency_h"),
        F.when(F.col("pred_ts").isNull(), "unmatched").otherwise("outside_horizon").alias("status")))


def first_submissions(labels: DataFrame) -> DataFrame:
    """STR-06: each prediction id once, however often and late it is submitted again.

    The ids seen are keyed state, dealt by hash: a batch looks up its own ids only, so its work does not
    grow with the batches before it. A null id counts as one id.
    """
    return labels.select("transaction_id").dropDuplicates(["transaction_id"])


def log_level_counts(lines: DataFrame, window: str = "1 hour", delay: str = "10 minutes", by: Sequence[str] = ()) -> DataFrame:
    """STR-07: a stream of log lines (``value``) parsed and counted per level, tumbling window and the labels ``by``."""
    p = parse_log_line(lines).withColumn("et", F.col("log_ts").cast("timestamp"))
    g = p.withWatermark("et", delay).groupBy(F.window("et", window).alias("w"), "level", *by).agg(
        F.count(F.lit(1)).alias("n"))
    return g.withColumn("window_start_us", F.unix_micros(F.col("w.start"))).drop("w")


def tail_logs(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """SRC-08 / STR-07: log files followed as a text stream; new files below ``folder`` arrive as micro-batches.

    ``<folder>/<job>/<file>``: the folder's name is the line's label ``job``, the file's name its label ``filename``.
    """
    r = spark.readStream.option("recursiveFileLookup", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    at = F.split(F.col("_metadata.file_path"), "/")
    return r.text(folder).select("value", F.element_at(at, -2).alias("job"), F.element_at(at, -1).alias("filename"))


def label_submissions(labels: DataFrame) -> DataFrame:
    """Two submissions per labeled id (an early toxic flag, then the final answer) as a stream."""
    t = F.expr(f"timestampadd(HOUR, doc_id % 200, timestampadd(MINUTE, doc_id, TIMESTAMP_NTZ'{X.PRED_EPOCH}'))")
    both = F.array(F.struct(F.col("toxic").alias("label"), (t - F.expr("INTERVAL 1 HOUR")).alias("label_ts")),
                   F.struct(F.col("quality").alias("label"), t.alias("label_ts")))
    return labels.select(F.col("doc_id").alias("transaction_id"), F.inline(both))


def epoch_us(c):
    return epoch_micros(c)
