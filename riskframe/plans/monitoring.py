"""Monitoring plans: labeled-prediction views, count windows and drift samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import drift as DR
from riskframe.operators.keys import row_index
from riskframe.operators.metrics import classification_report
from riskframe.sources import fixtures as X
from riskframe.sources.tables import load

DRIFT_CUTOFF = X.TRAIN_CUTOFF
CURRENT_SCALE = 1.1
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount"]


def latest_labels(labels: DataFrame, key: str = "transaction_id", label: str = "label",
                  ts: str = "label_ts") -> DataFrame:
    """WIN-01 on labels: the last submission per id wins (``max_by``, no sort)."""
    return labels.groupBy(key).agg(F.max_by(F.struct(label, ts), F.col(ts)).alias("__l")).select(
        key, F.col(f"__l.{label}").alias(label), F.col(f"__l.{ts}").alias(ts))


def attach_labels(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """SNK-04 without rewriting files: predictions LEFT JOIN the latest label per id."""
    lat = latest_labels(labels)
    return predictions.join(lat, "transaction_id", "left").withColumnRenamed("label", "ground_truth")


def count_windows(labeled: DataFrame, size: int = 100, order=("label_ts", "transaction_id"),
                  label="ground_truth", pred="prediction", score="probability") -> DataFrame:
    """WIN-04: metrics over consecutive windows of ``size`` labels; the incomplete tail is not emitted."""
    idx = row_index(labeled, list(order), name="__i")
    n = labeled.agg(F.count(F.lit(1))).scalar()          # scalar subquery: the total label count
    w = (idx.where(F.col("__i") <= F.floor(n / size) * size)
         .withColumn("window_no", F.floor((F.col("__i") - 1) / size)))
    return classification_report(w, label, pred, score, groups=["window_no"])


def drift_samples(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """M4: reference / current samples as long ``(feature, x)`` frames."""
    train, test = X.train_test(spark, d)
    li = load(spark, d, "lineitem")
    early = li.where(F.col("l_shipdate") < F.lit(DRIFT_CUTOFF).cast("timestamp_ntz"))
    late = li.where(F.col("l_shipdate") >= F.lit(DRIFT_CUTOFF).cast("timestamp_ntz"))
    ref = DR.to_long(train, ["TransactionAmt"]).unionByName(DR.to_long(early, LINE_FEATURES))
    cur = (DR.to_long(test.withColumn("TransactionAmt", F.col("TransactionAmt") * CURRENT_SCALE), ["TransactionAmt"])
           .unionByName(DR.to_long(late, LINE_FEATURES)))
    return ref, cur


def common_columns(reference: DataFrame | None, current: DataFrame) -> DataFrame:
    """PRJ-09: the current sample's columns that the reference sample has too, in its own order; none raise."""
    common = [c for c in current.columns if reference is not None and c in reference.columns]
    if not common:
        raise ValueError("no common columns between reference and current data")
    return current.select(*common)


def drift_summary(reference: DataFrame, current: DataFrame, feature: str, capacity: int = 100) -> DataFrame:
    """DRF-05: one row: sizes of both samples by ``feature``, the rows that wait for the next check of ``capacity`` rows, status."""
    r = reference.agg(F.count_if(F.col("feature") == feature).alias("reference_samples"), F.count_distinct("feature").alias("reference_features"))
    n = current.agg(F.count_if(F.col("feature") == feature)).scalar()
    return r.select("reference_samples", "reference_features", n.alias("current_samples"), (n % capacity).cast("bigint").alias("buffer_size"),
                    F.lit(capacity).cast("bigint").alias("buffer_capacity"),
                    F.when(F.col("reference_samples") > 0, "ok").otherwise("no_reference_data").alias("status"))


DRIFT_SQL = f"""
, ref AS (SELECT 'TransactionAmt' AS feature, TransactionAmt AS x FROM train
          UNION ALL SELECT 'l_quantity', l_quantity FROM lineitem WHERE l_shipdate < TIMESTAMP '{DRIFT_CUTOFF}'
          UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem WHERE l_shipdate < TIMESTAMP '{DRIFT_CUTOFF}'
          UNION ALL SELECT 'l_discount', l_discount FROM lineitem WHERE l_shipdate < TIMESTAMP '{DRIFT_CUTOFF}')
, cur AS (SELECT 'TransactionAmt' AS feature, TransactionAmt * {CURRENT_SCALE} AS x FROM test
          UNION ALL SELECT 'l_quantity', l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '{DRIFT_CUTOFF}'
          UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '{DRIFT_CUTOFF}'
          UNION ALL SELECT 'l_discount', l_discount FROM lineitem WHERE l_shipdate >= TIMESTAMP '{DRIFT_CUTOFF}')
"""
