"""Rows that the test tables do not hold: each operator's defined answer on hostile input."""

import math

import pytest
from pyspark.sql import functions as F

from riskframe.functions import scalar as S
from riskframe.functions.logs import parse_log_line
from riskframe.operators import drift as DR
from riskframe.operators.asof import asof_join
from riskframe.operators.series import islands
from riskframe.operators.traces import depths
from riskframe.plans import observability as OB
from riskframe.plans import store as ST
from riskframe.session import scratch_path, shared_dir
from riskframe.sources.tables import load
from riskframe.streaming import jobs as J


@pytest.mark.parametrize("lam, p", [(0.001, 1.0), (0.002, 1.0), (0.01, 1.0), (0.1, 1.0), (0.5, 0.9639452436648751), (1.0, 0.26999967167735456),
                                    (1.36, 0.049485867553775), (2.0, 0.0006709252557796953), (3.0, 3.045996e-08)])
def test_ks_p_value_known_values(spark, lam, p):
    # sqrt(nm / (n + m)) = 1 for n = m = 2
    got = spark.range(1).select(DR.ks_pvalue(F.lit(lam), F.lit(2.0), F.lit(2.0)).alias("p")).first()["p"]
    assert got == pytest.approx(p, rel=1e-6)


def test_ks_p_value_is_monotonic(spark):
    rows = spark.range(1, 3000).select(DR.ks_pvalue(F.col("id") / 1000.0, F.lit(2.0), F.lit(2.0)).alias("p"), "id").orderBy("id").collect()
    assert all(a["p"] >= b["p"] - 1e-12 for a, b in zip(rows, rows[1:]))


def test_drift_of_one_sided_and_no_features(spark):
    ref = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("old", 1.0)], "feature string, x double")
    cur = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("new", 1.0)], "feature string, x double")
    got = {r["feature"]: r for r in DR.ks(ref, cur).collect()}
    assert got["a"]["ks_d"] == 0 and got["a"]["p_value"] == 1
    assert got["old"]["ks_d"] is None and got["new"]["p_value"] is None
    none = DR.drift_flags(DR.ks(ref.limit(0), cur.limit(0))).collect()
    assert [tuple(r) for r in none] == [(0, 0, False)]


def test_depth_of_a_long_chain_orphans_and_cycles(spark):
    chain = [(1, f"s{k}", f"s{k - 1}" if k else None) for k in range(150)]
    rows = chain + [(1, "o", "missing"), (1, "o2", "o"), (2, "x", "y"), (2, "y", "x"), (2, "z", "z"), (2, "r", None), (2, "c", "r")]
    got = {(r["trace_id"], r["span_id"]): r["depth"] for r in
           depths(spark.createDataFrame(rows, "trace_id long, span_id string, parent_span_id string")).collect()}
    assert all(got[1, f"s{k}"] == k for k in range(150))
    assert got[2, "r"] == 0 and got[2, "c"] == 1
    assert all(got[k] is None for k in ((1, "o"), (1, "o2"), (2, "x"), (2, "y"), (2, "z")))


def test_asof_null_keys_match_nothing(spark):
    t = F.lit("2024-01-01 00:30:00").cast("timestamp_ntz")
    ent = spark.createDataFrame([(1, None), (2, 7)], "e long, k long").withColumn("ts", t)
    feat = spark.createDataFrame([(None, 99.0), (7, 1.0)], "k long, v double").withColumn("fts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    got = {r["e"]: r["v"] for r in asof_join(ent, feat, "k", "ts", "fts", ["v"]).collect()}
    assert got == {1: None, 2: 1.0}


def test_impossible_date_is_null(spark):
    good = "2024-02-28 10:00:00,123 - app - INFO - f:1 - hello"
    lines = spark.createDataFrame([(good,), (good.replace("02-28", "02-30"),), ("junk",)], "value string")
    assert [r["log_ts"] is None for r in parse_log_line(lines).collect()] == [False, True, True]


def test_zero_mean_gives_null(spark):
    got = spark.range(1).select(S.ratio_to_mean(F.lit(3.0), F.lit(0.0), guard=False).alias("x")).first()["x"]
    assert got is None


def test_load_turns_nan_into_null(spark, tmp_path):
    spark.createDataFrame([(1, float("nan")), (2, 1.0)], "id long, x double").write.parquet(f"{tmp_path}/events.parquet")
    assert {r["id"]: r["x"] for r in load(spark, str(tmp_path), "events").collect()} == {1: None, 2: 1.0}


def test_latest_row_breaks_ties_by_created(spark):
    rows = [(1, "2024-01-01", "2024-01-02", 5.0), (1, "2024-01-01", "2024-01-03", 6.0), (1, "2024-01-01", "2024-01-01", 4.0)]
    df = spark.createDataFrame(rows, "k long, ts string, created string, v double")
    first = ST.latest_per_key(df.where("v < 6"), "k", "ts", "created", ["v"])
    both = ST.merge_online(first, ST.latest_per_key(df.where("v <> 5"), "k", "ts", "created", ["v"]), "k", "ts", "created")
    assert first.first()["v"] == 5.0 and both.first()["v"] == 6.0


def test_count_window_replay_and_missing_state(spark):
    rows = spark.range(250).select(
        F.col("id").alias("transaction_id"), F.expr("timestampadd(MINUTE, id, TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("label_ts"),
        (F.col("id") % 3).cast("int").alias("ground_truth"), (F.col("id") % 2).cast("int").alias("prediction"), F.lit(0.5).alias("probability"))
    rows = rows.withColumn("ground_truth", (F.col("ground_truth") == 0).cast("int"))
    out = scratch_path(spark, "replay-out")
    cw = J.CountWindows(scratch_path(spark, "replay-state"), out)
    for _ in range(2):  # batch 0 is replayed
        cw(rows.where("transaction_id < 210"), 0)
    assert sorted(r["window_no"] for r in spark.read.parquet(out).collect()) == [0, 1]
    with pytest.raises(FileNotFoundError):
        J.CountWindows(scratch_path(spark, "lost-state"), out)(rows, 3)


def test_late_and_unmatched_labels_are_kept(spark):
    ts = "timestamp_ntz"
    pred = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00")], "transaction_id long, pred_ts string").withColumn("pred_ts", F.col("pred_ts").cast(ts))
    lab = spark.createDataFrame([(1, 1, "2024-01-01 02:00:00"), (2, 0, "2024-03-01 00:00:00"), (9, 1, "2024-01-01 00:00:00")],
                                "transaction_id long, label int, label_ts string").withColumn("label_ts", F.col("label_ts").cast(ts))
    joined = spark.createDataFrame([(1, 1, 2.0)], "transaction_id long, label int, latency_h double")
    got = {r["transaction_id"]: (r["status"], r["latency_h"]) for r in J.reconciled_labels(joined, pred, lab).collect()}
    assert got == {1: ("in_time", 2.0), 2: ("outside_horizon", 1440.0), 9: ("unmatched", None)}


def _requests(spark, rows):
    return spark.createDataFrame(rows, "minute int, status int, probability double, duration_s double").withColumn(
        "ts", F.expr("timestampadd(MINUTE, minute, TIMESTAMP_NTZ'2024-01-01 00:00:00')"))


@pytest.mark.parametrize("name, bad, minutes", [
    ("HighErrorRate", (500, 0.1, 0.01), range(0, 9, 2)),     # also held in the minutes between, which have no requests
    ("HighFraudRate", (200, 0.9, 0.01), range(0, 25, 5)),
    ("SlowPredictions", (200, 0.1, 3.0), range(0, 13, 3)),
])
def test_each_alert_rule_fires(spark, name, bad, minutes):
    rows = [(m, *bad) for m in minutes] + [(200, 200, 0.1, 0.01)]
    series, cond = OB.rule_minutes(_requests(spark, rows))[name]
    window, hold = next((w, h) for n, w, _, h in OB.RULES if n == name)
    runs = islands(series, [], "minute", cond, hold + 1).collect()
    first = math.floor(1704067200 / 60)
    assert [(r["start_step"] - first, r["end_step"] - first) for r in runs] == [(0, max(minutes) + window - 1)]


def test_folder_shared_by_the_cluster_is_required(spark):
    class Elsewhere:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})()
        sparkContext = type("X", (), {"getCheckpointDir": staticmethod(lambda: None), "master": "yarn"})()
    with pytest.raises(ValueError):
        shared_dir(Elsewhere())
