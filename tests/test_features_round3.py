"""Sketches, counters, paired calls, key layout, alert grid, user functions, stored ends, scoring in the stream."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.functions import logs as L
from riskframe.operators import series as SE
from riskframe.operators import sketches as SKT
from riskframe.plans import monitoring as MO
from riskframe.plans import observability as OB
from riskframe.plans import store as ST
from riskframe.session import scratch_path
from riskframe.sources import fixtures as X
from riskframe.sources import sinks as SK
from riskframe.sources import tables as T


# ---------------------------------------------------------------- sketches
def _events(spark, n, seed):
    rng = np.random.default_rng(seed)
    return spark.createDataFrame(pd.DataFrame({"s": rng.integers(0, 100 * 3600, n), "g": rng.choice(["a", "b"], n, p=[0.9, 0.1]),
                                               "x": rng.exponential(size=n).round(3), "u": rng.integers(0, 5000, n)})) \
        .withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz"))


def test_sketches_of_any_range_hold_their_bounds(spark):
    df = _events(spark, 60_000, 3)
    path = scratch_path(spark, "sk")
    SKT.build(df.where("s < 200000"), "ts", 3600, ["g"], ["x"], ["u"]).write.parquet(path)
    SKT.build(df.where("s >= 200000"), "ts", 3600, ["g"], ["x"], ["u"]).write.mode("append").parquet(path)    # a later file: further rows
    rows = df.toPandas()
    for first, last in ((0, 99), (10, 59), (55, 55)):
        est = SKT.read(SKT.merge(spark.read.parquet(path), ["g"], first, last), ["g"], {"x": [0.05, 0.5, 0.99]})
        part = rows[(rows.s // 3600 >= first) & (rows.s // 3600 <= last)]
        got = {r["g"]: r for r in est.collect()}
        assert set(got) == set(part.g)
        for g, r in got.items():
            own = part[part.g == g]
            assert r["n"] == len(own)
            for name, q in (("x_p5", 0.05), ("x_p50", 0.5), ("x_p99", 0.99)):
                assert (own.x < r[name]).mean() <= q + SKT.QUANTILE_ERROR and (own.x <= r[name]).mean() >= q - SKT.QUANTILE_ERROR
            assert abs(r["u_distinct"] - own.u.nunique()) <= max(1, SKT.DISTINCT_ERROR * own.u.nunique())


def test_a_range_question_reads_sketches_only(spark):
    path = scratch_path(spark, "sk")
    SKT.build(_events(spark, 2000, 4), "ts", 3600, ["g"], ["x"], ["u"]).write.parquet(path)
    q = SKT.read(SKT.merge(spark.read.parquet(path), ["g"], 3, 7), ["g"], {"x": [0.5]})
    p = q._jdf.queryExecution().executedPlan().toString()
    assert p.count("FileScan") == 1 and "step" in p and "ts" not in [c for c in q.columns]
    assert spark.read.parquet(path).count() <= 200
    nothing = SKT.read(SKT.merge(spark.read.parquet(path), ["g"], 5000, 6000), ["g"], {"x": [0.5]})
    assert nothing.collect() == []
    nulls = SKT.build(_events(spark, 50, 4).withColumn("x", F.lit(None).cast("double")), "ts", 3600, ["g"], ["x"])
    assert all(r["x_p50"] is None for r in SKT.read(SKT.merge(nulls, ["g"]), ["g"], {"x": [0.5]}).collect())


# ---------------------------------------------------------------- counters
def _samples(n=1500, seed=2):
    rng = random.Random(seed)
    out = []
    for s, k in (("hot", n), ("b", 40), (None, 30)):
        t = v = 0
        for _ in range(k):
            t += rng.choice([1, 1, 2, 5, 40])
            v = rng.randint(0, 5) if rng.random() < 0.05 else v + rng.randint(0, 9)
            out.append((s, t, v))
    return out


def _by_hand(samples, span):
    increase, rate = {}, {}
    for s in {x[0] for x in samples}:
        rows = sorted((t, v) for x, t, v in samples if x == s)
        grown = [0] + [b - a if b >= a else b for (_, a), (_, b) in zip(rows, rows[1:])]
        for k, (t, _) in enumerate(rows):
            inside = [i for i in range(k + 1) if rows[i][0] > t - span]
            increase[s, t] = sum(grown[i] for i in inside)
            t0, v0 = rows[inside[0]]
            if len(inside) < 2:
                rate[s, t] = None
                continue
            total, width = sum(grown[i] for i in inside[1:]), t - t0
            gap, spacing = t0 - (t - span), width / (len(inside) - 1)
            back = gap if gap < 1.1 * spacing else spacing / 2
            if total > 0:
                back = min(back, width * v0 / total)
            rate[s, t] = total * (width + back) / width / span
    return increase, rate


@pytest.mark.parametrize("bucket", [60, 64, 500])
def test_counters_over_time_buckets(spark, bucket):
    samples = _samples()
    df = spark.createDataFrame(samples, "s string, t long, v long").repartition(6)
    increase, rate = _by_hand(samples, 60)
    got = {(r.s, r.t): r.increase for r in SE.counter_increase(df, ["s"], "t", "v", 60, bucket).collect()}
    assert got == increase
    got = {(r.s, r.t): r.rate for r in SE.counter_rate(df, ["s"], "t", "v", 60, units_per_second=1, bucket_us=bucket).collect()}
    assert got.keys() == rate.keys() and all(got[k] == (None if rate[k] is None else pytest.approx(rate[k])) for k in rate)


def test_a_hot_series_is_many_groups(spark):
    df = spark.range(20_000).select((F.col("id") >= 0).cast("string").alias("s"), F.col("id").alias("t"), (F.col("id") * 2).alias("v"))
    d = SE.counter_deltas(df, ["s"], "t", "v", 1000)
    per = [r["n"] for r in d.groupBy("__b").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(per) == 20 and max(per) == 1000
    p = SE.counter_increase(df, ["s"], "t", "v", 60)._jdf.queryExecution().optimizedPlan().toString()
    import re
    windows = re.findall(r"\], \[(s#\d+L?(?:, \w+#\d+L?)*)\], \[", p)
    assert sum("," not in w for w in windows) == 1     # only the table of one row per bucket has a window by series alone


# ---------------------------------------------------------------- calls
def test_calls_are_paired_in_order(spark):
    rows = [("a", "Request", 1), ("a", "Request", 2), ("a", "Response", 3), ("a", "Request", 4), ("a", "Response", 5),
            ("b", "Response", 1), (None, "Request", 1), (None, "Response", 2), (None, "Request", 3), ("a", None, 9)]
    df = spark.createDataFrame([(t, k, i, n) for i, (t, k, n) in enumerate(rows)], "trace_id string, kind string, line_no long, log_us long") \
        .withColumns({"method": F.lit("GET"), "path": F.lit("/x"), "status": F.lit(200), "duration_s": F.lit(0.1)})
    got = sorted(((r.trace_id or "-", r.k, r.request_line_no, r.response_line_no, r.status_pair) for r in L.pair_requests(df).collect()))
    assert got == [("-", 1, 6, 7, "paired"), ("-", 2, 8, None, "open"), ("a", 1, 0, 2, "paired"), ("a", 2, 1, 4, "paired"), ("a", 3, 3, None, "open"),
                   ("b", 1, None, 5, "lost")]
    hot = spark.range(3000).select(F.lit("t").alias("trace_id"), F.when(F.col("id") % 2 == 0, "Request").otherwise("Response").alias("kind"),
                                   F.col("id").alias("line_no"), F.col("id").alias("log_us"), F.lit("GET").alias("method"), F.lit("/x").alias("path"),
                                   F.lit(200).alias("status"), F.lit(0.1).alias("duration_s"))
    pairs = L.pair_requests(hot)
    assert pairs.where("status_pair = 'paired' AND response_line_no = request_line_no + 1").count() == 1500


def test_client_and_probability_of_service_lines(spark):
    head = "2025-11-09 03:22:54 - fraud_detection_api - INFO - "
    lines = [head + "log_requests:94 - Request: GET /metrics from 172.19.0.2 [trace_id=ab]",
             head + "predict:424 - Prediction completed in 0.007s - Fraud: True, Probability: 87.25%", head + "f:1 - Client: 10.0.0.1 probability=0.5"]
    got = L.parse_request_fields(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [r.client for r in got] == ["172.19.0.2", None, "10.0.0.1"] and got[0].trace_id == "ab"
    assert [r.probability for r in got] == [None, pytest.approx(0.8725), 0.5]


# ---------------------------------------------------------------- key layout
def test_lookup_skips_row_groups(spark):
    df = spark.range(200_000).select((F.col("id") * 2).alias("k"), F.rand(1).alias("x"))
    path = scratch_path(spark, "layout")
    assert SK.write_key_layout(df, path, "k", rows_per_file=50_000, rows_per_group=5000) == 4
    assert SK.write_key_layout(df, scratch_path(spark, "layout"), "k") == 1      # the count of files follows the rows

    def scanned(key):
        q = spark.read.parquet(path).where(F.col("k") == key)
        rows = q.collect()
        plan = q._jdf.queryExecution().executedPlan()
        while plan.children().size() and not plan.nodeName().startswith("Scan"):
            plan = plan.children().head()
        found = spark._jvm.scala.jdk.javaapi.OptionConverters.toJava(plan.metrics().get("numOutputRows"))
        return len(rows), found.get().value()

    n, read = scanned(123_456)
    assert n == 1 and read <= 10_000          # of 200,000 rows
    n, read = scanned(123_457)                # inside the ranges, but in no row group's Bloom filter
    assert n == 0 and read <= 10_000


# ---------------------------------------------------------------- alerts
def _requests(spark, rows):
    return spark.createDataFrame(rows, "minute long, status int, probability double, duration_s double").withColumn(
        "ts", F.expr("timestampadd(MINUTE, cast(minute as int), TIMESTAMP_NTZ'2024-01-01 00:00:00')"))


def test_minute_grid_over_days_and_its_bound(spark):
    lo = 28_401_000
    grid = OB.every_minute(spark.createDataFrame([(lo,), (lo + 5000,)], "minute long"))
    got = sorted(r[0] for r in grid.collect())
    assert got == list(range(lo, lo + 5001))
    assert OB.every_minute(spark.createDataFrame([], "minute long")).collect() == []
    wrong = OB.every_minute(spark.createDataFrame([(0,), (3_000_000_000,)], "minute long"))
    with pytest.raises(Exception, match="span more than 3660 days"):
        wrong.collect()


def test_slow_minutes_and_error_bursts_fire(spark, tmp_path):
    """The alerts without rows in the test tables: on requests that have them."""
    from riskframe.plans.registry import QUERIES, load_all
    load_all()
    rows = [(m, 200, 0.1, 0.9) for m in range(3)] + [(m, 500, 0.1, 0.01) for m in range(10, 13) for _ in range(6)] + [(60, 200, 0.1, 0.01)]
    p = OB.p95_trailing(_requests(spark, rows), 5).where(F.col("p95") > OB.SLOW_REQUEST_SECONDS)
    first = 1_704_067_200 // 60
    assert sorted(r["minute"] - first for r in p.collect()) == list(range(0, 7))
    ev = spark.createDataFrame([(i, 2 * i, f"2024-01-01 00:{10 + i % 3:02}:00", "error", 5.0) for i in range(18)] + [(99, 1, "2024-01-01 03:00:00", "view", 900.0), (100, 1, "2024-01-01 03:30:00", "view", 1.0)],
                               "event_id long, user_id long, ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    ev.write.parquet(f"{tmp_path}/events.parquet")
    bursts = QUERIES["obs_05_error_bursts"](spark, str(tmp_path)).collect()
    assert sorted((r["alert"], r["errors"]) for r in bursts) == [("ErrorsIn5m", 12), ("ErrorsIn5m", 18), ("ErrorsPerHour", 18)]
    slow = QUERIES["obs_05_slow_requests"](spark, str(tmp_path)).collect()
    assert len(slow) == 5 and all(r["p95"] > 0.5 for r in slow)


def test_rules_read_the_requests_once(spark):
    req = _requests(spark, [(m, 500, 0.9, 2.0) for m in range(30)])
    for series, _ in OB.rule_minutes(req).values():
        assert "LocalTableScan" not in series._jdf.queryExecution().optimizedPlan().toString()


# ---------------------------------------------------------------- feature store
def _view(spark, name="v"):
    t = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    src = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k long, x double").withColumns({"event_timestamp": t, "created": t})
    return ST.FeatureView(name, src, "k", ["x"])


def test_user_functions_are_checked(spark):
    v = _view(spark)
    ent = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "k long, amount int").withColumn("event_timestamp", F.lit("2024-01-01 01:00:00").cast("timestamp_ntz"))
    ok = ST.OnDemandView("f", [v], {"amount": "double"}, {"y": "double"}, lambda i: {"y": i["x"] + i["amount"]})
    vec = ST.OnDemandView("g", [v], {"amount": "double"}, {"y": "double"}, lambda p: pd.DataFrame({"y": p["x"] + p["amount"]}), vectorised=True)
    got = {r["k"]: (r["f__y"], r["g__y"]) for r in ST.historical_features(ent, [v], on_demand=[ok, vec]).collect()}
    assert got[1] == (7.0, 7.0) and got[2][0] is None and got[3][0] is None
    assert all(x is None or np.isnan(x) for x in (got[2][1], got[3][1]))
    h = ST.historical_features(ent, [v])
    with pytest.raises(ValueError, match="declared"):
        ST.OnDemandView("f", [v], {}, {"z": "double"}, lambda i: {"y": i["x"]}).apply(h)
    with pytest.raises(TypeError, match="declared"):
        ST.OnDemandView("f", [v], {}, {"y": "string"}, lambda i: {"y": i["x"]}).apply(h)
    with pytest.raises(KeyError, match="lacks inputs"):
        ST.OnDemandView("f", [v], {"missing": "double"}, {"y": "double"}, lambda i: {"y": i["x"]}).apply(h)
    with pytest.raises(Exception, match="declared"):
        ST.OnDemandView("f", [v], {}, {"y": "double"}, lambda p: p, vectorised=True).apply(h).collect()


def test_incremental_runs_start_at_the_stored_end(spark):
    at = lambda s: F.col(s).cast("timestamp_ntz")
    rows = [(1, "2024-01-01 00:00:00", 1.0), (1, "2024-01-02 00:00:00", 2.0), (2, "2024-01-02 12:00:00", 3.0), (1, "2024-01-03 00:00:00", 4.0)]
    src = spark.createDataFrame(rows, "k long, t string, x double").select("k", "x", at("t").alias("event_timestamp"), at("t").alias("created"))
    v = ST.FeatureView("v", src, "k", ["x"], ttl_seconds=86400.0)
    state, online = scratch_path(spark, "ends"), scratch_path(spark, "online")
    run = lambda end: sorted((r.k, r.x) for r in ST.run_incremental(spark, v, state, online, end).collect())
    assert ST.last_end(spark, state, "v") is None
    assert run("2024-01-02 06:00:00") == [(1, 2.0)]                       # first run: one TTL back
    assert run("2024-01-02 18:00:00") == [(1, 2.0), (2, 3.0)]
    assert run("2024-01-02 18:00:00") == [(1, 2.0), (2, 3.0)]             # the same end again changes nothing
    assert spark.read.parquet(state).count() == 2
    # a run that died before its row was stored: its folder is overwritten by the next try
    spark.createDataFrame([(9, 9.0)], "k long, x double").write.parquet(f"{online}/v-2024-01-04T000000")
    assert run("2024-01-04 00:00:00") == [(1, 4.0), (2, 3.0)]
    assert str(ST.last_end(spark, state, "v")) == "2024-01-04 00:00:00" and ST.last_end(spark, state, "other") is None


# ---------------------------------------------------------------- sources and small rules
def test_empty_collection_raises(spark):
    path = scratch_path(spark, "empty")
    spark.createDataFrame([], "_id string, k long").write.parquet(path)
    with pytest.raises(ValueError, match="empty"):
        T.read_collection(spark, path, required=["k"])


def test_common_columns_of_a_stored_sample(spark):
    path = scratch_path(spark, "ref")
    cur = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, c string")
    with pytest.raises(ValueError):
        MO.common_columns(SK.read_reference_sample(spark, path), cur)
    SK.save_reference_sample(cur.select("c", "b"), path)
    assert MO.common_columns(SK.read_reference_sample(spark, path), cur).columns == ["b", "c"]
    SK.save_reference_sample(cur.select(F.col("a").alias("z")), path)
    with pytest.raises(ValueError):
        MO.common_columns(SK.read_reference_sample(spark, path), cur)


def test_empty_identity_skips_the_join(spark):
    tx = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k long, x double")
    ident = spark.createDataFrame([], "i long, name string")
    j = X.identity_join(tx, ident, "k", "i")
    assert sorted((r.k, r.name) for r in j.collect()) == [(1, None), (2, None)]
    assert "Join" not in j._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_prediction_log_keeps_features_and_label_fields(spark):
    df = spark.createDataFrame([(1, 1, 0.7, {"a": 1.5, "b": None}), (2, 0, 0.2, None)], "transaction_id long, prediction int, probability double, features map<string,double>") \
        .withColumn("pred_ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    path = scratch_path(spark, "log")
    SK.prediction_records(df).write.option("ignoreNullFields", "false").json(path)
    text = spark.read.text(path).collect()
    assert all('"ground_truth":null' in r.value and '"label_ts":null' in r.value for r in text)
    back = {r.transaction_id: r for r in SK.read_prediction_log(spark, path).collect()}
    assert back[1].features == {"a": 1.5, "b": None} and back[2].features is None and back[1].label_ts is None


def test_stream_scores_equal_the_batch(spark):
    from conftest import SF_SMALL
    from riskframe.plans.registry import QUERIES, load_all
    from riskframe.streaming import catalog_streams as CS
    from riskframe.streaming import jobs as J
    load_all()
    got = {r.TransactionID: r for r in QUERIES["str_01_model_scoring"](spark, SF_SMALL).collect()}
    tx = CS._stream_transactions(T.load(spark, SF_SMALL, "orders"), T.load(spark, SF_SMALL, "customer"))
    want = {r.TransactionID: r for r in J.score_transactions(tx, CS.scoring_model(spark, SF_SMALL)).collect()}
    assert got == want and len(got) == 1500
    assert {r.risk_level for r in want.values()} <= {"LOW", "MEDIUM", "HIGH", "CRITICAL"} and len({r.probability for r in want.values()}) > 20


def test_push_reads_the_previous_table_only(spark):
    v = _view(spark)
    offline = scratch_path(spark, "offline")
    v.source.write.parquet(offline)
    first = ST.latest_per_key(v.source, "k", "event_timestamp", "created", ["x"])
    late = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    pushed = spark.createDataFrame([(2, 9.0), (3, 7.0)], "k long, x double").withColumns({"event_timestamp": late, "created": late})
    online = ST.push(offline, None, pushed, v, previous=first)
    assert sorted((r.k, r.x) for r in online.collect()) == [(1, 2.0), (2, 9.0), (3, 7.0)]
    assert "FileScan" not in online._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.k, r.x) for r in ST.push(offline, None, pushed.limit(0), v).collect()) == [(1, 2.0), (2, 9.0), (3, 7.0)]


def test_long_keys_count_towards_the_broadcast_bound(spark):
    from riskframe.operators import keys as K
    short = spark.range(1000).select(F.lit("a").alias("feature"), F.col("id").cast("string").alias("key"))
    long = short.withColumn("key", F.concat("key", F.lit("x" * 960)))
    a, b = K.stats_sizes(short)["a"], K.stats_sizes(long)["a"]
    assert 1000 <= a <= 1100 and b > 10 * a
    per = K.BROADCAST_BYTES // K.BYTES_PER_STATS_ROW
    assert K.broadcastable(per) and not K.broadcastable(per + 1)
