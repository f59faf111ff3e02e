"""Streaming operators: multi-batch state handling equals the batch answer."""

from pyspark.sql import functions as F

from riskframe.plans import monitoring as MO
from riskframe.session import scratch_path
from riskframe.streaming import jobs as J
from riskframe.streaming import runner as R


def _labeled(spark, n):
    return spark.range(n).select(
        F.col("id").alias("transaction_id"),
        F.expr("timestampadd(MINUTE, id, TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("label_ts"),
        ((F.col("id") * 7) % 3 == 0).cast("int").alias("ground_truth"),
        ((F.col("id") * 5) % 4 == 0).cast("int").alias("prediction"),
        ((F.col("id") * 37) % 100 / 100.0).alias("probability"))


def test_count_windows_across_batches_equal_batch(spark):
    rows = _labeled(spark, 530)
    out, state = scratch_path(spark, "cw-out"), scratch_path(spark, "cw-state")
    cw = J.CountWindows(state, out)
    # three micro-batches in arrival order: ids [0,170), [170,360), [360,530)
    for b, (lo, hi) in enumerate([(0, 170), (170, 360), (360, 530)]):
        cw(rows.where((F.col("transaction_id") >= lo) & (F.col("transaction_id") < hi)), b)
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("window_no", "tp", "fp", "tn", "fn", "auc").collect())
    want = sorted(tuple(r) for r in MO.count_windows(rows).select("window_no", "tp", "fp", "tn", "fn", "auc").collect())
    assert len(got) == 5 and got == want
    # the state after the last batch holds only the 30 rows of the open window
    assert spark.read.parquet(f"{state}/b=2/open").count() == 30


def _folder(spark, name):
    return scratch_path(spark, name)


def _stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


ONLINE = "user_id long, event_timestamp timestamp_ntz, created timestamp_ntz, v double"
SPEC = ("user_id", "event_timestamp", "created", ["v"])


def _views(spark, rows):
    return spark.createDataFrame(rows, "user_id long, t string, v double").select(
        "user_id", F.col("t").cast("timestamp_ntz").alias("event_timestamp"), F.col("t").cast("timestamp_ntz").alias("created"), "v")


def test_online_table_over_batches_and_a_restart(spark):
    src, out, ckpt = (_folder(spark, f"online-{x}") for x in ("src", "out", "ckpt"))
    run = lambda: R.run_foreach_batch(J.online_rows(_stream(spark, src, ONLINE), *SPEC), "online", J.BatchFolders(out), mode="update", checkpoint=ckpt)
    current = lambda: sorted((r.user_id, r.v) for r in J.current_rows(spark, out, *SPEC).collect())
    _views(spark, [(k, "2024-01-02", float(k)) for k in range(50)]).coalesce(1).write.mode("append").parquet(src)
    run()
    assert current() == [(k, float(k)) for k in range(50)]
    _views(spark, [(7, "2024-01-03", -1.0), (8, "2024-01-01", -2.0)]).coalesce(1).write.mode("append").parquet(src)   # newer, older
    _views(spark, [(99, "2024-01-01", 5.0)]).coalesce(1).write.mode("append").parquet(src)
    run()     # goes on from the checkpoint: two more batches
    want = [(k, -1.0 if k == 7 else float(k)) for k in range(50)] + [(99, 5.0)]
    assert current() == want
    later = spark.read.parquet(f"{out}/b=1").unionByName(spark.read.parquet(f"{out}/b=2"))
    assert later.count() <= 3     # a batch emits the keys it was given, not the table
    J.BatchFolders(out)(_views(spark, [(99, "2024-01-01", 5.0)]), 2)      # a replayed batch overwrites its own folder
    assert (99, 5.0) in current() and len(current()) == 51


def test_ids_counted_once_over_batches_and_a_restart(spark):
    src, out, ckpt = (_folder(spark, f"ids-{x}") for x in ("src", "out", "ckpt"))
    put = lambda *ids: spark.createDataFrame([(i,) for i in ids], "transaction_id long").coalesce(1).write.mode("append").parquet(src)
    run = lambda: R.run_available_now(J.first_submissions(_stream(spark, src, "transaction_id long")), "ids", out=out, checkpoint=ckpt)
    put(1, 2, 2)
    run()
    put(2, 3, None)
    put(1, 3, 4, None)
    run()
    assert sorted(str(r[0]) for r in spark.read.parquet(out).collect()) == ["1", "2", "3", "4", "None"]
    run()
    assert spark.read.parquet(out).count() == 5


def test_labels_outer_join_over_three_batches(spark):
    """Matches, labels without a prediction that the watermark has passed, and late ones; state is bounded by the horizon."""
    psrc, lsrc, out, ckpt = (_folder(spark, f"outer-{x}") for x in ("p", "l", "out", "ckpt"))
    at = lambda h: F.expr(f"timestampadd(HOUR, {h}, TIMESTAMP_NTZ'2024-01-01 00:00:00')")

    def preds(*rows):
        df = spark.createDataFrame(rows, "transaction_id long, h int")
        df.select("transaction_id", at("h").alias("pred_ts")).coalesce(1).write.mode("append").parquet(psrc)

    def labels(*rows):
        df = spark.createDataFrame([(*r, 1) for r in rows], "transaction_id long, h int, label int")
        df.select("transaction_id", "label", at("h").alias("label_ts")).coalesce(1).write.mode("append").parquet(lsrc)

    def run():
        p = spark.readStream.schema("transaction_id long, pred_ts timestamp_ntz").parquet(psrc)
        lab = spark.readStream.schema("transaction_id long, label int, label_ts timestamp_ntz").parquet(lsrc)
        R.run_available_now(J.label_join(p, lab), "outer", out=out, checkpoint=ckpt)
        return sorted((r.transaction_id, r.latency_h) for r in spark.read.parquet(out).collect())

    preds((1, 0), (2, 0), (3, 5))
    labels((1, 2), (9, 3))
    assert run() == [(1, 2.0)]                                   # 9 may still find its prediction
    preds((4, 10), (9, 3))                                      # later than the label came, but within the delay
    labels((3, 9), (8, 6), (4, 12))
    got = run()
    assert {(3, 4.0), (9, 0.0), (4, 2.0)} <= set(got)
    preds((5, 400))
    labels((2, 398), (5, 401), (7, 402))                         # 2 is later than the horizon
    got = run()
    assert got == [(1, 2.0), (2, None), (3, 4.0), (4, 2.0), (5, 1.0), (8, None), (9, 0.0)]
    pred, lab = spark.read.parquet(psrc), spark.read.parquet(lsrc)
    status = {r.transaction_id: r.status for r in J.reconciled_labels(spark.read.parquet(out), pred, lab).collect()}
    assert status == {1: "in_time", 3: "in_time", 9: "in_time", 4: "in_time", 5: "in_time", 2: "outside_horizon", 7: "unmatched", 8: "unmatched"}


def test_log_files_followed_over_batches_and_a_restart(spark):
    folder, out, ckpt = (_folder(spark, f"tail-{x}") for x in ("src", "out", "ckpt"))
    line = lambda h, m, level: f"2024-01-01 {h:02}:{m:02}:00 - app - {level} - f:1 - hello"

    def put(job, lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{folder}/{job}")

    run = lambda: R.run_available_now(J.log_level_counts(J.tail_logs(spark, folder, max_files=1), by=["job"]), "tail", out=out, checkpoint=ckpt)
    put("api", [line(0, 1, "INFO"), line(0, 2, "ERROR"), "junk"])
    put("pre", [line(0, 3, "INFO")])
    run()
    assert spark.read.schema("level string, job string, n long, window_start_us long").parquet(out).count() == 0   # the hour is open
    put("api", [line(0, 30, "INFO"), line(1, 5, "INFO")])
    put("pre", [line(3, 0, "INFO")])
    run()
    got = sorted((r.job, r.level, r.n) for r in spark.read.parquet(out).collect())
    assert got == [("api", "ERROR", 1), ("api", "INFO", 1), ("api", "INFO", 2), ("pre", "INFO", 1)]
    names = spark.read.text(f"{folder}/api").count()
    assert names == 5


def _predictions(spark, n):
    return spark.range(n).select(F.col("id").alias("transaction_id"), F.expr("timestampadd(MINUTE, id, TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("pred_ts"),
                                 ((F.col("id") * 37) % 101).cast("double").alias("a"), F.when(F.col("id") % 4 > 0, (F.col("id") % 13 + F.col("id") / 100)).alias("b"))


def test_drift_windows_over_batches_equal_the_batch_measures(spark):
    """Three micro-batches and a restart; every window's PSI and KS are those of the batch operators on its rows."""
    from riskframe.operators import drift as DR
    ref = DR.to_long(spark.range(400).select(((F.col("id") * 29) % 90).cast("double").alias("a"), (F.col("id") % 17).cast("double").alias("b")), ["a", "b"])
    src, out, state, ckpt = (_folder(spark, f"drift-{x}") for x in ("src", "out", "state", "ckpt"))
    rows = _predictions(spark, 350)

    def run(lo, hi):
        rows.where((F.col("transaction_id") >= lo) & (F.col("transaction_id") < hi)).coalesce(1).write.mode("append").parquet(src)
        cw = J.CountWindows(state, out, order=("pred_ts", "transaction_id"), evaluate=J.drift_against(ref, ["a", "b"]))
        R.run_foreach_batch(_stream(spark, src, rows.schema), "drift", cw, checkpoint=ckpt)

    for lo, hi in ((0, 130), (130, 180), (180, 350)):
        run(lo, hi)
    got = {(r.window_no, r.feature): r for r in spark.read.parquet(out).collect()}
    assert sorted(got) == [(w, f) for w in range(3) for f in "ab"]
    for w in range(3):
        cur = DR.to_long(rows.where(f"transaction_id div 100 = {w}"), ["a", "b"])
        psi = {r.feature: r.psi for r in DR.psi(ref, cur).collect()}
        ks = {r.feature: r for r in DR.ks(ref, cur).collect()}
        for f in "ab":
            assert abs(got[w, f].psi - psi[f]) < 1e-9 and abs(got[w, f].ks_d - ks[f].ks_d) < 1e-12
            assert abs(got[w, f].p_value - ks[f].p_value) < 1e-12 and got[w, f].n_cur == ks[f].n_cur
            assert got[w, f].drift_detected == (ks[f].p_value < 0.05)


def test_python_workers_need_no_installed_package(tmp_path):
    """The pandas functions ship by value: a driver started elsewhere still runs them."""
    import os
    import subprocess
    import sys
    from conftest import ROOT
    script = tmp_path / "run_iforest.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {ROOT!r})          # driver-side import only; workers get no path
from riskframe.session import get_spark
from riskframe.operators import iforest as IF
from pyspark.sql import functions as F
spark = get_spark("local[2]", shuffle_partitions=2)
df = spark.range(500).select(F.col("id"), (F.col("id") % 7).cast("double").alias("x"))
forest = IF.fit(df, ["x"], "id", trees=5, sample_size=32)
print("ROWS", IF.score(df, forest, ["x"], ["id"]).count())
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, str(script)], cwd=str(tmp_path), env=env, capture_output=True, text=True,
                       timeout=600)
    assert "ROWS 500" in r.stdout, r.stderr[-2000:]


def _parts(spark, frame, folder, name, files=3):
    frame.repartition(files).write.parquet(f"{folder}/{name}.parquet")


def test_a_table_of_several_files_is_streamed_whole(spark):
    """str_03, str_05, str_06: tables may be folders of part files beside other tables."""
    from riskframe.streaming import catalog_streams as CS

    d = _folder(spark, "parts")
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("en").alias("lang"),
                                   F.lit("web").alias("source"), (F.col("id") * 37 % 211).alias("n_chars"))
    labels = spark.range(250).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"), (F.col("id") % 3 == 0).cast("int").alias("toxic"))
    _parts(spark, docs, d, "documents")
    _parts(spark, labels, d, "labels")
    assert sorted(r.transaction_id for r in CS.str_06_first_label_only(spark, d).collect()) == list(range(250))
    assert sorted(r.window_no for r in CS.str_03_count_windows(spark, d).collect()) == [0, 1]
    joined = CS.str_05_label_join(spark, d).collect()
    assert len(joined) == 250 and sum(r.status == "in_time" for r in joined) == sum(i % 200 <= 168 for i in range(250))
    met = [r for r in CS.str_05_outer_join(spark, d).collect() if r.latency_h is not None]
    assert len(met) == sum(i % 5 > 0 and i % 200 <= 168 for i in range(250))
