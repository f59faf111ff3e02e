"""Plan-shape checks: shuffles, broadcasts, pushdown."""

from pyspark.sql import functions as F


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def opt(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_key_stats_one_exchange_for_counts(spark):
    from conftest import SF_SMALL
    from riskframe.operators import keys as K
    from riskframe.sources import fixtures as X
    tr, _ = X.train_test(spark, SF_SMALL)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(K.key_stats(tr, ["card1", "card4", "card6", "addr1"], measures=["count"]))
        assert p.count("Exchange hashpartitioning") == 1
        p2 = plan(K.key_stats(tr, ["card1", "card4"], value_col="TransactionAmt", measures=["count", "nunique"]))
        assert p2.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_running_totals_no_single_partition_over_data(spark):
    from riskframe.operators.keys import running_totals
    df = spark.range(10000).select((F.col("id") * 31 % 10000).alias("v"))
    out = running_totals(df, ["v"], {"c": F.lit(1)}, ranges=4)
    p = plan(out)
    # the only single-partition window is over the per-range totals table (<= ranges rows)
    assert p.count("SinglePartition") <= 1
    assert out.agg(F.max("c")).first()[0] == 10000


def test_scan_pushdown_and_pruning(spark):
    from conftest import SF_SMALL
    from riskframe.plans.registry import QUERIES, load_all
    load_all()
    p = plan(QUERIES["src_04_feature_source"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)" in p or "EqualTo(event_type,view)" in p
    assert "GreaterThanOrEqual(ts" in p
    import re
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert {f.split(":")[0] for f in schema.split(",")} == {"user_id", "ts", "event_type", "value"}


def test_lookup_broadcast_only_under_bound(spark):
    from riskframe.operators import keys as K
    big = spark.range(100).select(F.col("id").cast("string").alias("key"), F.lit(1).alias("n"))
    df = spark.range(1000).select(F.col("id").alias("k"))
    small = K.lookup(df, big, F.col("k").cast("string"), "key", {"n": "n"}, rows=100)
    assert "broadcast" in opt(small).lower()
    huge = K.lookup(df, big, F.col("k").cast("string"), "key", {"n": "n"}, rows=10**9)
    assert "broadcast" not in opt(huge).lower()


def test_batch_features_use_broadcast_lookups(spark):
    from conftest import SF_SMALL
    from riskframe.plans.catalog_features import batch_features
    p = plan(batch_features(spark, SF_SMALL))
    assert "BroadcastHashJoin" in p


def test_asof_not_partitioned_by_key_alone(spark):
    from conftest import SF_SMALL
    from riskframe.plans.registry import QUERIES, load_all
    load_all()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(QUERIES["jon_03_asof_join"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # the row-level window is partitioned by (key, time bucket)
    assert "hashpartitioning(__k" in p and ", __b" in p


def _single_partition_inputs(p: str) -> int:
    return p.count("Exchange SinglePartition")


def test_asof_and_quantiles_have_no_single_partition_over_rows(spark):
    from conftest import SF_SMALL
    from riskframe.operators import metrics as M
    from riskframe.plans.registry import QUERIES, load_all
    from riskframe.sources import fixtures as X
    load_all()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        asof = plan(QUERIES["jon_03_asof_join"](spark, SF_SMALL))
        q = plan(M.quantiles(X.requests(spark, SF_SMALL), "duration_s", [0.5, 0.95], ["endpoint"], few_groups=True))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert _single_partition_inputs(asof) == 0
    # grouped quantiles: the only single-partition step is over the per-range totals table
    assert _single_partition_inputs(q) <= 1


def test_fitted_transform_does_not_shuffle_the_frame(spark):
    from conftest import SF_SMALL
    from riskframe.plans import features as FE
    from riskframe.sources import fixtures as X
    train, test = X.train_test(spark, SF_SMALL)
    fitted = FE.FraudFeatures().fit(train, test)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(fitted.transform(test))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # every fitted table arrives by broadcast; the only exchanges are the broadcasts and the
    # one-row mean subquery's final step
    assert "Exchange hashpartitioning" not in p
    assert p.count("BroadcastHashJoin") >= 8


def _views(spark, n):
    from riskframe.plans.store import FeatureView
    out = []
    for i in range(n):
        src = spark.range(40).select((F.col("id") % 5).alias("k"), (F.col("id") * 700 + i).alias("s"), (F.col("id") * 10 + i).cast("double").alias(f"x{i}"))
        src = src.select("k", F.timestamp_seconds("s").cast("timestamp_ntz").alias("event_timestamp"), f"x{i}").withColumn("created", F.col("event_timestamp"))
        out.append(FeatureView(f"v{i}", src, "k", [f"x{i}"], ttl_seconds=4000.0 + i))
    return out


def _entities(spark):
    e = spark.range(300).select((F.col("id") % 6).alias("k"), F.col("id").alias("i"), F.timestamp_seconds(F.col("id") * 97).cast("timestamp_ntz").alias("event_timestamp"))
    return e.withColumn("k", F.when(F.col("i") % 9 > 0, F.col("k"))).withColumn("event_timestamp", F.when(F.col("i") % 11 > 0, F.col("event_timestamp")))


def test_views_join_in_one_pass(spark, tmp_path):
    """Each view is scanned once, the entities once, and the exchanges do not grow with the views."""
    from riskframe.plans.store import FeatureView, historical_features
    _entities(spark).write.parquet(f"{tmp_path}/ent")
    ent = spark.read.parquet(f"{tmp_path}/ent")
    views = []
    for v in _views(spark, 8):
        v.source.write.parquet(f"{tmp_path}/{v.name}")
        views.append(FeatureView(v.name, spark.read.parquet(f"{tmp_path}/{v.name}"), v.key, v.features, ttl_seconds=v.ttl_seconds))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n in (1, 2, 4, 8):
            p = plan(historical_features(ent, views[:n]))
            shown = p.count("- Exchange hashpartitioning")
            assert (p.count("FileScan"), p.count("ReusedExchange"), shown) == (n + 1, 1, 3), (n, p)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_views_in_one_pass_equal_chained_asof(spark):
    import duckdb
    from riskframe.plans.store import historical_features
    views, ent = _views(spark, 5), _entities(spark)
    got = sorted((tuple(r) for r in historical_features(ent, views, bucket_seconds=900).select("i", *[f"v{k}__x{k}" for k in range(5)]).collect()))
    con = duckdb.connect()
    con.register("ent", ent.toPandas())
    sql = "SELECT e.i"
    for k, v in enumerate(views):
        con.register(f"v{k}", v.source.toPandas())
        sql += f", CASE WHEN v{k}.event_timestamp >= e.event_timestamp - to_seconds({4000 + k}) THEN v{k}.x{k} END"
    sql += " FROM ent e" + "".join(f" ASOF LEFT JOIN v{k} ON e.k = v{k}.k AND e.event_timestamp >= v{k}.event_timestamp" for k in range(5))
    want = sorted(con.sql(sql).fetchall())
    assert got == want and len(got) == 300 and sum(r[1] is not None for r in got) > 100


def test_views_with_other_keys_ties_and_null_created(spark):
    from riskframe.plans.store import FeatureView, historical_features
    t = lambda s: F.lit(f"2024-01-01 {s}").cast("timestamp_ntz")
    ent = spark.createDataFrame([(1, 7, "a"), (2, 8, "b"), (3, None, "a")], "i long, k long, m string").withColumn("event_timestamp", t("12:00:00"))
    rows = spark.createDataFrame([(7, 1, 1.0), (7, 2, 2.0), (7, None, 3.0), (8, 5, 4.0), (8, 5, 4.0)], "k long, c int, x double")
    rows = rows.withColumn("event_timestamp", t("12:00:00")).withColumn("created", F.timestamp_seconds("c").cast("timestamp_ntz")).drop("c")
    other = spark.createDataFrame([("a", 9.0)], "m string, y double").withColumn("event_timestamp", t("01:00:00")).withColumn("created", t("01:00:00"))
    views = [FeatureView("r", rows, "k", ["x"]), FeatureView("o", other, "m", ["y"])]
    h = historical_features(ent, views, bucket_seconds=600)
    assert h.columns == [*ent.columns, "r__x", "o__y"]
    assert sorted((r.i, r.r__x, r.o__y) for r in h.collect()) == [(1, 3.0, 9.0), (2, 4.0, None), (3, None, 9.0)]
    early = historical_features(ent.withColumn("event_timestamp", t("13:00:00")), views, bucket_seconds=600)   # found through earlier buckets: the same rule
    assert sorted((r.i, r.r__x) for r in early.collect()) == [(1, 3.0), (2, 4.0), (3, None)]


def test_log_join_parses_each_line_once(spark):
    from conftest import SF_SMALL
    from riskframe.plans.registry import QUERIES, load_all
    load_all()
    p = opt(QUERIES["jon_05_logs_spans"](spark, SF_SMALL))
    below = p.split("Project")
    assert not any("Filter" in part and "regexp_extract" in part.split("Filter", 1)[1].split("\n")[0] for part in below)


def test_drift_counts_both_sides_in_one_aggregate(spark):
    from conftest import SF_SMALL
    from riskframe.plans.registry import QUERIES, load_all
    load_all()
    p = plan(QUERIES["drf_01_psi"](spark, SF_SMALL))
    assert p.count("FileScan") <= 9   # ranges read the reference, the bins both samples, each a join of two tables and a scan
