"""Queries of the feature-store area (M8: 'view' / 'click' events as views, 'purchase' rows as entities)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.time import epoch_micros
from riskframe.operators.asof import asof_join
from riskframe.plans import store as ST
from riskframe.plans.registry import register
from riskframe.session import scratch_path
from riskframe.sources import fixtures as X
from riskframe.sources.tables import load

W = X.with_ctes
TTL = 86400.0
MAT_START = "2024-01-10 00:00:00"
MAT_END = "2024-01-20 00:00:00"
MAT_END2 = "2024-01-25 00:00:00"


def _views(spark, d):
    ev = load(spark, d, "events")

    def view(kind, name):
        src = ev.where(F.col("event_type") == kind).select(
            "user_id", F.col("ts").alias("event_timestamp"), F.col("ts").alias("created"),
            F.col("value").alias(f"{kind}_value"))
        return ST.FeatureView(name, src, "user_id", [f"{kind}_value"], ttl_seconds=TTL)
    return view("view", "user_views"), view("click", "user_clicks")


ON_DEMAND = {
    # on-demand features: a view value plus a request value
    "view_plus_amount": lambda: F.col("user_views__view_value") + F.col("amount"),
    "view_plus_click": lambda: F.col("user_views__view_value") + F.col("user_clicks__click_value"),
}


def _asof_sql(ent: str, kind: str, alias: str) -> str:
    return f"""ASOF LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = '{kind}') {alias}
    ON {ent}.user_id = {alias}.user_id AND {ent}.event_timestamp >= {alias}.ts"""


def _ttl(alias: str, ent: str = "e") -> str:
    return f"CASE WHEN {alias}.ts >= {ent}.event_timestamp - INTERVAL 1 DAY THEN {alias}.value END"


@register("jon_03_asof_join", W("ent") + f"""
SELECT e.event_id, e.user_id, {_ttl('f')} AS feature_value
FROM ent e {_asof_sql('e', 'view', 'f')}""")
def jon_03_asof_join(spark, d):
    """Point-in-time join: latest 'view' value at or before each purchase, within a 1-day TTL."""
    fr = X.feature_rows(spark, d)
    ent = X.entity_rows(spark, d)
    out = asof_join(ent, fr, "user_id", "event_timestamp", "event_timestamp", ["feature_value"],
                    created="created", ttl_seconds=TTL)
    return out.select("event_id", "user_id", "feature_value")


@register("win_02_asof_day_buckets", W("ent") + f"""
SELECT e.event_id, e.user_id, {_ttl('f')} AS feature_value
FROM ent e {_asof_sql('e', 'view', 'f')}""")
def win_02_asof_day_buckets(spark, d):
    """Same carry-forward with day buckets (the TTL width: at most one earlier bucket matters)."""
    out = asof_join(X.entity_rows(spark, d), X.feature_rows(spark, d), "user_id", "event_timestamp",
                    "event_timestamp", ["feature_value"], created="created", ttl_seconds=TTL, bucket_seconds=86400)
    return out.select("event_id", "user_id", "feature_value")


_FST01_SQL = W("ent") + f"""
, h AS (SELECT e.event_id, e.user_id, e.amount, {_ttl('v')} AS user_views__view_value, e.event_timestamp
        FROM ent e {_asof_sql('e', 'view', 'v')})
, h2 AS (SELECT h.event_id, h.user_id, h.amount, h.user_views__view_value, {_ttl('c', 'h')} AS user_clicks__click_value
         FROM h {_asof_sql('h', 'click', 'c')})
"""


def _historical(spark, d):
    views = _views(spark, d)
    ent = X.entity_rows(spark, d)
    return ST.historical_features(ent, views, on_demand=ON_DEMAND), views


SCORING_TIME = "2024-01-15 12:00:00"


@register("fst_01_scoring", f"""
WITH ent AS (SELECT DISTINCT user_id, TIMESTAMP '{SCORING_TIME}' AS event_timestamp FROM events)
, h AS (SELECT e.user_id, {_ttl('v')} AS user_views__view_value, e.event_timestamp FROM ent e {_asof_sql('e', 'view', 'v')})
SELECT h.user_id, h.user_views__view_value, {_ttl('c', 'h')} AS user_clicks__click_value FROM h {_asof_sql('h', 'click', 'c')}""")
def fst_01_scoring(spark, d):
    """Scoring retrieval: the features of every user as of one given time."""
    users = X.load(spark, d, "events").select("user_id").distinct()
    h = ST.scoring_features(users, _views(spark, d), SCORING_TIME)
    return h.select("user_id", "user_views__view_value", "user_clicks__click_value")


@register("fst_01_historical", _FST01_SQL + """
SELECT event_id, user_id, amount, user_views__view_value, user_clicks__click_value,
       round(user_views__view_value + amount, 6) AS view_plus_amount,
       round(user_views__view_value + user_clicks__click_value, 6) AS view_plus_click FROM h2""")
def fst_01_historical(spark, d):
    """Training retrieval: two views joined point-in-time with TTL, then on-demand features (FUN-16)."""
    h, _ = _historical(spark, d)
    return h.select("event_id", "user_id", "amount", "user_views__view_value", "user_clicks__click_value",
                    F.round("view_plus_amount", 6).alias("view_plus_amount"),
                    F.round("view_plus_click", 6).alias("view_plus_click"))


@register("fun_16_on_demand", _FST01_SQL + """
SELECT event_id, round(user_views__view_value + amount, 6) AS view_plus_amount FROM h2""")
def fun_16_on_demand(spark, d):
    """On-demand feature: view value + request amount, as a column expression."""
    h, _ = _historical(spark, d)
    return h.select("event_id", F.round("view_plus_amount", 6).alias("view_plus_amount"))


def _sums(inputs):
    return {"plus_amount": inputs["view_value"] + inputs["amount"], "plus_click": inputs["view_value"] + inputs["click_value"]}


def _sums_of_frame(frame):
    import pandas as pd
    return pd.DataFrame({"plus_click": frame["view_value"] + frame["click_value"], "plus_amount": frame["view_value"] + frame["amount"]})


@register("fun_16_user_functions", _FST01_SQL + """
SELECT event_id, round(user_views__view_value + amount, 6) AS plus_amount, round(user_views__view_value + user_clicks__click_value, 6) AS plus_click,
       round(user_views__view_value + amount, 6) AS plus_amount_vectorised, round(user_views__view_value + user_clicks__click_value, 6) AS plus_click_vectorised
FROM h2""")
def fun_16_user_functions(spark, d):
    """On-demand features by a user's function of a declared schema: as an expression and vectorised."""
    views, declared = _views(spark, d), {"plus_amount": "double", "plus_click": "double"}
    on_demand = [ST.OnDemandView("sums", views, {"amount": "double"}, declared, _sums),
                 ST.OnDemandView("frames", views, {"amount": "double"}, declared, _sums_of_frame, vectorised=True)]
    h = ST.historical_features(X.entity_rows(spark, d), views, on_demand=on_demand)
    return h.select("event_id", *[F.round(f"sums__{c}", 6).alias(c) for c in declared], *[F.round(f"frames__{c}", 6).alias(f"{c}_vectorised") for c in declared])


@register("prj_10_feature_service", _FST01_SQL + """
SELECT event_id, user_views__view_value, user_clicks__click_value FROM h2""")
def prj_10_feature_service(spark, d):
    """Feature service = named projection of view:feature refs (a whole view or a sub-selection)."""
    h, views = _historical(spark, d)
    return ST.resolve_service(h, ["user_views:view_value", "user_clicks"], views, keep=["event_id"])


_LATEST_SQL = """SELECT user_id, arg_max(value, ts) AS view_value, epoch_us(max(ts)) AS ts_us
FROM events WHERE event_type = 'view' {cond} GROUP BY user_id"""


@register("win_01_latest_per_entity", _LATEST_SQL.format(cond=""))
def win_01_latest_per_entity(spark, d):
    """Latest feature row per entity (max_by on (event, created) time)."""
    v, _ = _views(spark, d)
    o = ST.latest_per_key(v.source, "user_id", "event_timestamp", "created", ["view_value"])
    return o.select("user_id", "view_value", epoch_micros(F.col("event_timestamp")).alias("ts_us"))


@register("fst_02_materialize", _LATEST_SQL.format(
    cond=f"AND ts >= TIMESTAMP '{MAT_START}' AND ts < TIMESTAMP '{MAT_END}'"))
def fst_02_materialize(spark, d):
    """Materialize [start, end) into the online table (latest per key)."""
    v, _ = _views(spark, d)
    o = ST.materialize(v, MAT_START, MAT_END)
    return o.select("user_id", "view_value", epoch_micros(F.col("event_timestamp")).alias("ts_us"))


@register("fst_03_materialize_incremental", _LATEST_SQL.format(
    cond=f"AND ts >= TIMESTAMP '{MAT_END}' - INTERVAL 1 DAY AND ts < TIMESTAMP '{MAT_END2}'"))
def fst_03_materialize_incremental(spark, d):
    """First run looks back one TTL from its end; the second starts at the stored end of the first and merges."""
    v, _ = _views(spark, d)
    state, online = scratch_path(spark, "ends"), scratch_path(spark, "online")
    ST.run_incremental(spark, v, state, online, MAT_END)
    second = ST.run_incremental(spark, v, state, online, MAT_END2)
    return second.select("user_id", "view_value", epoch_micros(F.col("event_timestamp")).alias("ts_us"))


@register("fst_04_online_lookup", W("ent") + f"""
, online AS ({_LATEST_SQL.format(cond=f"AND ts >= TIMESTAMP '{MAT_START}' AND ts < TIMESTAMP '{MAT_END}'")})
SELECT e.event_id, e.user_id,
       CASE WHEN epoch_us(TIMESTAMP '{MAT_END}') - o.ts_us <= 86400000000 THEN o.view_value END AS user_views__view_value
FROM ent e LEFT JOIN online o ON e.user_id = o.user_id""")
def fst_04_online_lookup(spark, d):
    """Online lookup at 'now' = materialization end: missing entity or expired row give null."""
    v, _ = _views(spark, d)
    online = ST.materialize(v, MAT_START, MAT_END)
    ent = X.entity_rows(spark, d).select("event_id", "user_id")
    out = ST.online_lookup(ent, online, v, F.lit(MAT_END).cast("timestamp_ntz"))
    return out.select("event_id", "user_id", "user_views__view_value")


@register("fst_05_push", """
SELECT user_id, arg_max(value, ts) AS view_value, epoch_us(max(ts)) AS ts_us
FROM events WHERE event_type IN ('view', 'signup') GROUP BY user_id""")
def fst_05_push(spark, d):
    """Push: 'signup' rows appended to the offline 'view' table and merged into the online table: latest per key of all rows."""
    v, _ = _views(spark, d)
    ev = load(spark, d, "events")
    pushed = ev.where(F.col("event_type") == "signup").select(
        "user_id", F.col("ts").alias("event_timestamp"), F.col("ts").alias("created"),
        F.col("value").alias("view_value"))
    offline, first = scratch_path(spark, "offline"), scratch_path(spark, "online")
    v.source.write.parquet(offline)
    ST.latest_per_key(v.source, v.key, v.event_ts, v.created_ts, v.features).write.parquet(first)
    online = ST.push(offline, scratch_path(spark, "online"), pushed, v, previous=spark.read.parquet(first))
    return online.select("user_id", "view_value", epoch_micros(F.col("event_timestamp")).alias("ts_us"))


@register("snk_07_push_offline", """
SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('view', 'signup') GROUP BY event_type""")
def snk_07_push_offline(spark, d):
    """Offline table after a push: the original rows plus the appended ones (read back)."""
    v, _ = _views(spark, d)
    ev = load(spark, d, "events")
    kind = F.col("event_type")
    offline = scratch_path(spark, "offline")
    v.source.withColumn("event_type", F.lit("view")).write.parquet(offline)
    pushed = ev.where(kind == "signup").select("user_id", F.col("ts").alias("event_timestamp"),
                                                F.col("ts").alias("created"), F.col("value").alias("view_value"),
                                                "event_type")
    pushed.write.mode("append").parquet(offline)
    return spark.read.parquet(offline).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@register("src_04_feature_source", f"""
SELECT user_id, value AS view_value FROM events
WHERE event_type = 'view' AND ts >= TIMESTAMP '{MAT_START}' AND ts < TIMESTAMP '{MAT_END}'""")
def src_04_feature_source(spark, d):
    """A view's file source read with an event-time range (filter pushed to the Parquet scan)."""
    v, _ = _views(spark, d)
    return ST.source_rows(v, MAT_START, MAT_END).select("user_id", "view_value")


@register("fst_06_feature_log", _FST01_SQL + "SELECT event_id, user_views__view_value FROM h2")
def fst_06_feature_log(spark, d):
    """Served features appended to the service's feature log, read back."""
    h, views = _historical(spark, d)
    served = ST.resolve_service(h, ["user_views"], views, keep=["event_id"])
    path = scratch_path(spark, "feature-log")
    ST.log_features(served, path)
    return spark.read.parquet(path)
