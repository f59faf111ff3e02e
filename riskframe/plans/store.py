"""Feature store as tables: offline retrieval, materialization, online lookup, push.

A feature view is a plain spec (no registry service): where its rows come
from, which column is the entity key, the event and created times, the
feature columns and the TTL. The online table is derived data: the latest
row per key, rewritten as a new version on every materialization.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.time import epoch_micros
from riskframe.operators.asof import AsofTable, asof_join_all


@dataclass(frozen=True)
class FeatureView:
    name: str
    source: DataFrame
    key: str
    features: Sequence[str]
    event_ts: str = "event_timestamp"
    created_ts: str = "created"
    ttl_seconds: float | None = 86400.0


def source_rows(view: FeatureView, start=None, end=None) -> DataFrame:
    """SRC-04: the view's rows, optionally within ``[start, end)`` (pushed to the scan)."""
    df = view.source
    ts = F.col(view.event_ts)
    if start is not None:
        df = df.where(ts >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.where(ts < F.lit(end).cast("timestamp_ntz"))
    return df


@dataclass(frozen=True)
class OnDemandView:
    """U1: features computed at request time from views and request columns, by a user's function of a declared schema.

    ``fn`` takes the inputs by their own names (a view's features without the view's prefix, then the request columns). In
    the expression form it maps a dict of columns to a dict of columns; in the vectorised form (``vectorised``) a pandas
    frame to a pandas frame, batch by batch. Either way the outputs have to be exactly the names of ``schema``: a wrong name, a missing
    input or an expression of another type is an error when the view is applied, a wrong value type when it runs.
    """
    name: str
    sources: Sequence[FeatureView]
    request: Mapping[str, str]
    schema: Mapping[str, str]
    fn: Callable
    vectorised: bool = False

    def inputs(self, df: DataFrame) -> dict[str, Column]:
        held = {f: f"{v.name}__{f}" for v in self.sources for f in v.features} | {c: c for c in self.request}
        missing = sorted(c for c in held.values() if c not in df.columns)
        if missing:
            raise KeyError(f"on-demand view {self.name} lacks inputs {missing}")
        return {n: F.col(c).cast(self.request[n]) if n in self.request else F.col(c) for n, c in held.items()}

    def apply(self, df: DataFrame) -> DataFrame:
        """``df`` plus one column ``<view>__<feature>`` for every declared output."""
        inputs, want = self.inputs(df), ", ".join(f"{c} {t}" for c, t in self.schema.items())
        if self.vectorised:
            fn, names, label = self.fn, list(self.schema), self.name

            def run(frame):
                out = fn(frame)
                if sorted(out.columns) != sorted(names):
                    raise ValueError(f"on-demand view {label} gave {sorted(out.columns)}, declared {sorted(names)}")
                return out[names]

            run.__annotations__ = {"frame": pd.DataFrame, "return": pd.DataFrame}
            made = F.pandas_udf(run, want)(F.struct(*[c.alias(n) for n, c in inputs.items()]))
            out = df.withColumn("__od", made)
            return out.select(*df.columns, *[F.col(f"__od.{c}").alias(f"{self.name}__{c}") for c in self.schema])
        got = self.fn(inputs)
        if sorted(got) != sorted(self.schema):
            raise ValueError(f"on-demand view {self.name} gave {sorted(got)}, declared {sorted(self.schema)}")
        out = df.select(*df.columns, *[got[c].alias(f"{self.name}__{c}") for c in self.schema])
        for c, t in self.schema.items():
            kind = out.schema[f"{self.name}__{c}"].dataType.simpleString()
            if kind != df.sparkSession.createDataFrame([], f"x {t}").schema[0].dataType.simpleString():
                raise TypeError(f"on-demand feature {self.name}:{c} is {kind}, declared {t}")
        return out


def historical_features(entities: DataFrame, views: Sequence[FeatureView], entity_ts: str = "event_timestamp",
                        on_demand: Mapping[str, Callable[[], Column]] | Sequence[OnDemandView] | None = None,
                        bucket_seconds: float = 3600.0) -> DataFrame:
    """FST-01: point-in-time join of every view (as-of, backward, TTL), then on-demand columns.

    All views of one key column join in one pass, so scans and exchanges grow
    with the views and key columns, never with their product.
    """
    out = entities
    for key in dict.fromkeys(v.key for v in views):
        out = asof_join_all(out, [AsofTable(v.source, v.event_ts, v.features, v.created_ts, v.ttl_seconds, f"{v.name}__")
                                  for v in views if v.key == key], key, entity_ts, bucket_seconds)
    out = out.select(*entities.columns, *[f"{v.name}__{f}" for v in views for f in v.features])
    if on_demand and not isinstance(on_demand, Mapping):
        for view in on_demand:
            out = view.apply(out)
        return out
    for name, fn in (on_demand or {}).items():
        out = out.withColumn(name, fn())
    return out


def scoring_features(keys: DataFrame, views: Sequence[FeatureView], now, entity_ts: str = "event_timestamp",
                     on_demand: Mapping[str, Callable[[], Column]] | None = None) -> DataFrame:
    """FST-01 for batch scoring: every entity key as it stands at ``now`` (entity time = now, given by the caller)."""
    return historical_features(keys.withColumn(entity_ts, F.lit(now).cast("timestamp_ntz")), views, entity_ts, on_demand)


def latest_per_key(df: DataFrame, key: str, ts: str, created: str | None = None,
                   cols: Sequence[str] = ()) -> DataFrame:
    """WIN-01: newest row per key by ``(ts, created)``; ``max_by`` aggregate, no sort or window."""
    keep = list(cols) + [ts] + [created] * bool(created and created not in (ts, *cols))
    order = F.struct(F.col(ts), F.col(created or ts), F.xxhash64(*keep))   # the hash only decides full ties, always alike
    return df.groupBy(key).agg(F.max_by(F.struct(*keep), order).alias("__r")).select(key, "__r.*")


def materialize(view: FeatureView, start, end) -> DataFrame:
    """FST-02: online rows = latest per key among rows with ``start <= ts < end``."""
    return latest_per_key(source_rows(view, start, end), view.key, view.event_ts, view.created_ts, view.features)


def merge_online(previous: DataFrame, fresh: DataFrame, key: str, ts: str, created: str | None = None) -> DataFrame:
    """Newer of the stored and the freshly computed row per key, by ``(ts, created)``."""
    both = previous.unionByName(fresh)
    return latest_per_key(both, key, ts, created if created in both.columns else None,
                          [c for c in both.columns if c not in (key, ts, created)])


def materialize_incremental(view: FeatureView, previous: DataFrame | None, last_end, end) -> DataFrame:
    """FST-03: since the last end (the first run looks back one TTL), merged with the stored rows."""
    if previous is None or last_end is None:
        start = F.timestamp_add("SECOND", F.lit(-int(view.ttl_seconds or 0)), F.lit(end).cast("timestamp_ntz"))
        rows = view.source.where((F.col(view.event_ts) >= start) &
                                 (F.col(view.event_ts) < F.lit(end).cast("timestamp_ntz")))
        return latest_per_key(rows, view.key, view.event_ts, view.created_ts, view.features)
    fresh = materialize(view, last_end, end)
    return merge_online(previous, fresh, view.key, view.event_ts, view.created_ts)


def last_end(spark, path: str, view: str):
    """FST-03: the stored end of a view's last materialization (None before the first)."""
    hp = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hp.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hp):
        return None
    return spark.read.parquet(path).where(F.col("view") == view).agg(F.max("end")).first()[0]


def run_incremental(spark, view: FeatureView, state: str, online: str, end) -> DataFrame:
    """FST-03: materialize up to ``end`` from the stored end of the last run, then store the new end and table.

    The table of a run goes to a folder of its own, named by its end; its row in the state table is written last, so a run
    that dies before that leaves the last state and is simply run again.
    """
    at = last_end(spark, state, view.name)
    folder = lambda x: f"{online}/{view.name}-{str(x).replace(':', '').replace(' ', 'T')}"
    end_ts = spark.range(1).select(F.lit(end).cast("timestamp_ntz")).first()[0]
    if at is not None and end_ts <= at:
        return spark.read.parquet(folder(at))
    rows = materialize_incremental(view, spark.read.parquet(folder(at)) if at is not None else None, at, end_ts)
    rows.write.mode("overwrite").parquet(folder(end_ts))
    spark.range(1).select(F.lit(view.name).alias("view"), F.lit(end_ts).cast("timestamp_ntz").alias("end")).write.mode("append").parquet(state)
    return spark.read.parquet(folder(end_ts))


def online_lookup(entities: DataFrame, online: DataFrame, view: FeatureView, now: Column) -> DataFrame:
    """FST-04: LEFT join entity rows to the online table; missing or expired (older than TTL) = null."""
    o = online.select(F.col(view.key).alias("__k"), *[F.col(c).alias(f"{view.name}__{c}") for c in view.features],
                      F.col(view.event_ts).alias("__ts"))
    j = entities.join(o, entities[view.key] == o["__k"], "left")
    fresh = (epoch_micros(now) - epoch_micros(F.col("__ts"))) <= F.lit(int((view.ttl_seconds or 0) * 1_000_000))
    if view.ttl_seconds is None:
        fresh = F.lit(True)
    return j.select(*entities.columns,
                    *[F.when(fresh, F.col(f"{view.name}__{c}")).alias(f"{view.name}__{c}") for c in view.features])


def push(offline_path: str, online_path: str | None, rows: DataFrame, view: FeatureView, previous: DataFrame | None = None) -> DataFrame:
    """SNK-07 / FST-05: append pushed rows to the offline table; online = latest per key of all rows.

    With the ``previous`` online table only that and the pushed rows are read; without one (the first push) the online
    table comes from the whole offline table. It is written as a fresh version next to the old one (no in-place
    rewrite), and the new version is returned.
    """
    rows.write.mode("append").parquet(offline_path)
    spark = rows.sparkSession
    if previous is None:
        online = latest_per_key(spark.read.parquet(offline_path), view.key, view.event_ts, view.created_ts, view.features)
    else:
        fresh = latest_per_key(rows, view.key, view.event_ts, view.created_ts, view.features)
        online = merge_online(previous, fresh.select(*previous.columns), view.key, view.event_ts, view.created_ts)
    if online_path:
        online.write.mode("overwrite").parquet(online_path)
        return spark.read.parquet(online_path)
    return online


def resolve_service(df: DataFrame, refs: Sequence[str], views: Sequence[FeatureView],
                    keep: Sequence[str] = ()) -> DataFrame:
    """PRJ-10: feature-service refs ``view:feature`` or ``view`` (all its features) to a ``select``."""
    by = {v.name: v for v in views}
    cols = list(keep)
    for r in refs:
        name, _, feat = r.partition(":")
        if name not in by:
            raise KeyError(f"unknown feature view {name}")
        feats = [feat] if feat else list(by[name].features)
        cols += [f"{name}__{f}" for f in feats]
    return df.select(*cols)


def log_features(served: DataFrame, path: str) -> None:
    """FST-06: append the served frame to the service's feature log."""
    served.write.mode("append").parquet(path)
