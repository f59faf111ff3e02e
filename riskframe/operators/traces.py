"""Trace-tree operators over span tables (JON-08, WIN-07, AGG-23)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.time import epoch_micros
from riskframe.session import cut_lineage


def edges(spans: DataFrame) -> DataFrame:
    """JON-08: parent span to child span within a trace (self equi-join on (trace, parent id))."""
    p = spans.select("trace_id", F.col("span_id").alias("parent_span_id"),
                     F.col("service").alias("parent_service"), F.col("name").alias("parent_name"))
    c = spans.where(F.col("parent_span_id").isNotNull()).select(
        "trace_id", "parent_span_id", F.col("span_id").alias("child_span_id"),
        F.col("service").alias("child_service"), F.col("status").alias("child_status"),
        F.col("duration_ms").alias("child_duration_ms"))
    return c.join(p, ["trace_id", "parent_span_id"])


def service_graph(spans: DataFrame) -> DataFrame:
    """AGG-23: service edges with call count and child error rate."""
    e = edges(spans)
    return e.groupBy("parent_service", "child_service").agg(
        F.count(F.lit(1)).alias("calls"),
        (F.count_if(F.col("child_status") == "error") / F.count(F.lit(1))).alias("error_rate"))


def depths(spans: DataFrame) -> DataFrame:
    """Depth of every span (root = 0) by pointer doubling: rounds grow with the logarithm of the deepest tree.

    Every span keeps a pointer to an ancestor and the distance to it. A round
    replaces the ancestor by the ancestor's ancestor and adds the distances, so
    pointers double until all stand at a root. Spans whose chain leads out of
    the table, or into a cycle, keep a null depth; a cycle of parents never
    reaches a root and stops growing the count of finished spans, which ends
    the loop. Each round is checkpointed: it is computed once and survives
    executor loss.
    """
    base = spans.select("trace_id", "span_id", "parent_span_id").dropDuplicates(["trace_id", "span_id"])
    state = cut_lineage(base.select("trace_id", "span_id", F.col("parent_span_id").alias("up"),
                                    F.when(F.col("parent_span_id").isNull(), 0).otherwise(1).alias("depth")))
    # an open span's ``up`` is the ancestor still to follow; null means that the root is reached
    left = state.where("up IS NOT NULL").count()
    reach = 1
    while left:
        above = state.select("trace_id", F.col("span_id").alias("up"), F.col("up").alias("__up2"), F.col("depth").alias("__d2"))
        open_rows = state.where("up IS NOT NULL").join(above, ["trace_id", "up"]).select(
            "trace_id", "span_id", F.col("__up2").alias("up"), (F.col("depth") + F.col("__d2")).alias("depth"))
        state = cut_lineage(state.where("up IS NULL").unionByName(open_rows))   # orphans fall out of the inner join
        now = state.where("up IS NOT NULL").count()
        reach *= 2
        if now == left and reach > now:   # what is left only goes round in cycles
            break
        left = now
    return spans.join(state.where("up IS NULL").select("trace_id", "span_id", "depth"), ["trace_id", "span_id"], "left")


def offsets(spans: DataFrame) -> DataFrame:
    """WIN-07: span start offset from its trace start (aggregate + join: no per-trace window task)."""
    us = epoch_micros(F.col("start_ts"))
    s = spans.withColumn("__us", us)
    start = s.groupBy("trace_id").agg(F.min("__us").alias("__t0"))
    return s.join(start, "trace_id").withColumn("offset_us", F.col("__us") - F.col("__t0")).drop("__us", "__t0")
