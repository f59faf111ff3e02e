"""Model-quality and histogram measures as aggregates (AGG-08..11, AGG-16/17, OBS-02).

All of them are pure functions of a labeled table: no cumulative counters
that a re-run could double (section 0.1, Q15).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.keys import running_totals

# Fixed bucket bounds of the reference's histograms.
LABEL_LATENCY_HOURS = (1, 6, 12, 24, 48, 72, 168)
PREDICTION_SECONDS = (0.01, 0.05, 0.1, 0.5, 1.0, 2.0, 5.0)
FEATURE_SECONDS = (0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0)


def confusion(df: DataFrame, label: str, pred: str, groups: Sequence = ()) -> DataFrame:
    """AGG-08: TP / FP / TN / FN, always four numbers (no unpacking failure on one class)."""
    y, p = F.col(label), F.col(pred)
    return df.groupBy(*groups).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )


def rates(tp: Column, fp: Column, tn: Column, fn: Column) -> dict[str, Column]:
    """AGG-09: precision, recall, F1 (0 when undefined) and accuracy from the four counts."""
    z = F.lit(0.0)
    return {
        "precision": F.coalesce(F.try_divide(tp, tp + fp), z),
        "recall": F.coalesce(F.try_divide(tp, tp + fn), z),
        "f1": F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), z),
        "accuracy": F.coalesce(F.try_divide(tp + tn, tp + fp + tn + fn), z),
    }


def auc(df: DataFrame, label: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    """AGG-10: ROC AUC (Mann-Whitney with tie midranks); null when a group has one class.

    Scores are first reduced to distinct values with positive / negative
    counts; the negatives below each value come from the H1 running total, so
    no single task sees a whole group.
    """
    g = df.where(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(*groups, score).agg(
        F.count_if(F.col(label) == 1).alias("__pos"), F.count_if(F.col(label) == 0).alias("__neg"))
    c = running_totals(g, [score], {"__below": F.col("__neg")}, groups=groups, inclusive=False)
    return c.groupBy(*groups).agg(
        F.try_divide(F.sum(F.col("__pos") * (F.col("__below") + F.col("__neg") * 0.5)),
                     F.sum("__pos").cast("double") * F.sum("__neg")).alias("auc"),
        F.sum("__pos").alias("__p"), F.sum("__neg").alias("__n"),
    ).select(*groups, F.when((F.col("__p") > 0) & (F.col("__n") > 0), F.col("auc")).alias("auc"))


def classification_report(df: DataFrame, label: str, pred: str, score: str | None = None,
                          groups: Sequence[str] = ()) -> DataFrame:
    """AGG-08..10 together: counts, rates and (with ``score``) AUC per group."""
    cm = confusion(df, label, pred, groups)
    r = rates(F.col("tp"), F.col("fp"), F.col("tn"), F.col("fn"))
    out = cm.select(*groups, "tp", "fp", "tn", "fn", *[v.alias(k) for k, v in r.items()])
    if score is not None:
        a = auc(df, label, score, groups)
        out = out.join(a, list(groups), "left") if groups else out.withColumn("auc", a.select("auc").scalar())
    return out


def label_status(df: DataFrame, label: str) -> DataFrame:
    """AGG-11: total and labeled counts with ``no_labeled_data`` / ``ok`` status."""
    return df.agg(F.count(F.lit(1)).alias("total_predictions"),
                  F.count(label).alias("labeled_predictions")).withColumn(
        "status", F.when(F.col("labeled_predictions") == 0, "no_labeled_data").otherwise("ok"))


def bound_label(b: float) -> str:
    """Bucket label as written in the bucket list (``1``, ``0.5``, ``1.0``)."""
    return str(b)


def histogram(df: DataFrame, value: str, bounds: Sequence[float], groups: Sequence = ()) -> DataFrame:
    """AGG-16/17: cumulative bucket counts (``le`` label, +Inf last), sum and count per group.

    One aggregate with one conditional count per bound, then an in-row
    unpivot: no extra shuffle for the bucket grid.
    """
    v = F.col(value)
    aggs = [F.count_if(v <= F.lit(float(b))).alias(f"__b{i}") for i, b in enumerate(bounds)]
    wide = df.where(v.isNotNull()).groupBy(*groups).agg(*aggs, F.count(v).alias("__inf"),
                                                        F.sum(v).alias("sum"))
    labels = [bound_label(b) for b in bounds] + ["+Inf"]
    cells = F.array(*[F.struct(F.lit(lab).alias("le"), F.lit(float(b) if i < len(bounds) else None)
                               .cast("double").alias("upper"), F.col(c).alias("cumulative_count"))
                      for i, (lab, b, c) in enumerate(zip(labels, list(bounds) + [None],
                                                          [f"__b{i}" for i in range(len(bounds))] + ["__inf"]))])
    return wide.select(*groups, "sum", F.col("__inf").alias("count"), F.inline(cells))


def bucket_quantile(hist: DataFrame, q: float, groups: Sequence[str] = (), name: str | None = None) -> DataFrame:
    """OBS-02: quantile estimated from cumulative buckets, linear inside the bucket.

    The first bucket starts at 0; a rank falling in +Inf returns the last finite bound.
    """
    name = name or f"q{int(round(q * 100))}"
    w = Window.partitionBy(*groups).orderBy(F.col("upper").asc_nulls_last())
    h = hist.select(*groups, "upper", "cumulative_count", "count",
                    F.lag("upper").over(w).alias("lower"),
                    F.lag("cumulative_count").over(w).alias("prev"))
    rank = F.col("count") * F.lit(q)
    hit = h.where((F.col("cumulative_count") >= rank) & (F.col("count") > 0))
    first = hit.groupBy(*groups).agg(F.min_by(F.struct("upper", "lower", "prev", "cumulative_count", "count"),
                                              F.coalesce(F.col("upper"), F.lit(float("inf")))).alias("b"))
    lo = F.coalesce(F.col("b.lower"), F.lit(0.0))
    prev = F.coalesce(F.col("b.prev"), F.lit(0))
    inside = lo + (F.col("b.upper") - lo) * F.try_divide(F.col("b.count") * F.lit(q) - prev,
                                                         F.col("b.cumulative_count") - prev)
    return first.select(*groups, F.when(F.col("b.upper").isNull(), F.col("b.lower")).otherwise(inside).alias(name))


def bucket_counts(value: Column, bounds: Sequence[float]) -> list[Column]:
    """The aggregates behind ``quantile_of_counts``: rows up to each bound, then all rows with a value."""
    return [F.count_if(value <= F.lit(float(b))) for b in bounds] + [F.count(value)]


def quantile_of_counts(counts: Sequence[str], bounds: Sequence[float], q: float) -> Column:
    """OBS-02 on one row: ``counts`` are columns of cumulative bucket counts, the total last; null without rows.

    The same rule as ``bucket_quantile``, as an expression: any number of quantiles costs no further pass.
    """
    n = F.col(counts[-1])
    rank = n * F.lit(q)
    out = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        below, lower = (F.col(counts[i - 1]), float(bounds[i - 1])) if i else (F.lit(0), 0.0)
        inside = F.lit(lower) + F.lit(float(bounds[i]) - lower) * F.try_divide(rank - below, F.col(counts[i]) - below)
        out = F.when(F.col(counts[i]) >= rank, inside).otherwise(out)
    return F.when(n > 0, out)


def quantiles(df: DataFrame, value: str, qs: Sequence[float], groups: Sequence[str] = (),
              names: Sequence[str] | None = None, few_groups: bool = False) -> DataFrame:
    """Exact interpolated quantiles (``quantile_cont`` semantics) without a per-group value buffer.

    Rows are first counted per value (partial aggregation: a hot value is one
    row from then on), the counts get running totals (H1, range-partitioned, so
    a hot group is spread over many tasks), and a value is picked when one of
    the ranks ``floor(h)`` and ``ceil(h)``, ``h = q (n - 1)``, lies among its
    rows. ``few_groups``: see ``running_totals``.
    """
    names = list(names or [f"p{int(round(q * 100))}" for q in qs])
    v = df.where(F.col(value).isNotNull()).groupBy(*groups, F.col(value).cast("double").alias("__x")).agg(F.count(F.lit(1)).alias("__c"))
    ranked = running_totals(v, ["__x"], {"__to": F.col("__c")}, groups=groups, few_groups=few_groups)
    n = v.groupBy(*groups).agg(F.sum("__c").alias("__n"))
    if groups:
        ranked = ranked.join(F.broadcast(n) if few_groups else n, list(groups))
    else:
        ranked = ranked.withColumn("__n", n.scalar())
    last, first = F.col("__to"), F.col("__to") - F.col("__c")
    aggs = [F.max("__n").alias("__n")]
    for i, q in enumerate(qs):
        h = (F.col("__n") - 1) * F.lit(float(q))
        for side, rank in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            aggs.append(F.max(F.when((rank >= first) & (rank < last), F.col("__x"))).alias(f"__{side}{i}"))
    got = ranked.groupBy(*groups).agg(*aggs)
    out = []
    for i, (q, name) in enumerate(zip(qs, names)):
        # weighted form (ceil(h) - h) * lo + (h - floor(h)) * hi, the same float operations as
        # Spark's percentile and DuckDB's quantile_cont
        h, lo, hi = (F.col("__n") - 1) * F.lit(float(q)), F.col(f"__lo{i}"), F.col(f"__hi{i}")
        out.append(F.when(F.floor(h) == F.ceil(h), lo).otherwise((F.ceil(h) - h) * lo + (h - F.floor(h)) * hi).alias(name))
    return got.select(*groups, *out)
