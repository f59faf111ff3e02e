"""Distribution drift: PSI (DRF-01/02), two-sample KS (DRF-03) and drift flags (DRF-04).

Inputs are long frames ``(feature, x)``: any number of features is handled
by the same aggregates, no per-feature jobs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.keys import running_totals
from riskframe.session import cut_lineage

# Fixed values of the reference's PSI.
PSI_BINS = 10
PSI_EMPTY = 0.0001
PSI_BANDS = ((0.1, "none"), (0.2, "moderate"))
PSI_TOP = "significant"


def to_long(df: DataFrame, features: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Wide numeric columns to ``(*carry, feature, x)``; nulls and NaN dropped."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in features])
    long = df.select(*carry, F.inline(cells))
    return long.where(F.col("x").isNotNull() & ~F.isnan("x"))


def ranges(reference: DataFrame, bins: int = PSI_BINS) -> DataFrame:
    """(feature, n_ref, lo, hi, step): the reference's equal-width bins; a single value gets a range of 1 around it."""
    rng = reference.groupBy("feature").agg(F.min("x").alias("lo0"), F.max("x").alias("hi0"), F.count("x").alias("n_ref"))
    rng = rng.select("feature", "n_ref",
                     F.when(F.col("lo0") == F.col("hi0"), F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
                     F.when(F.col("lo0") == F.col("hi0"), F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"))
    return rng.withColumn("step", (F.col("hi") - F.col("lo")) / F.lit(float(bins)))


def _bin(bins: int) -> Column:
    """Bin of ``x`` (``lo + i*step`` edges, last bin closed), null outside the range."""
    at = sum((F.col("x") >= F.lit(float(i)) * F.col("step") + F.col("lo")).cast("int") for i in range(1, bins))
    return F.when((F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi")), at)


def _psi(ref: str, n_ref: str, cur: str, n_cur: str) -> Column:
    """PSI of two arrays of bin counts; empty bins count as PSI_EMPTY, and so do those of a side without rows."""
    share = lambda c, n: F.when((c == 0) | (F.col(n) == 0), F.lit(PSI_EMPTY)).otherwise(F.try_divide(c, F.col(n)))
    parts = F.zip_with(ref, cur, lambda r, c: (share(c, n_cur) - share(r, n_ref)) * F.log(share(c, n_cur) / share(r, n_ref)))
    return F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)


def psi(reference: DataFrame, current: DataFrame, bins: int = PSI_BINS) -> DataFrame:
    """PSI per feature: equal-width bins from the reference range (last bin closed).

    Current rows outside the reference range fall in no bin but stay in the
    denominator; empty bins count as 0.0001. Bin edges are ``lo + i*step`` so
    edge cases fall exactly as with an edge-array histogram. One aggregate
    counts the bins of both sides.
    """
    both = (reference.select("feature", "x", F.lit(True).alias("ref"))
            .unionByName(current.select("feature", "x", F.lit(False).alias("ref"))))
    b = both.join(F.broadcast(ranges(reference, bins)), "feature").withColumn("bin", _bin(bins))
    g = b.groupBy("feature", "n_ref").agg(
        F.count_if(~F.col("ref")).alias("n_cur"),
        F.array(*[F.count_if(F.col("ref") & (F.col("bin") == i)) for i in range(bins)]).alias("rc"),
        F.array(*[F.count_if(~F.col("ref") & (F.col("bin") == i)) for i in range(bins)]).alias("cc"))
    return g.select("feature", _psi("rc", "n_ref", "cc", "n_cur").alias("psi"))


class Reference:
    """A reference sample ready for drift checks of many windows.

    Per feature it holds the bins' counts (one row), and per value the number of rows; both are
    written once, so a check reads no sample row again.
    """

    def __init__(self, sample: DataFrame, bins: int = PSI_BINS):
        self.bins = bins
        self.values = cut_lineage(sample.groupBy("feature", "x").agg(F.count(F.lit(1)).alias("own")))
        spans = ranges(self.values, bins).drop("n_ref").join(self.values.groupBy("feature").agg(F.sum("own").alias("n_ref")), "feature")
        b = self.values.join(F.broadcast(spans), "feature").withColumn("bin", _bin(bins))
        self.spans = cut_lineage(b.groupBy("feature", "n_ref", "lo", "hi", "step").agg(
            F.array(*[F.coalesce(F.sum(F.when(F.col("bin") == i, F.col("own"))), F.lit(0)) for i in range(bins)]).alias("rc")))

    def drift(self, current: DataFrame, window: str, p_threshold: float = 0.05) -> DataFrame:
        """(window, feature, n_ref, n_cur, psi, ks_d, p_value, drift_detected) of long rows ``(window, feature, x)``.

        D is the largest gap of the two step functions; it lies at a value of the window or just below one, so only
        the window's values are looked up in the reference, by a carried count in value order (H1). Features that the reference lacks are left out.
        """
        spans = F.broadcast(self.spans)   # one row per feature
        b = current.join(spans, "feature").withColumn("bin", _bin(self.bins))
        bins = (b.groupBy(window, "feature", "n_ref", "rc").agg(
            F.count(F.lit(1)).alias("n_cur"), F.array(*[F.count_if(F.col("bin") == i) for i in range(self.bins)]).alias("cc"))
            .select(window, "feature", "n_ref", "n_cur", _psi("rc", "n_ref", "cc", "n_cur").alias("psi")))
        seen = current.groupBy(window, "feature", "x").agg(F.count(F.lit(1)).alias("n"))
        w = Window.partitionBy(window, "feature")
        seen = seen.withColumns({"c_upto": F.sum("n").over(w.orderBy("x")), "c_all": F.sum("n").over(w)})
        asked = seen.select("feature", "x").distinct()
        ranked = running_totals(self.values.unionByName(asked.withColumn("own", F.lit(0).cast("long"))),
                                ["x", "own"], {"r_upto": F.col("own")}, groups=["feature"], few_groups=True)
        # per value: the reference rows up to it, and its own
        at = ranked.groupBy("feature", "x").agg(F.max("r_upto").alias("r_upto"), F.max("own").alias("r_own"))
        gap = lambda r, c: F.abs(F.col(r) / F.col("n_ref") - F.col(c) / F.col("c_all"))
        j = (seen.join(at, ["feature", "x"]).join(spans.select("feature", "n_ref"), "feature")
             .withColumns({"r_below": F.col("r_upto") - F.col("r_own"), "c_below": F.col("c_upto") - F.col("n")}))
        d = j.groupBy(window, "feature").agg(F.max(F.greatest(gap("r_upto", "c_upto"), gap("r_below", "c_below"))).alias("ks_d"))
        out = bins.join(d, [window, "feature"]).withColumn("p_value", ks_pvalue(F.col("ks_d"), F.col("n_ref").cast("double"), F.col("n_cur").cast("double")))
        return out.withColumn("drift_detected", F.coalesce(F.col("p_value") < p_threshold, F.lit(False)))


def psi_class(p) -> Column:
    """DRF-02: <0.1 none, <0.2 moderate, else significant."""
    p = F.col(p) if isinstance(p, str) else p
    e = None
    for bound, name in PSI_BANDS:
        e = F.when(p < bound, name) if e is None else e.when(p < bound, name)
    return e.otherwise(PSI_TOP)


def ks_pvalue(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample KS p-value Q(l), l = sqrt(nm/(n+m)) * D, in full double precision for every l.

    From 1 on the alternating series ``2 sum (-1)^(k-1) exp(-2 k^2 l^2)`` is exact after a few terms; below, its dual
    ``1 - sqrt(2 pi)/l * sum exp(-(2k-1)^2 pi^2 / (8 l^2))`` is. Below 0.05 the dual sum vanishes and Q is 1.
    """
    lam = F.sqrt(n * m / (n + m)) * d

    def total(term, terms):
        return F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0), lambda acc, k: acc + term(k.cast("double")))

    far = 2.0 * total(lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam), 6)
    near = 1.0 - F.lit(math.sqrt(2 * math.pi)) / lam * total(
        lambda k: F.exp(-(2 * k - 1) * (2 * k - 1) * F.lit(math.pi ** 2 / 8) / (lam * lam)), 4)
    p = F.when(lam < 0.05, F.lit(1.0)).when(lam < 1, near).otherwise(far)
    return F.when(lam.isNotNull(), F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))


def ks(reference: DataFrame, current: DataFrame) -> DataFrame:
    """DRF-03: KS statistic D = max |F_ref - F_cur| per feature (exact), plus sizes and p-value.

    A feature that one side lacks has no D and no p-value (null).
    """
    both = (reference.select("feature", "x", F.lit(1).alias("r"), F.lit(0).alias("c"))
            .unionByName(current.select("feature", "x", F.lit(0).alias("r"), F.lit(1).alias("c"))))
    g = both.groupBy("feature", "x").agg(F.sum("r").alias("nr"), F.sum("c").alias("nc"))
    cum = running_totals(g, ["x"], {"cr": F.col("nr"), "cc": F.col("nc")}, groups=["feature"], few_groups=True)
    # the totals are the last running totals, read from the same checkpoint: the samples are scanned once
    tot = cum.groupBy("feature").agg(F.max("cr").alias("n_ref"), F.max("cc").alias("n_cur"))
    j = cum.join(F.broadcast(tot), "feature")
    out = j.groupBy("feature", "n_ref", "n_cur").agg(
        F.max(F.abs(F.try_divide("cr", "n_ref") - F.try_divide("cc", "n_cur"))).alias("ks_d"))
    return out.withColumn("p_value", ks_pvalue(F.col("ks_d"), F.col("n_ref").cast("double"),
                                               F.col("n_cur").cast("double")))


def feature_flags(stats: DataFrame, p_threshold: float = 0.05) -> DataFrame:
    """DRF-04, per feature: drift detected when the p-value is below the threshold (not without a p-value)."""
    return stats.select("feature", "p_value", F.coalesce(F.col("p_value") < p_threshold, F.lit(False)).alias("drift_detected"))


def drift_flags(stats: DataFrame, p_threshold: float = 0.05, share_threshold: float = 0.5) -> DataFrame:
    """DRF-04, summary: features, drifted count and the dataset flag; always one row, also without features."""
    return feature_flags(stats, p_threshold).agg(F.count(F.lit(1)).alias("features"),
                                                 F.count_if("drift_detected").alias("drifted_count")).withColumn(
        "dataset_drift", F.coalesce(F.try_divide("drifted_count", "features") >= share_threshold, F.lit(False)))
