"""Feature engineering: fitted statistics and the two scoring modes.

``FraudFeatures(...).fit(train, test)`` computes every fitted table with two
aggregates in total (H2: all key columns x all measures in one unpivoted
group-by, plus the label-code domain), checkpoints them into the shared
folder, and returns a ``FittedFeatures`` whose ``transform(df)`` is one lazy
plan of column expressions and lookups (broadcast when the counted table is
small, shuffle join otherwise).

``row_vector(df)`` is the service's per-request vector (section 0.1, Q4):
each row is treated on its own, so shares are 1 or 0, codes 0, ratios 1;
closed-form column expressions, no shuffle, works on streams.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions import scalar as S
from riskframe.operators import keys as K
from riskframe.session import cut_lineage

# ---- fixed values that must equal the reference's ---------------------------------
CARD_COLS = ["card1", "card2", "card3", "card4", "card5", "card6", "addr1", "addr2"]
D_COLS = [f"D{i}" for i in range(1, 16)]
COMBOS = {"card1_addr1": ["card1", "addr1"],
          "card1_addr1_P_emaildomain": ["card1", "addr1", "P_emaildomain"]}
V_COLS = [f"V{i}" for i in range(95, 138)] + [f"V{i}" for i in (
    279, 280, 284, 285, 286, 287, 290, 291, 292, 293, 294, 295, 297, 298, 299, 302,
    303, 304, 305, 306, 307, 308, 309, 310, 311, 312, 316, 317, 318, 319, 320, 321)]
C_COLS = [f"C{i}" for i in range(1, 15)]
# The 123 names of the scoring vector, in the service's order.
EXPECTED_FEATURES = (
    ["TransactionID", "TransactionAmt", "card1", "card3"] + C_COLS + V_COLS
    + [f"{c}_freq" for c in CARD_COLS]
    + ["card1_addr1_encoded", "card1_addr1_P_emaildomain_encoded"]
    + [f"{c}_count" for c in CARD_COLS]
    + [f"{c}_nunique" for c in CARD_COLS]
    + ["TransactionAmt_to_mean", "TransactionCents", "card1_addr1_freq", "card1_addr1_P_emaildomain_freq"]
)
EMAIL_COLS = ["P_emaildomain", "R_emaildomain"]
# ---------------------------------------------------------------------------------------


def normalize_d_columns(df: DataFrame, dt: str = "TransactionDT") -> DataFrame:
    """FUN-01 + FUN-02: coerce D1..D15 and the time to numbers, then ``D - DT`` where both exist."""
    present = [c for c in D_COLS if c in df.columns]
    if dt not in df.columns or not present:
        return df
    out = df.withColumn(dt, S.to_number(F.col(dt)))
    return out.withColumns({c: S.d_delta(S.to_number(F.col(c)), F.col(dt)) for c in present})


def drop_columns(df: DataFrame, names=None) -> DataFrame:
    """PRJ-01: drop D1..D15 and TransactionDT (absent names ignored)."""
    return df.drop(*(names or D_COLS + ["TransactionDT"]))


def add_combined_keys(df: DataFrame, token: str = "nan") -> DataFrame:
    """FUN-05: combined keys, built only when every part exists (Q18)."""
    for name, parts in COMBOS.items():
        if all(p in df.columns for p in parts):
            df = df.withColumn(name, S.combine_keys(parts, token))
    return df


@dataclass
class FittedFeatures:
    stats: DataFrame                     # feature, key, count, id_count, nunique (train)
    sizes: dict[str, int]
    codes: DataFrame                     # feature, key, code (train + test domain)
    code_sizes: dict[str, int]
    card_cols: list[str]
    combo_cols: list[str]
    normalize: bool
    id_col: str
    amount_col: str
    cents_scale: int
    drop_final: bool = True
    fill: float | None = None

    def transform(self, df: DataFrame, mean_by: str | None = None) -> DataFrame:
        """Apply the fitted tables to ``df`` (a lazy plan; no action runs).

        ``mean_by`` names a column of few values (train, test): the mean amount
        is then that of each value's rows, so several splits take one pass.
        """
        amt = self.amount_col
        if amt in df.columns:
            # AGG-06: mean of the frame being transformed (per split): a scalar
            # subquery over the pruned amount column, evaluated once
            if mean_by is None:
                mean = df.agg(F.avg(amt)).scalar()
            else:
                means = df.groupBy(F.col(mean_by).alias("__split")).agg(F.avg(amt).alias("__mean"))   # one row per split
                df, mean = df.join(F.broadcast(means), F.col(mean_by) == F.col("__split"), "left"), F.col("__mean")
            df = df.withColumn(f"{amt}_to_mean", S.ratio_to_mean(amt, mean, guard=False)) \
                   .withColumn("TransactionCents", S.cents(amt, self.cents_scale)).drop("__split", "__mean")
        df = normalize_d_columns(df)
        df = add_combined_keys(df)
        freq_name = "share" if self.normalize else "count"
        card = [c for c in self.card_cols if c in df.columns]
        per_col = []
        for c in card:
            per_col.append((c, {freq_name: "freq", "id_count": "count", "nunique": "nunique"}))
        for c, m in per_col:
            st = self.stats.where(F.col("feature") == c)
            df = K.lookup(df, st, F.col(c).cast("string"), "key",
                          {src: f"{c}_{suffix}" for src, suffix in m.items()},
                          rows=self.sizes.get(c), fill=self.fill)
        for c in self.combo_cols:
            if c not in df.columns:
                continue
            cd = self.codes.where(F.col("feature") == c).select("key", "code")
            st = self.stats.where(F.col("feature") == c).select("key", freq_name)
            if K.broadcastable(self.code_sizes.get(c)) and K.broadcastable(self.sizes.get(c)):
                # both tables broadcast: two map-side lookups, no shuffle of the large frame
                df = K.lookup(df, cd, F.col(c), "key", {"code": f"{c}_encoded"}, rows=self.code_sizes.get(c))
                df = K.lookup(df, st, F.col(c), "key", {freq_name: f"{c}_freq"}, rows=self.sizes.get(c))
            else:
                # beyond the bound: join the two small tables first, so the large frame is
                # shuffled once for this key instead of twice
                df = K.lookup(df, cd.join(st, "key", "left"), F.col(c), "key",
                              {"code": f"{c}_encoded", freq_name: f"{c}_freq"}, rows=self.code_sizes.get(c))
            if self.fill is not None:
                df = df.fillna({f"{c}_freq": self.fill})
        if self.drop_final:
            df = drop_columns(df)
        return df


@dataclass
class FraudFeatures:
    """Batch feature spec; defaults follow the batch job (raw counts, text ``nan`` keys)."""
    card_cols: list[str] = field(default_factory=lambda: list(CARD_COLS))
    normalize: bool = False
    id_col: str = "TransactionID"
    amount_col: str = "TransactionAmt"
    cents_scale: int = 1
    fill: float | None = None
    checkpoint: bool = True

    def fit(self, train: DataFrame, test: DataFrame | None = None) -> FittedFeatures:
        tr = add_combined_keys(train)
        card = [c for c in self.card_cols if c in tr.columns]
        combos = [c for c in COMBOS if c in tr.columns]
        measures = ["count", "id_count", "nunique"] + (["share"] if self.normalize else [])
        # one aggregate: card columns get all measures, combo columns their counts
        stats = K.key_stats(tr, card + combos, id_col=self.id_col, value_col=self.amount_col, measures=measures)
        if not combos:
            empty = tr.sparkSession.createDataFrame([], "feature string, key string, code bigint")
            if self.checkpoint:
                stats = cut_lineage(stats)
            return FittedFeatures(stats=stats, sizes=K.stats_sizes(stats), codes=empty, code_sizes={},
                                  card_cols=card, combo_cols=[], normalize=self.normalize, id_col=self.id_col,
                                  amount_col=self.amount_col, cents_scale=self.cents_scale, fill=self.fill)
        dom = tr.select(*combos)
        if test is not None:
            te = add_combined_keys(test)
            dom = dom.unionByName(te.select(*combos))
        long = K.unpivot_keys(dom, combos)
        codes = K.running_totals(long.select("feature", "key").distinct(), ["key"],
                                 {"code": F.lit(1).cast("bigint")}, groups=["feature"], few_groups=True)
        codes = codes.withColumn("code", F.col("code") - 1)
        if self.checkpoint:
            stats = cut_lineage(stats)
            codes = cut_lineage(codes)
        return FittedFeatures(stats=stats, sizes=K.stats_sizes(stats), codes=codes,
                              code_sizes=K.stats_sizes(codes), card_cols=card, combo_cols=combos,
                              normalize=self.normalize, id_col=self.id_col, amount_col=self.amount_col,
                              cents_scale=self.cents_scale, fill=self.fill)


def row_vector(df: DataFrame, amount: str = "TransactionAmt", carry=()) -> DataFrame:
    """FUN-09 + PRJ-02: the 123-column service vector, each row on its own.

    Rules (one-row frame semantics): text categories go through the fixed maps
    (-1 otherwise), so ``card4``/``card6`` always count as present; a numeric key
    counts 1 when present else 0 (share, count and nunique alike); combined
    keys always exist, so their code is 0 and share 1; amount / mean is 1 for a
    positive amount else 0; cents are x100; absent columns and nulls are 0.
    ``carry`` names columns kept beside the vector (no feature has such a name then).
    """
    cols = set(df.columns)

    def present(c: str):
        if c in S.CATEGORY_MAPS:
            return F.lit(1.0)  # mapped to a code (-1 at worst), never missing
        if c not in cols:
            return F.lit(0.0)
        return F.when(F.col(c).isNotNull(), 1.0).otherwise(0.0)

    def value(c: str):
        if c in S.CATEGORY_MAPS and c in cols:
            return S.category_code(c, S.CATEGORY_MAPS[c]).cast("double")
        return F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in cols else F.lit(0.0)

    a = F.col(amount).cast("double")
    exprs = {}
    for name in EXPECTED_FEATURES:
        if name.endswith(("_freq", "_count", "_nunique")) and name.rsplit("_", 1)[0] in CARD_COLS:
            exprs[name] = present(name.rsplit("_", 1)[0])
        elif name in ("card1_addr1_encoded", "card1_addr1_P_emaildomain_encoded"):
            exprs[name] = F.lit(0.0)
        elif name in ("card1_addr1_freq", "card1_addr1_P_emaildomain_freq"):
            exprs[name] = F.lit(1.0)
        elif name == "TransactionAmt_to_mean":
            exprs[name] = F.when(a > 0, 1.0).otherwise(0.0)
        elif name == "TransactionCents":
            exprs[name] = F.coalesce(S.cents(a, 100), F.lit(0.0))
        else:
            exprs[name] = value(name)
    return df.select(*carry, *[e.alias(n) for n, e in exprs.items() if n not in carry])


def align(df: DataFrame, expected: list[str], fill: float = 0.0) -> DataFrame:
    """PRJ-02: exact column list and order; missing columns and nulls become ``fill``."""
    have = set(df.columns)
    return df.select(*[(F.coalesce(F.col(c), F.lit(fill)) if c in have else F.lit(fill)).alias(c)
                       for c in expected])
