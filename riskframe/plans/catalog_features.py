"""Queries of the feature area: identity join, key statistics, encodings, vectors, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions import scalar as S
from riskframe.operators import keys as K
from riskframe.plans import features as FE
from riskframe.plans.registry import register
from riskframe.session import cut_lineage
from riskframe.sources import fixtures as X
from riskframe.sources.tables import load

W = X.with_ctes
CARDS = ["card1", "card4", "card6", "addr1"]          # card columns present in M1
COMBO_SQL = {
    "card1_addr1": "concat_ws('_', COALESCE(CAST(card1 AS VARCHAR), 'nan'), COALESCE(CAST(addr1 AS VARCHAR), 'nan'))",
    "card1_addr1_P_emaildomain": "concat_ws('_', COALESCE(CAST(card1 AS VARCHAR), 'nan'), "
                                 "COALESCE(CAST(addr1 AS VARCHAR), 'nan'), COALESCE(P_emaildomain, 'nan'))",
}
TX_COLS = ["TransactionID", "TransactionDT", "TransactionAmt", "card1", "card4", "card6", "addr1",
           "P_emaildomain", "C1", "D1", "D2", "isFraud", "is_train"]


def _long(src: str, cols, extra: str = "") -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS key{extra} FROM {src}" for c in cols)


def _combos(src: str) -> str:
    return f"SELECT *, {COMBO_SQL['card1_addr1']} AS card1_addr1, " \
           f"{COMBO_SQL['card1_addr1_P_emaildomain']} AS card1_addr1_P_emaildomain FROM {src}"


# ---------------------------------------------------------------- JON-01
@register("jon_01_identity_join", W("tx") + "SELECT * FROM tx")
def jon_01_identity_join(spark, d):
    """Transactions LEFT JOIN identity (orders LEFT JOIN customer)."""
    return X.transactions(spark, d)


# ---------------------------------------------------------------- AGG-01 .. AGG-07
@register("agg_01_frequency", W("train") + f"""
, long AS ({_long('train', CARDS)})
SELECT feature, key, count(*) AS count,
       round(count(*) / sum(count(*)) OVER (PARTITION BY feature), 6) AS share
FROM long WHERE key IS NOT NULL GROUP BY feature, key""")
def agg_01_frequency(spark, d):
    """Frequency encoding stats of the card / address keys fitted on train (count and share)."""
    train, _ = X.train_test(spark, d)
    st = K.key_stats(train, FE.CARD_COLS, measures=["count", "share"])
    return st.select("feature", "key", "count", F.round("share", 6).alias("share"))


@register("agg_02_frequency_combined", W("train") + f"""
, k AS ({_combos('train')})
, long AS (SELECT 'card1_addr1' AS feature, card1_addr1 AS key FROM k
           UNION ALL SELECT 'card1_addr1_P_emaildomain', card1_addr1_P_emaildomain FROM k)
SELECT feature, key, count(*) AS count FROM long GROUP BY feature, key""")
def agg_02_frequency_combined(spark, d):
    """Frequency of the combined keys on train."""
    train, _ = X.train_test(spark, d)
    return K.key_stats(FE.add_combined_keys(train), list(FE.COMBOS), measures=["count"])


@register("agg_03_group_count", W("train") + f"""
, long AS ({_long('train', CARDS, ', TransactionID')})
SELECT feature, key, count(TransactionID) AS id_count FROM long WHERE key IS NOT NULL GROUP BY feature, key""")
def agg_03_group_count(spark, d):
    """Group count of non-null transaction ids per key value."""
    train, _ = X.train_test(spark, d)
    return K.key_stats(train, FE.CARD_COLS, id_col="TransactionID", measures=["id_count"])


@register("agg_04_group_nunique", W("train") + f"""
, long AS ({_long('train', CARDS, ', TransactionAmt')})
SELECT feature, key, count(DISTINCT TransactionAmt) AS nunique FROM long WHERE key IS NOT NULL GROUP BY feature, key""")
def agg_04_group_nunique(spark, d):
    """Distinct amounts per key value."""
    train, _ = X.train_test(spark, d)
    return K.key_stats(train, FE.CARD_COLS, value_col="TransactionAmt", measures=["nunique"])


@register("agg_05_group_amount_stats", W("train") + f"""
, long AS ({_long('train', CARDS, ', CAST(TransactionAmt AS DECIMAL(18,2)) AS amt, TransactionAmt')})
SELECT feature, key, CAST(sum(amt) AS DOUBLE) AS sum,
       round(CAST(sum(amt) AS DOUBLE) / count(amt), 6) AS mean,
       round(stddev_samp(TransactionAmt), 6) AS std,
       min(TransactionAmt) AS min, max(TransactionAmt) AS max
FROM long WHERE key IS NOT NULL GROUP BY feature, key""")
def agg_05_group_amount_stats(spark, d):
    """Sum, mean, sample std, min, max of the amount per key value (money summed as decimal)."""
    train, _ = X.train_test(spark, d)
    tr = train.withColumn("amt", F.col("TransactionAmt").cast("decimal(18,2)"))
    long = K.unpivot_keys(tr, FE.CARD_COLS, ["amt", "TransactionAmt"])
    g = long.groupBy("feature", "key").agg(F.sum("amt").cast("double").alias("sum"),
                                           F.count("amt").alias("n"),
                                           F.stddev_samp("TransactionAmt").alias("std"),
                                           F.min("TransactionAmt").alias("min"),
                                           F.max("TransactionAmt").alias("max"))
    return g.select("feature", "key", "sum", F.round(F.col("sum") / F.col("n"), 6).alias("mean"),
                    F.round("std", 6).alias("std"), "min", "max")


@register("agg_06_mean_ratio", W("tx") + """
SELECT TransactionID, is_train,
       round(TransactionAmt / avg(TransactionAmt) OVER (PARTITION BY is_train), 6) AS TransactionAmt_to_mean
FROM tx""")
def agg_06_mean_ratio(spark, d):
    """Amount over the mean amount of its own split (one tiny aggregate, broadcast back)."""
    tx = X.transactions(spark, d)
    means = tx.groupBy("is_train").agg(F.avg("TransactionAmt").alias("mean"))
    return (tx.join(F.broadcast(means), "is_train")
            .select("TransactionID", "is_train",
                    F.round(S.ratio_to_mean("TransactionAmt", "mean", guard=False), 6).alias("TransactionAmt_to_mean")))


@register("agg_07_target_distribution", W("train") + "SELECT isFraud, count(*) AS n FROM train GROUP BY isFraud")
def agg_07_target_distribution(spark, d):
    """Target value counts of the training split."""
    train, _ = X.train_test(spark, d)
    return train.groupBy("isFraud").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- JON-02
_LOOKUP_JOINS = "\n".join(
    f"LEFT JOIN (SELECT CAST({c} AS VARCHAR) AS key, count(*) AS n FROM train WHERE {c} IS NOT NULL GROUP BY 1) s_{c} "
    f"ON CAST(test.{c} AS VARCHAR) = s_{c}.key" for c in CARDS)


@register("jon_02_lookup", W("train", "test") + f"""
SELECT test.TransactionID, {', '.join(f's_{c}.n AS {c}_freq' for c in CARDS)}
FROM test {_LOOKUP_JOINS}""")
def jon_02_lookup(spark, d):
    """Test rows mapped through train frequencies; unseen and null keys give null."""
    train, test = X.train_test(spark, d)
    st = K.key_stats(train, CARDS, measures=["count"])
    sizes = K.stats_sizes(st)
    out = K.apply_stats(test, st, CARDS, {"count": "freq"}, sizes=sizes)
    return out.select("TransactionID", *[f"{c}_freq" for c in CARDS])


# ---------------------------------------------------------------- FUN-06 / FUN-08
@register("fun_06_label_encoding", W("tx") + f"""
, k AS ({_combos('tx')})
, dom AS (SELECT DISTINCT 'card1_addr1' AS feature, card1_addr1 AS key FROM k
          UNION SELECT DISTINCT 'card1_addr1_P_emaildomain', card1_addr1_P_emaildomain FROM k)
SELECT feature, key, dense_rank() OVER (PARTITION BY feature ORDER BY key) - 1 AS code FROM dom""")
def fun_06_label_encoding(spark, d):
    """Dense 0-based codes of the combined keys over train + test, binary string order (H1, no single task)."""
    train, test = X.train_test(spark, d)
    fitted = FE.FraudFeatures(checkpoint=False).fit(train, test)
    return fitted.codes.select("feature", "key", "code")


@register("fun_08_category_codes", W("tx") + """
, dom AS (SELECT DISTINCT P_emaildomain AS key FROM tx WHERE P_emaildomain IS NOT NULL)
, codes AS (SELECT key, dense_rank() OVER (ORDER BY key) - 1 AS code FROM dom)
SELECT tx.TransactionID, COALESCE(codes.code, -1) AS P_emaildomain_code
FROM tx LEFT JOIN codes ON tx.P_emaildomain = codes.key""")
def fun_08_category_codes(spark, d):
    """Category codes of a text column; missing = -1."""
    tx = X.transactions(spark, d)
    codes = cut_lineage(K.dense_codes(tx, "P_emaildomain"))
    out = K.lookup(tx, codes, F.col("P_emaildomain"), "P_emaildomain", {"code": "P_emaildomain_code"},
                   rows=codes.count(), fill=-1)
    return out.select("TransactionID", F.col("P_emaildomain_code").cast("bigint").alias("P_emaildomain_code"))


# ---------------------------------------------------------------- flagship: fitted batch features
def _batch_sql() -> str:
    stats = []
    sel = []
    joins = []
    for c in CARDS:
        stats.append(f"s_{c} AS (SELECT CAST({c} AS VARCHAR) AS key, count(*) AS freq, count(TransactionID) AS cnt, "
                     f"count(DISTINCT TransactionAmt) AS nun FROM trk WHERE {c} IS NOT NULL GROUP BY 1)")
        sel.append(f"s_{c}.freq AS {c}_freq, s_{c}.cnt AS {c}_count, s_{c}.nun AS {c}_nunique")
        joins.append(f"LEFT JOIN s_{c} ON CAST(k.{c} AS VARCHAR) = s_{c}.key")
    for i, c in enumerate(FE.COMBOS):
        stats.append(f"f_{i} AS (SELECT {c} AS key, count(*) AS freq FROM trk GROUP BY 1)")
        stats.append(f"e_{i} AS (SELECT key, dense_rank() OVER (ORDER BY key) - 1 AS code "
                     f"FROM (SELECT DISTINCT {c} AS key FROM k))")
        sel.append(f"e_{i}.code AS {c}_encoded, f_{i}.freq AS {c}_freq")
        joins.append(f"LEFT JOIN e_{i} ON k.{c} = e_{i}.key LEFT JOIN f_{i} ON k.{c} = f_{i}.key")
    return W("train", "test") + f"""
, tt AS (SELECT *, 'train' AS split FROM train UNION ALL BY NAME SELECT *, 'test' AS split FROM test)
, k AS ({_combos('tt')})
, trk AS (SELECT * FROM k WHERE split = 'train')
, m AS (SELECT split, avg(TransactionAmt) AS mean FROM k GROUP BY split)
, {', '.join(stats)}
SELECT k.TransactionID, k.TransactionAmt, k.card1, k.card4, k.card6, k.addr1, k.P_emaildomain, k.C1, k.isFraud,
       k.card1_addr1, k.card1_addr1_P_emaildomain, {', '.join(sel)},
       round(k.TransactionAmt / m.mean, 6) AS TransactionAmt_to_mean,
       round(k.TransactionAmt - trunc(k.TransactionAmt), 6) AS TransactionCents, k.split
FROM k JOIN m ON k.split = m.split
{' '.join(joins)}"""


def batch_features(spark, d):
    # the identity join runs once, into a written table; both splits are fitted and transformed from it
    tx = cut_lineage(X.transactions(spark, d).where("is_train IS NOT NULL"))
    fitted = FE.FraudFeatures().fit(tx.where("is_train"), tx.where("NOT is_train"))
    tx = tx.withColumns({"split": F.when(F.col("is_train"), "train").otherwise("test"),
                         "isFraud": F.when(F.col("is_train"), F.col("isFraud"))}).drop("is_train")
    out = fitted.transform(tx, mean_by="split")
    return out.withColumns({"TransactionAmt_to_mean": F.round("TransactionAmt_to_mean", 6),
                            "TransactionCents": F.round("TransactionCents", 6)})


register("plan_batch_features", _batch_sql())(batch_features)


# ---------------------------------------------------------------- FUN-09 / PRJ-02
def _row_vector_sql() -> str:
    maps = S.CATEGORY_MAPS
    have = {"TransactionID", "TransactionAmt", "card1", "card4", "card6", "addr1", "P_emaildomain", "C1"}
    out = []
    for n in FE.EXPECTED_FEATURES:
        base = n.rsplit("_", 1)[0]
        if n.endswith(("_freq", "_count", "_nunique")) and base in FE.CARD_COLS:
            if base in maps:
                e = "1.0"
            elif base in have:
                e = f"CASE WHEN {base} IS NOT NULL THEN 1.0 ELSE 0.0 END"
            else:
                e = "0.0"
        elif n.endswith("_encoded"):
            e = "0.0"
        elif n in ("card1_addr1_freq", "card1_addr1_P_emaildomain_freq"):
            e = "1.0"
        elif n == "TransactionAmt_to_mean":
            e = "CASE WHEN TransactionAmt > 0 THEN 1.0 ELSE 0.0 END"
        elif n == "TransactionCents":
            e = "round(COALESCE((TransactionAmt - trunc(TransactionAmt)) * 100.0, 0.0), 6)"
        elif n in maps and n in have:
            cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in maps[n].items())
            e = f"CAST(CASE {n} {cases} ELSE -1 END AS DOUBLE)"
        elif n in have:
            e = f"COALESCE(CAST({n} AS DOUBLE), 0.0)"
        else:
            e = "0.0"
        out.append(f"CAST({e} AS DOUBLE) AS {n}")
    return W("tx") + "SELECT " + ",\n  ".join(out) + " FROM tx"


@register("fun_09_row_vector", _row_vector_sql())
def fun_09_row_vector(spark, d):
    """Service vector of 123 doubles for every transaction, each row on its own (no shuffle)."""
    v = FE.row_vector(X.transactions(spark, d))
    return v.withColumn("TransactionCents", F.round("TransactionCents", 6))


def _align_sql() -> str:
    have = ["TransactionID", "TransactionAmt", "card1", "C1"] + \
        [f"{c}_{m}" for c in CARDS for m in ("freq", "count", "nunique")] + \
        ["card1_addr1_encoded", "card1_addr1_P_emaildomain_encoded", "TransactionAmt_to_mean",
         "TransactionCents", "card1_addr1_freq", "card1_addr1_P_emaildomain_freq"]
    cols = [f"CAST(COALESCE({n}, 0) AS DOUBLE) AS {n}" if n in have else f"CAST(0.0 AS DOUBLE) AS {n}"
            for n in FE.EXPECTED_FEATURES]
    return "WITH bf AS (" + _batch_sql() + ")\nSELECT " + ", ".join(cols) + " FROM bf WHERE split = 'test'"


@register("prj_02_align", _align_sql())
def prj_02_align(spark, d):
    """Fitted test features aligned to the 123-name vector: missing = 0, exact order, nulls = 0."""
    bf = batch_features(spark, d).where(F.col("split") == "test")
    bf = bf.select(*[F.col(c).cast("double").alias(c) if c in FE.EXPECTED_FEATURES else F.col(c)
                     for c in bf.columns])
    return FE.align(bf, FE.EXPECTED_FEATURES, 0.0)


# ---------------------------------------------------------------- FUN-01 .. FUN-08 scalar
@register("fun_01_to_number", """
SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority_num,
       TRY_CAST(o_orderpriority AS DOUBLE) AS priority_raw FROM orders""")
def fun_01_to_number(spark, d):
    """Coerce text to a number; failures become null."""
    o = load(spark, d, "orders")
    return o.select("o_orderkey", S.to_number(F.substring("o_orderpriority", 1, 1)).alias("priority_num"),
                    S.to_number("o_orderpriority").alias("priority_raw"))


@register("fun_02_d_delta", W("tx") + """
SELECT TransactionID,
       CASE WHEN D1 IS NOT NULL AND TransactionDT IS NOT NULL THEN D1 - TransactionDT ELSE D1 END AS D1,
       CASE WHEN D2 IS NOT NULL AND TransactionDT IS NOT NULL THEN round(D2 - TransactionDT, 6) ELSE D2 END AS D2
FROM tx""")
def fun_02_d_delta(spark, d):
    """D columns minus the transaction time where both are present."""
    tx = FE.normalize_d_columns(X.transactions(spark, d))
    return tx.select("TransactionID", "D1", F.round("D2", 6).alias("D2"))


@register("fun_03_cents", W("tx") + """
SELECT TransactionID, round(TransactionAmt - trunc(TransactionAmt), 6) AS cents,
       round((TransactionAmt - trunc(TransactionAmt)) * 100, 6) AS cents_x100 FROM tx""")
def fun_03_cents(spark, d):
    """Fractional part of the amount (batch) and the same x100 (service)."""
    tx = X.transactions(spark, d)
    return tx.select("TransactionID", F.round(S.cents("TransactionAmt"), 6).alias("cents"),
                     F.round(S.cents("TransactionAmt", 100), 6).alias("cents_x100"))


@register("fun_04_ratio_to_mean", W("tx") + """
, m AS (SELECT avg(TransactionAmt) AS mean FROM tx)
SELECT TransactionID, round(CASE WHEN m.mean > 0 THEN TransactionAmt / m.mean ELSE 0 END, 6) AS ratio
FROM tx, m""")
def fun_04_ratio_to_mean(spark, d):
    """Guarded ratio to the mean amount (0 when the mean is not positive)."""
    tx = X.transactions(spark, d)
    mean = tx.agg(F.avg("TransactionAmt")).scalar()       # scalar subquery, evaluated once
    return tx.select("TransactionID", F.round(S.ratio_to_mean("TransactionAmt", mean), 6).alias("ratio"))


@register("fun_05_combined_keys", W("tx") + f"""
SELECT TransactionID, {COMBO_SQL['card1_addr1']} AS card1_addr1,
       {COMBO_SQL['card1_addr1_P_emaildomain']} AS card1_addr1_P_emaildomain,
       concat_ws('_', COALESCE(CAST(card1 AS VARCHAR), '0'), COALESCE(CAST(addr1 AS VARCHAR), '0'),
                 COALESCE(P_emaildomain, 'unknown')) AS service_key
FROM tx""")
def fun_05_combined_keys(spark, d):
    """Combined keys with the batch token (nan) and the service tokens (0 / unknown)."""
    tx = FE.add_combined_keys(X.transactions(spark, d))
    svc = S.combine_keys(["card1", "addr1", "P_emaildomain"],
                         {"card1": "0", "addr1": "0", "P_emaildomain": "unknown"})
    return tx.select("TransactionID", "card1_addr1", "card1_addr1_P_emaildomain", svc.alias("service_key"))


_BRAND = ("visa", "mastercard", "discover", "american express", "amex")


@register("fun_07_category_map", f"""
, b AS (SELECT o_orderkey,
        CASE o_custkey % 5 WHEN 0 THEN '{_BRAND[0]}' WHEN 1 THEN '{_BRAND[1]}' WHEN 2 THEN '{_BRAND[2]}'
             WHEN 3 THEN '{_BRAND[3]}' ELSE '{_BRAND[4]}' END AS card4,
        CASE o_orderstatus WHEN 'F' THEN 'credit' WHEN 'O' THEN 'debit' END AS card6,
        substr('WCRHSX', CAST(o_orderkey % 6 AS INTEGER) + 1, 1) AS ProductCD FROM orders)
SELECT o_orderkey,
  CASE card4 WHEN 'visa' THEN 0 WHEN 'mastercard' THEN 1 WHEN 'discover' THEN 2 WHEN 'american express' THEN 3 ELSE -1 END AS card4_code,
  CASE card6 WHEN 'credit' THEN 0 WHEN 'debit' THEN 1 ELSE -1 END AS card6_code,
  CASE ProductCD WHEN 'W' THEN 0 WHEN 'C' THEN 1 WHEN 'R' THEN 2 WHEN 'H' THEN 3 WHEN 'S' THEN 4 ELSE -1 END AS ProductCD_code
FROM b""".replace(", b AS", "WITH b AS", 1))
def fun_07_category_map(spark, d):
    """Fixed category maps (unknown and null = -1) over brand / kind / product columns derived from orders."""
    o = load(spark, d, "orders")
    b = o.select(
        "o_orderkey",
        F.element_at(F.array(*[F.lit(x) for x in _BRAND]), (F.col("o_custkey") % 5 + 1).cast("int")).alias("card4"),
        F.when(F.col("o_orderstatus") == "F", "credit").when(F.col("o_orderstatus") == "O", "debit").alias("card6"),
        F.substring(F.lit("WCRHSX"), (F.col("o_orderkey") % 6 + 1).cast("int"), 1).alias("ProductCD"))
    return b.select("o_orderkey", *[S.category_code(c, S.CATEGORY_MAPS[c]).alias(f"{c}_code")
                                    for c in ("card4", "card6", "ProductCD")])


# ---------------------------------------------------------------- PRJ-01, 03 .. 08
@register("prj_01_drop_columns", W("tx") + "SELECT * EXCLUDE (D1, D2, TransactionDT) FROM tx")
def prj_01_drop_columns(spark, d):
    """Drop D1..D15 and TransactionDT (absent names ignored)."""
    return FE.drop_columns(X.transactions(spark, d))


def numeric_common(train, test, target="isFraud", keep_id=False, id_col="TransactionID"):
    """PRJ-03: numeric columns present in both frames, in train order, minus target (and id)."""
    from pyspark.sql.types import NumericType
    test_cols = set(test.columns)
    cols = [f.name for f in train.schema.fields
            if isinstance(f.dataType, NumericType) and f.name in test_cols and f.name != target
            and (keep_id or f.name != id_col)]
    return cols


_NUM = ["TransactionDT", "TransactionAmt", "card1", "addr1", "C1", "D1", "D2"]


@register("prj_03_numeric_common", W("train") + f"SELECT {', '.join(_NUM)} FROM train")
def prj_03_numeric_common(spark, d):
    """Model matrix columns: numeric, common to train and test, target and id excluded."""
    train, test = X.train_test(spark, d)
    return train.select(*numeric_common(train, test))


@register("prj_04_fill_zero", W("train") + "SELECT " + ", ".join(f"COALESCE({c}, 0) AS {c}" for c in _NUM)
          + " FROM train")
def prj_04_fill_zero(spark, d):
    """Nulls in the model matrix filled with 0."""
    train, test = X.train_test(spark, d)
    return train.select(*numeric_common(train, test)).na.fill(0)


@register("prj_05_synth_id", W("tx") + """
SELECT TransactionID AS source_id,
       row_number() OVER (ORDER BY CASE WHEN is_train THEN 0 ELSE 1 END, TransactionID) AS TransactionID
FROM tx""")
def prj_05_synth_id(spark, d):
    """Ids 1..n over train then test (two-phase global row index, no single-partition window)."""
    tx = X.transactions(spark, d).select(F.col("TransactionID").alias("source_id"),
                                         F.when(F.col("is_train"), 0).otherwise(1).alias("split_rank"))
    return K.row_index(tx, ["split_rank", "source_id"], name="TransactionID").drop("split_rank")


@register("prj_06_synth_time", W("tx") + """
SELECT TransactionID,
       strftime(TIMESTAMP '2024-01-01' + to_seconds(row_number() OVER (ORDER BY TransactionID) - 1),
                '%Y-%m-%d %H:%M:%S') AS event_timestamp
FROM tx""")
def prj_06_synth_time(spark, d):
    """event_timestamp = base + i seconds in id order (base is an argument)."""
    tx = X.transactions(spark, d).select("TransactionID")
    idx = K.row_index(tx, ["TransactionID"], name="i", start=0)
    ts = F.timestamp_add("SECOND", F.col("i"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return idx.select("TransactionID", F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("event_timestamp"))


@register("prj_07_request_record", W("tx") + """
SELECT CAST(TransactionAmt AS DOUBLE) AS TransactionAmt, TRY_CAST(card1 AS DOUBLE) AS card1,
       CAST(NULL AS DOUBLE) AS card2, CAST(NULL AS DOUBLE) AS card3, CAST(card4 AS VARCHAR) AS card4,
       CAST(NULL AS DOUBLE) AS card5, CAST(card6 AS VARCHAR) AS card6, TRY_CAST(addr1 AS DOUBLE) AS addr1,
       CAST(NULL AS DOUBLE) AS addr2, CAST(NULL AS VARCHAR) AS ProductCD,
       CAST(P_emaildomain AS VARCHAR) AS P_emaildomain, CAST(NULL AS VARCHAR) AS R_emaildomain
FROM tx""")
def prj_07_request_record(spark, d):
    """The 12-field typed request record (nullable doubles and strings) from a transaction row."""
    from riskframe.sources.records import to_request_records
    return to_request_records(X.transactions(spark, d))


@register("prj_08_text_to_number", """
SELECT o_orderkey, COALESCE(TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE), 0) AS priority,
       COALESCE(TRY_CAST(o_orderstatus AS DOUBLE), 0) AS status FROM orders""")
def prj_08_text_to_number(spark, d):
    """Text columns to numbers for direct scoring; failures become 0."""
    o = load(spark, d, "orders")
    return o.select("o_orderkey",
                    S.to_number_or_zero(F.substring("o_orderpriority", 1, 1)).alias("priority"),
                    S.to_number_or_zero("o_orderstatus").alias("status"))


# ---------------------------------------------------------------- SET-01 .. SET-03
@register("set_01_concat", W("train", "test") + "SELECT * FROM train UNION ALL BY NAME SELECT * FROM test")
def set_01_concat(spark, d):
    """Train and test stacked by name; the target is null for test rows."""
    train, test = X.train_test(spark, d)
    return train.unionByName(test, allowMissingColumns=True)


@register("set_02_key_domain", W("train", "test") + f"""
SELECT DISTINCT {COMBO_SQL['card1_addr1']} AS card1_addr1 FROM train
UNION SELECT DISTINCT {COMBO_SQL['card1_addr1']} FROM test""")
def set_02_key_domain(spark, d):
    """Distinct combined-key values over train and test (the encoder's domain)."""
    train, test = X.train_test(spark, d)
    a = FE.add_combined_keys(train).select("card1_addr1")
    b = FE.add_combined_keys(test).select("card1_addr1")
    return a.union(b).distinct()


@register("set_03_column_intersection", W("train") + """
SELECT TransactionID, TransactionDT, TransactionAmt, card1, card4, card6, addr1, P_emaildomain, C1, D1, D2 FROM train""")
def set_03_column_intersection(spark, d):
    """Train projected onto the columns it shares with test (train order)."""
    train, test = X.train_test(spark, d)
    common = [c for c in train.columns if c in set(test.columns)]
    return train.select(*common)


# ---------------------------------------------------------------- AGG-12, AGG-13, TOP-05
def _missing_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, count_if({c} IS NULL) AS missing FROM tx" for c in TX_COLS]
    return W("tx") + f", m AS ({' UNION ALL '.join(parts)})\n" \
        "SELECT column_name, missing FROM m WHERE missing > 0 UNION ALL SELECT '*', CAST(sum(missing) AS BIGINT) FROM m"


@register("agg_12_missing_counts", _missing_sql())
def agg_12_missing_counts(spark, d):
    """Missing values per column (> 0 only) and in total."""
    from riskframe.operators.profile import missing_counts
    return missing_counts(X.transactions(spark, d))


_PROFILE_COLS = ["TransactionID", "TransactionDT", "TransactionAmt", "card1", "addr1", "C1", "D1", "D2", "isFraud"]


@register("agg_13_shape", """
SELECT count(*) AS n_rows, min(epoch_us(ts)) AS first_us, max(epoch_us(ts)) AS last_us,
       (SELECT count(*) FROM (DESCRIBE events)) AS n_columns,
       'event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string' AS columns FROM events""")
def agg_13_shape(spark, d):
    """Row and column counts, column types and time range of the event table."""
    from riskframe.operators.profile import shape
    return shape(X.load(spark, d, "events"), "ts")


@register("agg_13_profile", W("tx") + "\nUNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, {S.round_sig_sql(f'avg({c})')} AS mean,
       {S.round_sig_sql(f'stddev_samp({c})')} AS std,
       CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.75), 6) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM tx""" for c in _PROFILE_COLS))
def agg_13_profile(spark, d):
    """Describe: count, mean, std, min, exact quartiles, max for every numeric column."""
    from riskframe.operators.profile import describe
    p = describe(X.transactions(spark, d))
    p = p.withColumns({c: F.round(c, 6) for c in ("p25", "p50", "p75")})
    return p.withColumns({c: S.round_sig(c) for c in ("mean", "std")})


@register("top_05_first_per_class", W("tx") + """
SELECT TransactionID, isFraud FROM (SELECT *, row_number() OVER (PARTITION BY isFraud ORDER BY TransactionID) AS r FROM tx)
WHERE r <= 5""")
def top_05_first_per_class(spark, d):
    """Five example rows per class (lowest ids), ranked in salted sub-groups first (skew-safe)."""
    from riskframe.operators.profile import top_k_per_group
    tx = X.transactions(spark, d).select("TransactionID", "isFraud")
    return top_k_per_group(tx, ["isFraud"], [F.col("TransactionID")], 5, salt_of=F.col("TransactionID"))


@register("top_05_first_rows", W("tx") + "SELECT TransactionID, TransactionAmt FROM tx ORDER BY TransactionID LIMIT 100")
def top_05_first_rows(spark, d):
    """First 100 rows by id (the rows published to the store)."""
    return X.transactions(spark, d).select("TransactionID", "TransactionAmt").orderBy("TransactionID").limit(100)


@register("fun_18_iso_text", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS o_orderdate FROM orders")
def fun_18_iso_text(spark, d):
    """Timestamps to ISO-8601 text."""
    from riskframe.functions.time import iso_text
    o = load(spark, d, "orders")
    return o.select("o_orderkey", iso_text(F.col("o_orderdate")).alias("o_orderdate"))
