"""Sources and sinks: every query writes derived data to the shared folder and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.time import epoch_micros
from riskframe.plans.registry import register
from riskframe.session import scratch_path
from riskframe.sources import fixtures as X
from riskframe.sources import sinks as SK
from riskframe.sources.records import records_from_json, to_request_records, REQUEST_SCHEMA
from riskframe.sources.tables import TABLES, load, read_collection, read_csv_tables, table_row_counts

W = X.with_ctes


@register("src_01_csv_tables", """
SELECT o.o_orderkey, o.o_totalprice, epoch_us(o.o_orderdate) AS orderdate_us, c.c_name
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def src_01_csv_tables(spark, d):
    """Header CSV files with declared schemas (all required files must exist), then joined."""
    base = scratch_path(spark, "csv")
    frames = {"orders": load(spark, d, "orders"), "customer": load(spark, d, "customer")}
    paths = {}
    for name, df in frames.items():
        paths[name] = f"{base}/{name}"
        df.write.option("header", True).csv(paths[name])
    t = read_csv_tables(spark, paths, {n: df.schema for n, df in frames.items()})
    o, c = t["orders"], t["customer"]
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    return j.select("o_orderkey", "o_totalprice", epoch_micros(F.col("o_orderdate")).alias("orderdate_us"), "c_name")


@register("src_02_collection", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def src_02_collection(spark, d):
    """A stored collection: full scan, _id dropped, required key asserted (no implicit limit)."""
    path = scratch_path(spark, "collection")
    load(spark, d, "orders").withColumn("_id", F.col("o_orderkey").cast("string")).write.parquet(path)
    df = read_collection(spark, path, required=["o_orderkey"])
    return df.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


@register("src_03_reference_sample", W("train") + "SELECT TransactionID, TransactionAmt FROM train")
def src_03_reference_sample(spark, d):
    """Reference sample saved (overwrite, SNK-08) and read back; absent sample = drift disabled."""
    train, _ = X.train_test(spark, d)
    path = scratch_path(spark, "reference")
    assert SK.read_reference_sample(spark, path) is None
    SK.save_reference_sample(train.select("TransactionID", "TransactionAmt"), path)
    return SK.read_reference_sample(spark, path)


@register("snk_08_reference_overwrite", W("test") + "SELECT TransactionID, TransactionAmt FROM test")
def snk_08_reference_overwrite(spark, d):
    """Saving a new reference sample replaces the old one."""
    train, test = X.train_test(spark, d)
    path = scratch_path(spark, "reference")
    SK.save_reference_sample(train.select("TransactionID", "TransactionAmt"), path)
    SK.save_reference_sample(test.select("TransactionID", "TransactionAmt"), path)
    return SK.read_reference_sample(spark, path)


# a record of the prediction log: prediction, time, the features it was made from, and label fields that stay null until a label comes
_PRED_SQL = W("pred") + """
SELECT p.transaction_id, p.prediction, p.probability, epoch_us(p.pred_ts) AS pred_us, CAST(d.n_chars AS DOUBLE) AS n_chars,
       CAST(length(d.lang) AS DOUBLE) AS lang_length, CAST(2 AS BIGINT) AS n_features, CAST(NULL AS INTEGER) AS ground_truth, CAST(NULL AS BIGINT) AS label_us
FROM pred p JOIN documents d ON d.doc_id = p.transaction_id"""


def _records(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "n_chars", "lang")
    features = docs.select(F.col("doc_id").alias("transaction_id"), F.create_map(
        F.lit("n_chars"), F.col("n_chars").cast("double"), F.lit("lang_length"), F.length("lang").cast("double")).alias("features"))
    return SK.prediction_records(X.predictions_only(spark, d).join(features, "transaction_id"))


def _record_columns(back):
    return back.select("transaction_id", "prediction", "probability", epoch_micros(F.col("pred_ts")).alias("pred_us"),
                       F.col("features")["n_chars"].alias("n_chars"), F.col("features")["lang_length"].alias("lang_length"),
                       F.size("features").cast("bigint").alias("n_features"), "ground_truth", epoch_micros(F.col("label_ts")).alias("label_us"))


@register("src_05_json_log", _PRED_SQL)
def src_05_json_log(spark, d):
    """Prediction log as JSON lines, features map and label fields included, read back with the declared schema."""
    path = scratch_path(spark, "predlog-json")
    _records(spark, d).write.option("ignoreNullFields", "false").json(path)
    return _record_columns(SK.read_prediction_log(spark, path))


@register("snk_03_append_predictions", _PRED_SQL)
def snk_03_append_predictions(spark, d):
    """Prediction records appended in two batches (label fields null), read back whole."""
    p = _records(spark, d)
    path = scratch_path(spark, "predlog")
    SK.append(p.where(F.col("transaction_id") % 2 == 0), path)
    SK.append(p.where(F.col("transaction_id") % 2 == 1), path)
    return _record_columns(spark.read.parquet(path))


@register("src_06_records_json", W("tx") + """
SELECT CAST(TransactionAmt AS DOUBLE) AS TransactionAmt, CAST(card1 AS DOUBLE) AS card1, CAST(NULL AS DOUBLE) AS card2,
       CAST(NULL AS DOUBLE) AS card3, card4, CAST(NULL AS DOUBLE) AS card5, card6, CAST(addr1 AS DOUBLE) AS addr1,
       CAST(NULL AS DOUBLE) AS addr2, CAST(NULL AS VARCHAR) AS ProductCD, P_emaildomain, CAST(NULL AS VARCHAR) AS R_emaildomain
FROM tx""")
def src_06_records_json(spark, d):
    """JSON request bodies to typed 12-field records (the batch-scoring input)."""
    rec = to_request_records(X.transactions(spark, d))
    bodies = rec.select(F.to_json(F.struct(*[f.name for f in REQUEST_SCHEMA.fields])).alias("value"))
    return records_from_json(bodies)


@register("src_07_first_n_merge", """
SELECT o.o_orderkey, o.o_totalprice, c.c_nationkey
FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 50) o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def src_07_first_n_merge(spark, d):
    """First n rows (by key) of the transactions LEFT merged with identity (the limit is the feature)."""
    o = load(spark, d, "orders").orderBy("o_orderkey").limit(50)
    c = load(spark, d, "customer")
    return o.join(c, o.o_custkey == c.c_custkey, "left").select("o_orderkey", "o_totalprice", "c_nationkey")


@register("src_08_log_files", W("logs") + f"""
SELECT value, 'fraud-detection' AS job,
       CASE WHEN contains(value, ' - {X.SERVICES[0]} - ') THEN '{X.SERVICES[0]}' ELSE '{X.SERVICES[1]}' END AS service
FROM logs""")
def src_08_log_files(spark, d):
    """Service log files read as text with static labels (job) and the service taken from the file path."""
    lines = X.log_lines(spark, d)
    svc = F.regexp_extract("value", r" - (\w+) - [A-Z]+ - ", 1)
    path = scratch_path(spark, "logs")
    lines.select("value", svc.alias("service")).write.partitionBy("service").text(path)
    back = spark.read.text(path)
    from_path = F.regexp_extract(F.col("_metadata.file_path"), r"service=([^/]+)/", 1)
    return back.select("value", F.lit("fraud-detection").alias("job"), from_path.alias("service"))


@register("src_10_table_counts", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES))
def src_10_table_counts(spark, d):
    """Row count of every table after import."""
    return table_row_counts({t: load(spark, d, t) for t in TABLES})


@register("snk_01_overwrite", W("tx") + "SELECT TransactionID, TransactionAmt, card1 FROM tx")
def snk_01_overwrite(spark, d):
    """Drop-and-replace a collection: the second write replaces the first."""
    tx = X.transactions(spark, d).select("TransactionID", "TransactionAmt", "card1")
    path = scratch_path(spark, "collection")
    SK.overwrite(tx.limit(10), path)
    SK.overwrite(tx, path)
    return spark.read.parquet(path)


@register("snk_02_store_data", W("tx") + "SELECT count(*) AS stored_records FROM tx")
def snk_02_store_data(spark, d):
    """Overwrite the offline feature table and report the stored record count."""
    n = SK.store_data(X.transactions(spark, d), scratch_path(spark, "offline-store"))
    return spark.range(1).select(F.lit(n).cast("bigint").alias("stored_records"))


@register("snk_06_json_safe", """
SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS o_orderdate
FROM orders ORDER BY o_orderkey LIMIT 100""")
def snk_06_json_safe(spark, d):
    """JSON-safe records: NaN to null, timestamps to ISO text, first 100 rows by key."""
    o = load(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return SK.json_safe(o, order=["o_orderkey"], limit=100)


@register("snk_09_key_layout", W("tx") + "SELECT * FROM tx")
def snk_09_key_layout(spark, d):
    """Rows laid out by TransactionID (key ranges, Bloom filters, short pages) for key lookups; read back whole."""
    path = scratch_path(spark, "by-key")
    SK.write_key_layout(X.transactions(spark, d), path, "TransactionID")
    return spark.read.parquet(path)
