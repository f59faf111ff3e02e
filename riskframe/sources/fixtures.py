"""Role mappings: the reference's data roles laid over the driver's tables.

Each builder returns a lazy DataFrame; ``SQL`` holds the DuckDB twin of every
builder as a named CTE so the oracle queries start from the same rows.
Mapping (fixed choices, documented in FIXTURES.md section 2):

* M1 transactions  = orders LEFT JOIN customer (card1 = customer, addr1 = nation ...)
* M2 train/test    = order date before 2000-01-01; isFraud = status F and price > 250,000
* M3 predictions   = documents LEFT JOIN labels; probability = (n_chars % 100) / 100
* M5 log lines     = one text line per event
* M6 spans         = events grouped five to a trace, binary-tree parents
* M7 requests      = one API request per event
* M8 feature view  = 'view' events; entity rows = 'purchase' events
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.time import epoch_micros, epoch_seconds
from riskframe.sources.tables import load

# Fixed values of the mapping.
TRAIN_CUTOFF = "2000-01-01 00:00:00"
FRAUD_STATUS = "F"
FRAUD_PRICE = 250000.0
NULL_SEGMENT = "MACHINERY"
PRED_EPOCH = "2024-01-01 00:00:00"
SERVICES = ("fraud_detection_api", "preprocessing_service")
SPAN_SERVICES = ("fraud-detection-api", "preprocessing-service")


def identity_join(transactions: DataFrame, identity: DataFrame, key: str, identity_key: str) -> DataFrame:
    """JON-01: transactions LEFT JOIN identity.

    An empty identity table leaves its columns null; the join itself is then skipped at run time (adaptive execution drops a join
    with a side that turned out empty), so no job asks beforehand.
    """
    return transactions.join(identity, transactions[key] == identity[identity_key], "left")


def transactions(spark: SparkSession, d: str) -> DataFrame:
    """M1 + M2: the transaction table with identity columns, target and split flag."""
    j = identity_join(load(spark, d, "orders"), load(spark, d, "customer"), "o_custkey", "c_custkey")
    dt = epoch_seconds(F.col("o_orderdate"))
    return j.select(
        F.col("o_orderkey").alias("TransactionID"),
        dt.alias("TransactionDT"),
        F.col("o_totalprice").alias("TransactionAmt"),
        F.col("o_custkey").alias("card1"),
        F.col("o_orderpriority").alias("card4"),
        F.col("o_orderstatus").alias("card6"),
        F.col("c_nationkey").alias("addr1"),
        F.expr(f"nullif(c_mktsegment, '{NULL_SEGMENT}')").alias("P_emaildomain"),
        F.col("c_acctbal").alias("C1"),
        (dt.cast("double") + F.lit(86400.0) * (F.col("o_orderkey") % 30)).alias("D1"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("D2"),
        F.when((F.col("o_orderstatus") == FRAUD_STATUS) & (F.col("o_totalprice") > FRAUD_PRICE), 1)
        .otherwise(0).alias("isFraud"),
        (F.col("o_orderdate") < F.lit(TRAIN_CUTOFF).cast("timestamp_ntz")).alias("is_train"),
    )


def train_test(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    tx = transactions(spark, d)
    train = tx.where("is_train").drop("is_train")
    test = tx.where("not is_train").drop("is_train", "isFraud")
    return train, test


def predictions_of(docs: DataFrame) -> DataFrame:
    """M3 prediction rows (no labels) over any documents frame (table or stream)."""
    prob = ((F.col("n_chars") % 100) / F.lit(100.0))
    return docs.select(F.col("doc_id").alias("transaction_id"), (prob >= 0.5).cast("int").alias("prediction"),
                       prob.alias("probability"),
                       F.expr(f"timestampadd(MINUTE, doc_id, TIMESTAMP_NTZ'{PRED_EPOCH}')").alias("pred_ts"))


def labels_of(lab: DataFrame) -> DataFrame:
    """M3 label rows (final answer at label time) over any labels frame (table or stream)."""
    t = F.expr(f"timestampadd(HOUR, doc_id % 200, timestampadd(MINUTE, doc_id, TIMESTAMP_NTZ'{PRED_EPOCH}'))")
    return lab.select(F.col("doc_id").alias("transaction_id"), F.col("quality").alias("label"), t.alias("label_ts"))


def prediction_log(spark: SparkSession, d: str) -> DataFrame:
    """M3: logged predictions with their (late) ground truth."""
    docs = load(spark, d, "documents").select("doc_id", "n_chars")
    lab = load(spark, d, "labels").select("doc_id", "quality")
    prob = ((F.col("n_chars") % 100) / F.lit(100.0))
    pred_ts = F.expr(f"timestampadd(MINUTE, doc_id, TIMESTAMP_NTZ'{PRED_EPOCH}')")
    return docs.join(lab, "doc_id", "left").select(
        F.col("doc_id").alias("transaction_id"),
        prob.alias("probability"),
        (prob >= 0.5).cast("int").alias("prediction"),
        F.col("quality").alias("ground_truth"),
        pred_ts.alias("pred_ts"),
        F.when(F.col("quality").isNotNull(),
               F.expr(f"timestampadd(HOUR, doc_id % 200, timestampadd(MINUTE, doc_id, TIMESTAMP_NTZ'{PRED_EPOCH}'))"))
        .alias("label_ts"),
    )


def predictions_only(spark: SparkSession, d: str) -> DataFrame:
    """SNK-03 shape: predictions as first written (label fields null)."""
    return prediction_log(spark, d).select("transaction_id", "prediction", "probability", "pred_ts")


def label_events(spark: SparkSession, d: str) -> DataFrame:
    """Label submissions: a first answer (toxic flag) one hour early, then the final one (quality)."""
    lab = load(spark, d, "labels")
    t = F.expr(f"timestampadd(HOUR, doc_id % 200, timestampadd(MINUTE, doc_id, TIMESTAMP_NTZ'{PRED_EPOCH}'))")
    first = lab.select(F.col("doc_id").alias("transaction_id"), F.col("toxic").alias("label"),
                       (t - F.expr("INTERVAL 1 HOUR")).alias("label_ts"))
    final = lab.select(F.col("doc_id").alias("transaction_id"), F.col("quality").alias("label"),
                       t.alias("label_ts"))
    return first.unionByName(final)


def _level():
    return (F.when(F.col("event_type") == "error", "ERROR")
            .when(F.col("event_type") == "signup", "WARNING").otherwise("INFO"))


def _status():
    return (F.when(F.col("event_type") == "error", 500)
            .when((F.col("event_type") == "signup") & (F.col("event_id") % 7 == 0), 404)
            .otherwise(200))


def _method():
    return F.when(F.col("event_type").isin("purchase", "signup"), "POST").otherwise("GET")


def _service():
    return F.when(F.col("user_id") % 2 == 0, SERVICES[0]).otherwise(SERVICES[1])


def log_lines(spark: SparkSession, d: str) -> DataFrame:
    """M5: one formatted service log line per event (milliseconds on even ids only)."""
    return log_lines_of(load(spark, d, "events"))


def log_lines_of(ev: DataFrame) -> DataFrame:
    """M5 over any events frame (table or stream)."""
    ms = F.lpad(((epoch_micros(F.col("ts")) / 1000).cast("bigint") % 1000).cast("string"), 3, "0")
    ts_text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
                       F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(","), ms)).otherwise(F.lit("")))
    line = F.concat(
        ts_text, F.lit(" - "), _service(), F.lit(" - "), _level(), F.lit(" - log_requests:101 - Response: "),
        _method(), F.lit(" /"), F.col("event_type"), F.lit(" - Status: "), _status().cast("string"),
        F.lit(" - Duration: "), F.col("value").cast("string"), F.lit("ms [trace_id="),
        (F.col("event_id") / 5).cast("bigint").cast("string"), F.lit("]"))
    return ev.select(F.col("event_id").alias("line_no"), line.alias("value"))


def call_lines(spark: SparkSession, d: str) -> DataFrame:
    """M5 as the service writes a call: a request line, a response line a duration later (missing for every 11th event), and a prediction line for purchases.

    Of every 13th event the request line is missing. Line numbers are three to an event.
    """
    ev = load(spark, d, "events")
    late = F.expr("timestampadd(MICROSECOND, cast(floor(value * 1000) as bigint), ts)")

    def at(t):
        return F.concat(F.date_format(t, "yyyy-MM-dd HH:mm:ss"), F.lit(","), F.lpad((F.floor(epoch_micros(t) / 1000) % 1000).cast("string"), 3, "0"))

    call = F.concat(_method(), F.lit(" /"), F.col("event_type"))
    trace = F.concat(F.lit(" [trace_id="), F.floor(F.col("event_id") / 5).cast("string"), F.lit("]"))
    head = lambda t, fn: F.concat(at(t), F.lit(" - "), _service(), F.lit(f" - INFO - {fn} - "))
    asked = F.concat(head(F.col("ts"), "log_requests:94"), F.lit("Request: "), call, F.lit(" from 10.0.0."), (F.col("user_id") % 250).cast("string"), trace)
    answered = F.concat(head(late, "log_requests:101"), F.lit("Response: "), call, F.lit(" - Status: "), _status().cast("string"),
                        F.lit(" - Duration: "), F.col("value").cast("string"), F.lit("ms"), trace)
    share = F.floor(F.least(F.col("value") / 200.0, F.lit(1.0)) * 100)
    scored = F.concat(head(late, "predict:424"), F.lit("Prediction completed in 0.1s - Fraud: True, Probability: "), share.cast("string"), F.lit(".00%"))
    line = lambda k, text, keep: F.when(keep, F.struct((F.col("event_id") * 3 + k).alias("line_no"), text.alias("value")))
    lines = F.array(line(0, asked, F.col("event_id") % 13 > 0), line(1, answered, F.col("event_id") % 11 > 0), line(2, scored, F.col("event_type") == "purchase"))
    return ev.select(F.inline(F.filter(lines, lambda x: x.isNotNull())))


def spans(spark: SparkSession, d: str) -> DataFrame:
    """M6: spans; five events per trace, span k's parent is span (k-1)//2, root has none."""
    ev = load(spark, d, "events")
    span_no = F.col("event_id") % 5
    trace = F.floor(F.col("event_id") / 5).cast("bigint")
    return ev.select(
        trace.alias("trace_id"),
        F.col("event_id").alias("span_id"),
        F.when(span_no == 0, F.lit(None).cast("bigint"))
        .otherwise(trace * 5 + F.floor((span_no - 1) / 2).cast("bigint")).alias("parent_span_id"),
        F.when(span_no % 2 == 0, SPAN_SERVICES[0]).otherwise(SPAN_SERVICES[1]).alias("service"),
        F.col("event_type").alias("name"),
        F.col("ts").alias("start_ts"),
        F.col("value").alias("duration_ms"),
        F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("status"),
        F.create_map(F.lit("user_id"), F.col("user_id").cast("string"),
                     F.lit("event_type"), F.col("event_type")).alias("attributes"),
    )


def requests(spark: SparkSession, d: str) -> DataFrame:
    """M7: one API request per event with status, latency and predicted probability."""
    return requests_of(load(spark, d, "events"))


def requests_of(ev: DataFrame) -> DataFrame:
    """M7 over any events frame (table or stream)."""
    return ev.select(
        "event_id", "user_id", "ts",
        _method().alias("method"),
        F.concat(F.lit("/"), F.col("event_type")).alias("endpoint"),
        _status().alias("status"),
        (F.col("value") / 1000.0).alias("duration_s"),
        F.least(F.col("value") / 200.0, F.lit(1.0)).alias("probability"),
        _service().alias("service"),
    )


def feature_rows(spark: SparkSession, d: str) -> DataFrame:
    """M8 view source: 'view' events keyed by user, event and created time = ts."""
    ev = load(spark, d, "events").where(F.col("event_type") == "view")
    return ev.select("user_id", F.col("ts").alias("event_timestamp"), F.col("ts").alias("created"),
                     F.col("value").alias("feature_value"), F.col("event_id").alias("feature_event_id"))


def entity_rows(spark: SparkSession, d: str) -> DataFrame:
    """M8 entity frame: 'purchase' events asking for the feature at their time."""
    ev = load(spark, d, "events").where(F.col("event_type") == "purchase")
    return ev.select("event_id", "user_id", F.col("ts").alias("event_timestamp"), F.col("value").alias("amount"))


# ---------------------------------------------------------------------------
# DuckDB twins of the builders above, as CTE bodies.
# ---------------------------------------------------------------------------
SQL = {
    "tx": f"""
SELECT o.o_orderkey AS TransactionID,
       date_diff('second', TIMESTAMP '1970-01-01', o.o_orderdate) AS TransactionDT,
       o.o_totalprice AS TransactionAmt,
       o.o_custkey AS card1,
       o.o_orderpriority AS card4,
       o.o_orderstatus AS card6,
       c.c_nationkey AS addr1,
       NULLIF(c.c_mktsegment, '{NULL_SEGMENT}') AS P_emaildomain,
       c.c_acctbal AS C1,
       CAST(date_diff('second', TIMESTAMP '1970-01-01', o.o_orderdate) AS DOUBLE) + 86400.0 * (o.o_orderkey % 30) AS D1,
       CASE WHEN c.c_acctbal >= 0 THEN c.c_acctbal END AS D2,
       CASE WHEN o.o_orderstatus = '{FRAUD_STATUS}' AND o.o_totalprice > {FRAUD_PRICE} THEN 1 ELSE 0 END AS isFraud,
       o.o_orderdate < TIMESTAMP '{TRAIN_CUTOFF}' AS is_train
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""",
    "train": "SELECT * EXCLUDE (is_train) FROM tx WHERE is_train",
    "test": "SELECT * EXCLUDE (is_train, isFraud) FROM tx WHERE NOT is_train",
    "pred": f"""
SELECT d.doc_id AS transaction_id,
       (d.n_chars % 100) / 100.0 AS probability,
       CAST((d.n_chars % 100) / 100.0 >= 0.5 AS INTEGER) AS prediction,
       l.quality AS ground_truth,
       TIMESTAMP '{PRED_EPOCH}' + to_minutes(d.doc_id) AS pred_ts,
       CASE WHEN l.quality IS NOT NULL
            THEN TIMESTAMP '{PRED_EPOCH}' + to_minutes(d.doc_id) + to_hours(d.doc_id % 200) END AS label_ts
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "label_events": f"""
SELECT doc_id AS transaction_id, toxic AS label,
       TIMESTAMP '{PRED_EPOCH}' + to_minutes(doc_id) + to_hours(doc_id % 200) - INTERVAL 1 HOUR AS label_ts
FROM labels
UNION ALL
SELECT doc_id AS transaction_id, quality AS label,
       TIMESTAMP '{PRED_EPOCH}' + to_minutes(doc_id) + to_hours(doc_id % 200) AS label_ts
FROM labels""",
    "logs": f"""
SELECT event_id AS line_no,
       strftime(ts, '%Y-%m-%d %H:%M:%S')
       || CASE WHEN event_id % 2 = 0 THEN ',' || lpad(CAST((epoch_us(ts) // 1000) % 1000 AS VARCHAR), 3, '0') ELSE '' END
       || ' - ' || CASE WHEN user_id % 2 = 0 THEN '{SERVICES[0]}' ELSE '{SERVICES[1]}' END
       || ' - ' || CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'signup' THEN 'WARNING' ELSE 'INFO' END
       || ' - log_requests:101 - Response: '
       || CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END
       || ' /' || event_type || ' - Status: '
       || CAST(CASE WHEN event_type = 'error' THEN 500 WHEN event_type = 'signup' AND event_id % 7 = 0 THEN 404 ELSE 200 END AS VARCHAR)
       || ' - Duration: ' || CAST(value AS VARCHAR) || 'ms [trace_id=' || CAST(event_id // 5 AS VARCHAR) || ']' AS value
FROM events""",
    "calls": f"""
SELECT event_id * 3 + k AS line_no,
       strftime(t, '%Y-%m-%d %H:%M:%S') || ',' || lpad(CAST((epoch_us(t) // 1000) % 1000 AS VARCHAR), 3, '0')
       || ' - ' || CASE WHEN user_id % 2 = 0 THEN '{SERVICES[0]}' ELSE '{SERVICES[1]}' END || ' - INFO - '
       || CASE k WHEN 0 THEN 'log_requests:94 - Request: ' || call || ' from 10.0.0.' || CAST(user_id % 250 AS VARCHAR) || trace
                 WHEN 1 THEN 'log_requests:101 - Response: ' || call || ' - Status: ' || CAST(status AS VARCHAR) || ' - Duration: ' || CAST(value AS VARCHAR) || 'ms' || trace
                 ELSE 'predict:424 - Prediction completed in 0.1s - Fraud: True, Probability: ' || CAST(CAST(floor(least(value / 200.0, 1.0) * 100) AS BIGINT) AS VARCHAR) || '.00%' END AS value
FROM (SELECT *, CASE WHEN k = 0 THEN ts ELSE ts + to_microseconds(CAST(floor(value * 1000) AS BIGINT)) END AS t,
             CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END || ' /' || event_type AS call,
             ' [trace_id=' || CAST(event_id // 5 AS VARCHAR) || ']' AS trace,
             CASE WHEN event_type = 'error' THEN 500 WHEN event_type = 'signup' AND event_id % 7 = 0 THEN 404 ELSE 200 END AS status
      FROM events, range(3) r(k))
WHERE CASE k WHEN 0 THEN event_id % 13 > 0 WHEN 1 THEN event_id % 11 > 0 ELSE event_type = 'purchase' END""",
    "spans": f"""
SELECT event_id // 5 AS trace_id,
       event_id AS span_id,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE (event_id // 5) * 5 + (event_id % 5 - 1) // 2 END AS parent_span_id,
       CASE WHEN event_id % 5 % 2 = 0 THEN '{SPAN_SERVICES[0]}' ELSE '{SPAN_SERVICES[1]}' END AS service,
       event_type AS name,
       ts AS start_ts,
       value AS duration_ms,
       CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status,
       user_id AS attr_user_id
FROM events""",
    "req": f"""
SELECT event_id, user_id, ts,
       CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
       '/' || event_type AS endpoint,
       CASE WHEN event_type = 'error' THEN 500 WHEN event_type = 'signup' AND event_id % 7 = 0 THEN 404 ELSE 200 END AS status,
       value / 1000.0 AS duration_s,
       least(value / 200.0, 1.0) AS probability,
       CASE WHEN user_id % 2 = 0 THEN '{SERVICES[0]}' ELSE '{SERVICES[1]}' END AS service
FROM events""",
    "fview": """
SELECT user_id, ts AS event_timestamp, ts AS created, value AS feature_value, event_id AS feature_event_id
FROM events WHERE event_type = 'view'""",
    "ent": """
SELECT event_id, user_id, ts AS event_timestamp, value AS amount FROM events WHERE event_type = 'purchase'""",
}

_DEPS = {"train": ["tx"], "test": ["tx"]}


def with_ctes(*names: str) -> str:
    """``WITH`` clause holding the named fixture CTEs (and what they depend on)."""
    order: list[str] = []
    for n in names:
        for dep in _DEPS.get(n, []):
            if dep not in order:
                order.append(dep)
        if n not in order:
            order.append(n)
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in order) + "\n"
