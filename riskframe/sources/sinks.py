"""Sinks: overwrite / append tables, JSON-safe records, reference samples, key layout.

Every path is a folder in shared storage (see ``session.shared_dir``), and
every write is a Spark job: nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.time import iso_text


def overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """SNK-01 / SNK-08: replace the table at ``path`` (drop-and-replace of a collection)."""
    df.write.mode("overwrite").format(fmt).save(path)


def store_data(df: DataFrame, path: str) -> int:
    """SNK-02: overwrite the offline feature table; empty input is rejected; returns the row count.

    The count is read back from the written table (one metadata-light job),
    so the input plan runs only once.
    """
    if df.isEmpty():
        raise ValueError("no records to store")
    overwrite(df, path)
    return df.sparkSession.read.parquet(path).count()


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """SNK-03: append records (label fields stay null until a label arrives)."""
    df.write.mode("append").format(fmt).save(path)


#: SNK-03: one record of the prediction log.
RECORD_SCHEMA = ("transaction_id long, prediction int, probability double, pred_ts timestamp_ntz, features map<string,double>, "
                 "ground_truth int, label_ts timestamp_ntz")


def prediction_records(df: DataFrame) -> DataFrame:
    """SNK-03: predictions as records of the log (``features``: name to value); label fields are null until a label comes."""
    return df.select(F.col("transaction_id").cast("long"), F.col("prediction").cast("int"), F.col("probability").cast("double"),
                     F.col("pred_ts").cast("timestamp_ntz"), F.col("features").cast("map<string,double>"),
                     F.lit(None).cast("int").alias("ground_truth"), F.lit(None).cast("timestamp_ntz").alias("label_ts"))


def read_prediction_log(spark: SparkSession, path: str) -> DataFrame:
    """SRC-05: the prediction log's JSON lines by their declared schema."""
    return spark.read.schema(RECORD_SCHEMA).json(path)


def json_safe(df: DataFrame, order: list[str] | None = None, limit: int | None = None,
              as_json: bool = False) -> DataFrame:
    """SNK-06: NaN to null, timestamps to ISO text; optionally ordered first ``limit`` rows and one JSON string."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.nanvl(c, F.lit(None).cast(f.dataType))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = iso_text(c)
        cols.append(c.alias(f.name))
    out = df.select(*cols)
    if order:
        out = out.orderBy(*order)
    if limit is not None:
        out = out.limit(limit)
    if as_json:
        out = out.select(F.to_json(F.struct(*out.columns)).alias("json"))
    return out


def save_reference_sample(df: DataFrame, path: str) -> None:
    """SNK-08: store the drift reference sample (overwrite)."""
    overwrite(df, path)


def read_reference_sample(spark: SparkSession, path: str) -> DataFrame | None:
    """SRC-03: the stored reference sample, or None (drift checks disabled) when it is absent."""
    jvm = spark._jvm.org.apache.hadoop.fs
    hp = jvm.Path(path)
    if not hp.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hp):
        return None
    return spark.read.parquet(path)


def write_key_layout(df: DataFrame, path: str, key: str, rows_per_file: int = 5_000_000, rows_per_group: int = 100_000) -> int:
    """SNK-09: lay rows out by key for lookups; returns the number of files, which follows the number of rows.

    Files are ranges of the key, sorted inside, so min/max statistics leave one file and a few row groups for a key; a
    Bloom filter per row group drops those that don't hold it, and pages are short enough that the column index skips
    most of a group. That is the role of an index in a database.
    """
    files = max(1, -(-df.count() // rows_per_file))
    (df.repartitionByRange(files, key).sortWithinPartitions(key).write.mode("overwrite")
       .option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.expected.ndv#{key}", str(rows_per_group))
       .option("parquet.block.row.count.limit", str(rows_per_group)).option("parquet.page.row.count.limit", "2000").parquet(path))
    return files
