"""Typed request records (SRC-06, PRJ-07, SRC-09 schema)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The 12-field request record: one required double, six optional doubles, five optional strings.
REQUEST_SCHEMA = T.StructType([
    T.StructField("TransactionAmt", T.DoubleType(), False),
    *[T.StructField(c, T.DoubleType(), True) for c in ("card1", "card2", "card3")],
    T.StructField("card4", T.StringType(), True),
    T.StructField("card5", T.DoubleType(), True),
    T.StructField("card6", T.StringType(), True),
    *[T.StructField(c, T.DoubleType(), True) for c in ("addr1", "addr2")],
    *[T.StructField(c, T.StringType(), True) for c in ("ProductCD", "P_emaildomain", "R_emaildomain")],
])


def to_request_records(df: DataFrame) -> DataFrame:
    """PRJ-07: project any frame onto the request schema (absent fields null, bad numbers null)."""
    out = []
    for f in REQUEST_SCHEMA.fields:
        if f.name in df.columns:
            c = F.col(f.name)
            out.append((c.try_cast("double") if isinstance(f.dataType, T.DoubleType) else c.cast("string")).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*out)


def records_from_json(df: DataFrame, json_col: str = "value") -> DataFrame:
    """SRC-06: JSON request bodies (one per row) to typed records; runs on tables and streams."""
    return df.select(F.from_json(F.col(json_col), REQUEST_SCHEMA).alias("r")).select("r.*")


def records_to_frame(spark, rows: list[dict]) -> DataFrame:
    """SRC-06 for a handful of in-memory records (tests, single requests)."""
    return spark.createDataFrame(rows, REQUEST_SCHEMA)
