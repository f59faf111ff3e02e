"""Operator 13, sharding [native]: proportional stratified interleaving.

Rows of each source are put in a seeded random order (a SHA-256 of seed and id) and ranked from 0. Row r of a source with n rows gets the
fractional rank (2r + 1) / 2n. Sorted by it, the sources are interleaved in proportion, so any run of rows holds each
source in its share, and cutting the order into equal runs gives shards that match the mixture; the law that holds is
``rows``: counts differ by one at most. Every row is placed alone: copies of a text are rows like others and lie where their own ranks put them
(a group of copies with a third of all rows could not stay together under this law).

Both orders are global running counts: rows are dealt into ranges, counted per range and source, and offset by the ranges
before. A hot source fills many ranges, no task sees a whole source. Texts are read once, for size and CRC; only
narrow rows travel. DataFrame functions only.

Cases: a null text has size 1 and the CRC of no bytes (0); a null source is a stratum of its own, as is an empty one; null ids count as the empty string in
the order; repeated rows and ties are ordered by CRC and size, equal rows are interchangeable; texts of any length count whole; fewer
rows than shards leave shards empty; other columns, whatever their names, are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import stored
from riskframe.operators.keys import lookup, row_index, running_totals

SHARDS, SEED = 8, 2024
HEX_DIGITS = 15


def order_key(doc_id, seed: int = SEED):
    """The seeded random place of an id: 60 bits of a SHA-256."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(text, 256), 1, HEX_DIGITS), 16, 10).cast("long")


def assign(df: DataFrame, shards: int = SHARDS, seed: int = SEED, by: str = "source") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row; shards match the mixture of ``by``."""
    raw = F.col("text").cast("string").cast("binary")
    rows = stored(df.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.concat(F.lit("="), F.col(by).cast("string")).alias("stratum"),
        (F.coalesce(F.octet_length(raw), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"), order_key(F.col("doc_id"), seed).alias("key"))
        .na.fill("", ["stratum"]), "sharding")
    counts = stored(rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")), "sharding-strata")
    strata, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not total:
        return rows.selectExpr("doc_id", "size", "text_crc32", "cast(null as int) shard", "cast(null as bigint) slot")
    ranked = running_totals(rows, ["key", "doc_id", "text_crc32", "size"], {"r": F.lit(1).cast("long")}, groups=["stratum"], inclusive=False)
    placed = (lookup(ranked, counts, F.col("stratum"), "stratum", {"n": "n"}, rows=strata)
              .select("doc_id", "size", "text_crc32", "stratum", "key", F.expr("(2 * r + 1) / (2 * n)").alias("fraction")))
    at = row_index(placed, ["fraction", "key", "stratum", "doc_id", "text_crc32", "size"], "p", start=0)
    shard = F.expr(f"p * {shards} div {total}")
    return (at.withColumn("shard", shard.cast("int"))
            .select("doc_id", "size", "text_crc32", "shard", F.expr(f"p - (shard * {total}L + {shards - 1}) div {shards}").alias("slot")))


def op13(documents: DataFrame) -> DataFrame:
    """The digest of the contract, under the law ``rows``."""
    return assign(documents).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                    F.lit(None).cast("int").alias("grown_shard"))
