"""The corpus pipeline: quality rules, toxicity, near duplicates, personal data, packing.

Each stage takes the documents that the one before kept, written as Parquet and read again, and all but the last
return the columns of ``documents``. A stage on an empty table returns an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import jaccard, packing, pii, quality, toxicity
from riskframe.llm.common import stored
from riskframe.sources.tables import load


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs)


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half by the classifier fitted on the labelled rows."""
    return toxicity.keep_clean(docs, toxicity.train(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; the length follows the text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents packed into sequences, one row per piece."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", clean_of_toxicity),
    ("near_duplicates", near_duplicates),
    ("pii", personal_data),
    ("packing", packed),
]

#: Tokenizers and a fitted classifier are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
