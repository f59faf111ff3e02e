"""The registered queries of the llm operators: each applies one operator to its whole table."""

from __future__ import annotations

from riskframe.llm import audit, bpe, jaccard, langid, license, lm, oracles, packing, pii, pq, quality, resample, sharding, toxicity
from riskframe.sources.tables import load

QUERIES = {
    "op1_toxicity": lambda spark, d: toxicity.op1(load(spark, d, "documents"), load(spark, d, "labels")),
    "op2_ngram_jaccard": lambda spark, d: jaccard.op2(load(spark, d, "documents")),
    "op3_license_scan": lambda spark, d: license.op3(load(spark, d, "documents")),
    "op4_embedding_pq": lambda spark, d: pq.op4(load(spark, d, "embeddings")),
    "op5_lm_scoring": lambda spark, d: lm.op5(load(spark, d, "documents")),
    "op6_pii": lambda spark, d: pii.op6(load(spark, d, "documents")),
    "op7_language_id": lambda spark, d: langid.op7(load(spark, d, "documents")),
    "op8_bpe": lambda spark, d: bpe.op8(load(spark, d, "documents")),
    "op10_packing": lambda spark, d: packing.op10(load(spark, d, "documents")),
    "op9_quality_rules": lambda spark, d: quality.op9(load(spark, d, "documents")),
    "op11_filter_audit": lambda spark, d: audit.op11(load(spark, d, "documents"), load(spark, d, "labels")),
    "op12_importance_resampling": lambda spark, d: resample.op12(load(spark, d, "documents"), load(spark, d, "benchmark")),
    "op13_sharding": lambda spark, d: sharding.op13(load(spark, d, "documents")),
}
ORACLE: dict[str, str] = oracles.ORACLE
