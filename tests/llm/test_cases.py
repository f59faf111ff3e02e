"""Nulls, empty and long texts, ties and repeated rows, empty tables and clashing columns in every operator and stage."""

import pytest

import corpus_pipeline as P
from riskframe.llm import bpe, jaccard, langid, license, lm, packing, pii, pq, quality, toxicity

LABELS = "doc_id long, quality int, toxic int"
OPS = {
    "op1": lambda d, lab: toxicity.op1(d, lab), "op2": lambda d, lab: jaccard.op2(d), "op3": lambda d, lab: license.op3(d),
    "op5": lambda d, lab: lm.op5(d), "op6": lambda d, lab: pii.op6(d), "op7": lambda d, lab: langid.op7(d), "op8": lambda d, lab: bpe.op8(d),
    "op9": lambda d, lab: quality.op9(d),
}


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 1, 0), (9, 0, 1), (None, 1, 1), (5, None, None), (77, 1, 1)], LABELS)


@pytest.mark.parametrize("name", sorted(OPS))
def test_odd_rows(odd, labels, name):
    got = OPS[name](odd, labels).collect()
    assert len(got) == odd.count()  # a row for each row
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in odd.select("doc_id").collect())


@pytest.mark.parametrize("name", sorted(OPS))
def test_empty_table(odd, labels, name):
    assert OPS[name](odd.limit(0), labels.limit(0)).collect() == []


def test_packing_odd_and_empty(odd):
    got = packing.op10(odd).collect()
    assert sum(r["length"] for r in got if r["doc_id"] == 2) == 1 and sum(r["length"] for r in got if r["doc_id"] == 5) > 2
    assert packing.op10(odd.limit(0)).collect() == []


def test_pq_empty(spark):
    assert pq.op4(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_jaccard_null_ids_and_copies(odd):
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in jaccard.op2(odd).collect()}
    assert got[3, 7] == got[4, 7] == 3 and got[1, 0] == 1 and got[2, 0] == 2
    kept = [r["doc_id"] for r in jaccard.keep_one(odd).collect()]
    assert 3 in kept and 4 not in kept and kept.count(5) == 2 and kept.count(None) == 2


@pytest.mark.parametrize("k", range(len(P.STAGES)))
def test_stages(spark, odd, small, k):
    name, stage = P.STAGES[k]
    got = stage(spark, odd, small)
    if k < len(P.STAGES) - 1:
        assert got.schema == odd.schema and got.count() <= odd.count()
    assert stage(spark, odd.limit(0), small).collect() == []


def test_language_of_texts_without_letters(odd):
    got = {r["doc_id"]: r for r in langid.op7(odd).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (1, 2, 6))


def test_pipeline_is_its_stages(spark, small):
    """The pipeline equals its stages done one after another with plain rules."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    good = {r["doc_id"] for r in quality.op9(docs).where("kept").collect()}
    lab = spark.read.parquet(f"{small}/labels.parquet")
    clean = {r["doc_id"] for r in toxicity.op1(docs, lab).where("predicted = 0").collect()} & good
    left = docs.where(docs.doc_id.isin(*clean))
    one = {r["doc_id"] for r in jaccard.op2(left).where("doc_id = component_id").collect()}
    want = {r["doc_id"]: len(packing.WordIds(packing.vocabulary()).encode([pii.redact_text(r["text"])])[0]) for r in left.collect() if r["doc_id"] in one}
    got = {r["doc_id"]: r["doc_tokens"] for r in P.run(spark, small).collect()}
    assert got == want
