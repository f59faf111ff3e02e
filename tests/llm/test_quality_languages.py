"""More languages than the plan holds references of."""

import math
import random

import pytest
from pyspark.sql import functions as F

from riskframe.llm import quality as Q


def distance(a, b):
    p, q = ([x / sum(v) for x in v] for v in (a, b))
    return math.sqrt(max(0.0, sum(x * math.log2(2 * x / (x + y)) for v, w in ((p, q), (q, p)) for x, y in zip(v, w) if x) / 2))


def off(cc, cw, classes, words, own):
    """The larger of both distances as a share of its limit; None where the reference does not judge the text."""
    dc, rest = distance(cc, classes) / Q.MAX_CLASS_DISTANCE, words[-1] / sum(words)
    if 1 - rest >= Q.MIN_COMMON:
        nothing = [0] * (len(words) - 1) + [1]
        return max(dc, distance(cw, words) / (Q.WORD_SHARE * distance(nothing, words)))
    return dc if own else None


def test_every_language_has_its_reference(spark):
    rng = random.Random(9)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(6))
    prose = lambda: " ".join(rng.choice(["the", "of", "and", word("abcdefgh"), word("abcdefgh")]) for _ in range(60))
    common = lambda letters: " ".join(rng.choice(["the", "of", word(letters), word(letters)]) for _ in range(60))
    capitals, digits = (lambda: common("ABCDEFGH")), (lambda: common("0123456789"))
    symbols = lambda: " ".join(word("#*$%&|") for _ in range(60))
    made = [(f"l{k:03}", prose()) for k in range(2 * Q.MAX_LANGS) for _ in range(2)]
    made += [("zz", capitals()), ("zy", digits())]  # fewest texts, kept by their own reference
    made += [(None, capitals()), ("l001", digits()), (None, digits())]  # kept by another language's reference
    made += [(None, symbols()), (None, "few words")]  # near no reference; base rules fail
    df = spark.createDataFrame([(i, t, lang, None, len(t)) for i, (lang, t) in enumerate(made)],
                               "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = {r["doc_id"]: r["kept"] for r in Q.op9(df).collect()}
    p, want, parts = "__q_", {}, {}
    rows = Q._histograms(Q._measures(df, "text", p), p).collect()
    for r in rows:
        if r["lang"] and r["n_chars"] >= Q.MIN_CHARS and r[f"{p}n_words"] >= Q.MIN_WORDS:
            for k in ("cc", "cw"):
                parts[k, r["lang"]] = [x + y for x, y in zip(r[p + k], parts.get((k, r["lang"]), [0] * len(r[p + k])))]
    for r in rows:
        offs = [off(r[p + "cc"], r[p + "cw"], parts["cc", k], parts["cw", k], r["lang"] == k) for j, k in parts if j == "cc"]
        far = min((x for x in offs if x is not None), default=0) if r["n_chars"] >= Q.MIN_CHARS and r[f"{p}n_words"] >= Q.MIN_WORDS else 0
        want[r["doc_id"]] = not r[f"{p}base_failed"] and far <= 1
    assert got == want
    tail = [got[i] for i in range(4 * Q.MAX_LANGS, len(made))]
    assert tail == [True] * 5 + [False] * 2
    assert Q.keep_good(df).count() == sum(want.values())


def test_texts_without_common_words_fail_and_clean_ones_stay(spark):
    """On the labelled documents, and on texts made of other words only."""
    from conftest import SF_MID
    docs, lab = spark.read.parquet(f"{SF_MID}/documents.parquet"), spark.read.parquet(f"{SF_MID}/labels.parquet")
    got = Q.op9(docs).join(lab, "doc_id").where("NOT base_failed").groupBy("quality").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("kept")).collect()
    kept = {r["quality"]: (r["n"], r["kept"]) for r in got}
    assert kept[1][0] > 100 and kept[1][0] == kept[1][1]          # every clean document that passes the base rules
    assert kept[0][1] < 0.6 * kept[0][0]                          # many of the others
    made = [(i, " ".join(f"the w{i}x{j} of v{i}y{j} and u{j} cats{i}" for j in range(20)), "en") for i in range(30)]
    none = " ".join(f"wort{j}" for j in range(300))
    made += [(100, none, "en"), (101, none, None)]
    df = spark.createDataFrame(made, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["kept"] for r in Q.op9(df).collect()}
    assert not got[100] and not got[101] and all(got[i] for i in range(30))


def test_language_without_common_words_judges_its_own_texts(spark):
    own = [(i, " ".join(f"zebra{i}x{j}" for j in range(60)), "zz") for i in range(4)]
    prose = [(10 + i, " ".join(f"the w{i}{j} of v{i}{j} and" for j in range(20)), "en") for i in range(30)]
    df = spark.createDataFrame(own + prose + [(50, own[0][1].replace("x", "y"), None), (51, own[0][1].replace("x", "y"), "zz")],
                               "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["kept"] for r in Q.op9(df).collect()}
    assert all(got[i] for i in range(4)) and got[51] and not got[50] and all(got[10 + i] for i in range(30))


@pytest.mark.parametrize("rest", [0.5, 0.8, 0.94])
def test_word_limit_is_a_share_of_the_distance_of_a_text_without_common_words(spark, rest):
    words = [1 - rest] + [0.0] * (len(Q.BINS) - 1) + [rest]
    want = Q.WORD_SHARE * distance([0] * len(Q.BINS) + [1], words)
    assert Q.word_limit(rest) == pytest.approx(want)
    assert spark.range(1).select(Q.word_limit(F.lit(rest))).first()[0] == pytest.approx(want)
    assert Q.word_limit(0.97) is None and spark.range(1).select(Q.word_limit(F.lit(0.97))).first()[0] is None
