"""Fits and scores of the learned operators against plain versions, clashing names, and values for odd rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import langid, lm, pii, toxicity


def fold(i, m):
    return zlib.crc32(str(i).encode()) % m


# ---------------------------------------------------------------- language identification
def _buckets(text):
    """Buckets of the 2- and 3-grams of a text between blanks, one by one."""
    t = [ord(c) for c in " " + text.lower() + "  "]
    mult, mask, out = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D), 0xFFFFFFFF, []

    def mixed(g):
        g = (g ^ (g >> 15)) * 0x2C1B3C6D & mask
        return (g ^ (g >> 13)) & (langid.BUCKETS - 1)
    for i in range(len(t) - 2):
        two = (t[i] * mult[0] + t[i + 1] * mult[1]) & mask
        out += [mixed(two), mixed((two + t[i + 2] * mult[2]) & mask)]
    return out


def _posterior(train, texts):
    names = sorted({lang for lang, _ in train})
    counts = {n: Counter() for n in names}
    for lang, t in train:
        counts[lang].update(_buckets(t))
    out = []
    for t in texts:
        logs = []
        for n in names:
            total = sum(counts[n].values()) + langid.SMOOTHING * langid.BUCKETS
            logs.append(sum(math.log((counts[n][b] + langid.SMOOTHING) / total) for b in _buckets(t)))
        top = max(logs)
        out.append((names[logs.index(top)], 1 / sum(math.exp(x - top) for x in logs)))
    return out


@pytest.mark.parametrize("at_once", [2, 128])
def test_language_posterior_against_plain_version(spark, monkeypatch, at_once):
    monkeypatch.setattr(langid, "LANGS_AT_ONCE", at_once)
    rng = random.Random(4)
    alphabets = {"aa": "abcde", "bb": "cdefg", "cc": "éàûab", "dd": "中文字ab", "ee": "xyzab"}
    prose = lambda a, n: "".join(rng.choice(a + "  ") for _ in range(n))
    train = [(lang, prose(a, rng.randint(0, 80))) for lang, a in alphabets.items() for _ in range(6)]
    texts = [prose("abcdexyzé", rng.randint(3, 25)) + "a" for _ in range(40)] + ["a" * 300, "A中"]
    model = langid.train(spark.createDataFrame([(t, lang) for lang, t in train], "text string, lang string").repartition(3))
    got = langid.predict(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), model).orderBy("id").collect()
    for r, (lang, score) in zip(got, _posterior(train, texts)):
        assert r["score"] == pytest.approx(score, rel=1e-3, abs=1e-4), r
        assert r["lang_pred"] == lang or score < 0.5001


def test_very_many_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGS_AT_ONCE", 100)
    word = lambda k: chr(0x4E00 + 3 * k) + chr(0x4E01 + 3 * k)
    rows = [(word(k) * 4, f"l{k:04}") for k in range(700)]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    got = langid.predict(spark.createDataFrame([(k, word(k)) for k in range(700)], "k long, text string"), model).collect()
    assert len(got) == 700 and sum(r["lang_pred"] == f"l{r['k']:04}" for r in got) >= 695


# ---------------------------------------------------------------- toxicity
def test_toxicity_scores_against_plain_version(spark, small, texts):
    docs, lab = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    weights, bias = toxicity.train(docs, lab)
    got = {r["doc_id"]: r["score"] for r in toxicity.op1(docs, lab).collect()}
    for i, t in texts.items():
        has = {f for w in set(toxicity.WORD.findall(t.lower())) for f in ("w" + w, "4" + w[:4] if len(w) > 3 else "", "5" + w[:5] if len(w) > 4 else "")}
        z = bias + sum(weights.get(f, 0.0) for f in has)
        assert got[i] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


def test_penalised_fit_is_a_minimum():
    """The fit's weights beat every step away from them on the stated objective (up to what its 400 steps leave)."""
    rng = np.random.default_rng(3)
    size, n = 6, 200
    texts = [sorted(rng.choice(size, rng.integers(1, 4), replace=False).tolist()) for _ in range(n)]
    y = np.array([float(0 in t or rng.random() < 0.2) for t in texts])
    pairs = [([1], [2]), ([2], [1]), ([1], [])]
    w, b = toxicity.descend(y, texts, pairs, size)
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (n - y.sum())) * n

    def loss(w, b):
        z = np.array([sum(w[x] for x in t) for t in texts]) + b
        fit = (weight * (np.logaddexp(0, z) - y * z)).mean()
        change = [sum(w[x] for x in gained) - sum(w[x] for x in lost) for lost, gained in pairs]
        return fit + toxicity.L2 / 2 * (w @ w) / n + toxicity.FAIRNESS * np.mean(np.square(change))
    best = loss(w, b)
    for k in range(size + 1):
        for step in (-0.2, 0.2):
            v, c = w.copy(), b
            if k < size:
                v[k] += step
            else:
                c += step
            assert loss(v, c) > best - 2e-4


# ---------------------------------------------------------------- language model
def test_mixture_weights_against_exact_em():
    """EM on the histogram against EM on every deleted token's own probabilities."""
    rng = np.random.default_rng(6)
    n, distinct = 4000, 300
    context = rng.integers(0, 4, n)
    p2 = np.where(rng.random(n) < 0.4, 0.0, rng.uniform(0.001, 0.9, n))
    p1 = np.where(rng.random(n) < 0.1, 0.0, rng.uniform(1e-4, 0.05, n))
    cells, times = np.unique((context * lm.CELLS + lm._bin(p2)) * lm.CELLS + lm._bin(p1), return_counts=True)
    got = lm.fit_weights(cells, times.astype(float), distinct)
    p = np.column_stack([p2, p1, np.full(n, 1 / (distinct + 1))])
    want = np.full((4, 3), 1 / 3)
    for _ in range(lm.ROUNDS):
        share = want[context] * p
        share /= share.sum(1, keepdims=True)
        want = np.array([share[context == k].mean(0) for k in range(4)])
    assert np.abs(got[:4] - want).max() < 0.02
    loglik = lambda w: np.log((w[context] * p).sum(1)).mean()
    assert loglik(got[:4]) >= loglik(want) - 1e-3


# ---------------------------------------------------------------- clashing names, values of odd rows
def test_clashing_names(spark):
    d = spark.createDataFrame([(1, "write to a@b.cd", "kept")], "doc_id long, text string, score string")
    d = d.withColumns({"pii_spans": F.lit(7), "lang_pred": F.lit("zz")})
    f = pii.find(d)
    assert f.columns == [*d.columns, "pii_spans_"] and f.first()["pii_spans"] == 7 and f.first()["pii_spans_"][0]["kind"] == "email"
    s = toxicity.score(d, ({}, 0.0))
    assert s.columns == [*d.columns, "score_"] and s.first()["score"] == "kept" and s.first()["score_"] == 0.5
    p = langid.predict(d, langid.train(spark.createDataFrame([("aa", "x")], "text string, lang string")))
    assert p.columns == [*d.columns, "lang_pred_", "score_"] and p.first()["lang_pred"] == "zz" and p.first()["lang_pred_"] == "x"


def test_values_of_odd_rows(spark, odd):
    """Nulls, empty texts, ties and repeated rows have the values that the docstrings state."""
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, 0), (9, 0, 1)], "doc_id long, quality int, toxic int")
    tox = toxicity.op1(odd, labels).collect()
    empty = {r["score"] for r in tox if r["doc_id"] in (1, 2, 6)}
    assert len(empty) == 1                                             # the bias alone
    by = {}
    for r in tox:
        by.setdefault(r["doc_id"], []).append(r["score"])
    assert by[3] == by[4] and by[5][0] == by[5][1] and len(by[5]) == 2
    found = {}
    for r in pii.op6(odd).collect():
        found.setdefault(r["doc_id"], []).append(r)
    assert found[1][0]["spans"] == found[2][0]["spans"] == "" and found[5][0] == found[5][1]
    assert found[5][0]["n_email"] == 1 and found[5][0]["n_card"] == 1
    scored = {}
    for r in lm.op5(odd).collect():
        scored.setdefault(r["doc_id"], []).append(r)
    assert scored[1][0]["n_tokens"] == scored[2][0]["n_tokens"] == scored[6][0]["n_tokens"] == 1
    assert scored[1][0]["score"] == scored[2][0]["score"] and scored[5][0] == scored[5][1]
    assert all(r["train_tokens"] == tox_n for rs in scored.values() for r in rs for tox_n in [scored[1][0]["train_tokens"]])
