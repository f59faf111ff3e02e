"""Operator 1, toxicity: a counterfactually regularised linear classifier.

Features are the words of a text (lower case, letters only, each once) and their first four and five letters. A
logistic model is fitted on a bounded sample of labelled rows (``MAX_TRAIN`` documents, chosen by a hash of the id).
In the labelled texts that name an identity group, the term is swapped for the others of its group; the squared
change of the score is a penalty of the fit, so that naming a group doesn't move the score. The fitted weights (at
most ``MAX_FEATURES``) are broadcast, and every whole text is scored in the task that reads it.

Cases: null and empty texts have no words and get the score of the bias alone; without labels of both classes every
score is the share of toxic labels (0 without labels); null ids are in fold 0; repeated rows are scored one by one
and count as often as they occur in the fit; texts of any length are scored whole; an empty table gives an empty result;
other columns pass through, whatever their names.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import fold, free_name, small_batches, stored, unused

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bounds of the fit: labelled documents, and weights.
MAX_TRAIN = 8000
MAX_FEATURES = 4000
MIN_TEXTS = 3
#: Least evidence for a feature: its log odds ratio in standard errors.
MIN_STRENGTH = 3.5
STEPS, RATE, L2, FAIRNESS = 400, 0.05, 0.2, 1.0
WORD = re.compile(r"[^\W\d_]+")

# Names of groups that may be exchanged for one another in a neutral sentence.
IDENTITY_GROUPS = (
    ("women", "men", "girls", "boys", "woman", "man", "girl", "boy", "transgender"),
    ("gay", "lesbian", "bisexual", "straight", "queer", "heterosexual", "homosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants", "sikhs"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "hispanic", "indigenous"),
    ("american", "mexican", "chinese", "indian", "german", "french", "russian", "turkish", "polish"),
    ("immigrants", "refugees", "foreigners", "natives", "migrants"),
    ("blind", "deaf", "disabled", "autistic", "paralyzed"),
    ("elderly", "young", "teenage", "old"),
)


def features(words) -> set[str]:
    """Features of a set of words: the word, and its first four and five letters."""
    out = set()
    for w in words:
        out.add("w" + w)
        if len(w) > 3:
            out.add("4" + w[:4])
        if len(w) > 4:
            out.add("5" + w[:5])
    return out


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def swaps(words: set[str]) -> list[tuple[set[str], set[str]]]:
    """(features lost, features gained) for every exchange of an identity term that the words hold."""
    out = []
    for group in IDENTITY_GROUPS:
        for term in words.intersection(group):
            before, rest = features(words), words - {term}
            for other in group:
                if other not in words:
                    after = features(rest | {other})
                    out.append((before - after, after - before))
    return out


def descend(y: np.ndarray, texts: list[list[int]], pairs: list[tuple[list[int], list[int]]], size: int) -> tuple[np.ndarray, float]:
    """(weights, bias) of the penalised fit; texts and swaps (lost, gained) as lists of feature numbers."""
    r = np.array([i for i, f in enumerate(texts) for _ in f], np.int64)
    c = np.array([x for f in texts for x in f], np.int64)
    pr = np.array([i for i, (a, b) in enumerate(pairs) for _ in (*a, *b)], np.int64)
    pc = np.array([x for a, b in pairs for x in (*a, *b)], np.int64)
    pv = np.array([s for a, b in pairs for s, side in ((-1.0, a), (1.0, b)) for _ in side])
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum())) * len(y)  # both classes count alike
    w, b = np.zeros(size), 0.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(r, w[c], minlength=len(y)) + b
        g = weight * (1 / (1 + np.exp(-z)) - y) / len(y)
        grad = np.bincount(c, g[r], minlength=size) + L2 * w / len(y)
        if len(pc):  # the counterfactual penalty: squared change of the score, mean over the swaps
            change = np.bincount(pr, pv * w[pc], minlength=len(pairs))
            grad += FAIRNESS * 2 / len(pairs) * np.bincount(pc, pv * change[pr], minlength=size)
        grad = np.append(grad, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        move = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def train(documents: DataFrame, labels: DataFrame) -> tuple[dict[str, float], float]:
    """Fit on the labelled documents outside fold 0 of 5, at most MAX_TRAIN of them.

    Spark extracts and counts the features of the sample; the driver gets the chosen ones (at most MAX_FEATURES) and,
    per document, the numbers of those it has.
    """
    small_batches(documents)
    lab = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("y"))
    lab = lab.where((fold(F.col("id"), 5) != 0) & F.col("y").isNotNull() & F.col("id").isNotNull())
    lab = lab.orderBy(F.xxhash64("id"), "id", "y").limit(MAX_TRAIN)
    d = documents.select("doc_id", "text").join(F.broadcast(lab), F.col("doc_id") == F.col("id"))  # bounded by MAX_TRAIN

    def extract(batches):
        for b in batches:
            words = [sorted(words_of(t)) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["id"], b["y"], pa.array(words, pa.list_(pa.string())),
                                              pa.array([sorted(features(w)) for w in words], pa.list_(pa.string()))],
                                             names=["id", "y", "words", "features"])

    sample = stored(d.select("id", "y", "text").mapInArrow(extract, "id long, y int, words array<string>, features array<string>"), "toxicity-sample")
    n, n1 = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    n0 = n - n1
    if not n0 or not n1:
        share = n1 / n if n else 0.0
        return {}, float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    c1, c0 = F.col("c1"), F.col("c0")
    odds = F.log((c1 + 0.5) / (n1 - c1 + 0.5)) - F.log((c0 + 0.5) / (n0 - c0 + 0.5))
    strength = F.abs(odds) / F.sqrt(1 / (c1 + 0.5) + 1 / (c0 + 0.5))
    counts = sample.select("y", F.explode("features").alias("f")).groupBy("f").agg(F.sum("y").alias("c1"), F.sum(1 - F.col("y")).alias("c0"))
    best = counts.where(c1 + c0 >= MIN_TEXTS).select("f", strength.alias("s")).where(F.col("s") >= MIN_STRENGTH)
    chosen = [r["f"] for r in best.orderBy(F.desc("s"), "f").limit(MAX_FEATURES).collect()]
    at = {f: k for k, f in enumerate(chosen)}

    def number(batches):
        for b in batches:
            texts = [[at[f] for f in fs if f in at] for fs in b["features"].to_pylist()]
            pairs = [[([at[x] for x in sorted(lost) if x in at], [at[x] for x in sorted(gained) if x in at]) for lost, gained in swaps(set(ws))]
                     for ws in b["words"].to_pylist()]
            kind = pa.list_(pa.struct([("lost", pa.list_(pa.int32())), ("gained", pa.list_(pa.int32()))]))
            yield pa.RecordBatch.from_arrays([b["id"], b["y"], pa.array(texts, pa.list_(pa.int32())),
                                              pa.array([[{"lost": x, "gained": y} for x, y in p] for p in pairs], kind)],
                                             names=["id", "y", "has", "pairs"])

    got = sample.mapInArrow(number, "id long, y int, has array<int>, pairs array<struct<lost: array<int>, gained: array<int>>>").toArrow()
    rows = sorted(zip(got["id"].to_pylist(), got["y"].to_pylist(), got["has"].to_pylist(), got["pairs"].to_pylist()), key=lambda x: x[:3])
    w, bias = descend(np.array([x[1] for x in rows], float), [x[2] for x in rows],
                      [(p["lost"], p["gained"]) for x in rows for p in x[3]], len(chosen))
    return {f: float(w[k]) for f, k in at.items()}, bias


def score(df: DataFrame, model: tuple[dict[str, float], float], text: str = "text", out: str = "score") -> DataFrame:
    """The input plus the probability that a text is toxic; the name is lengthened by ``_`` while the input has it."""
    small_batches(df)
    out = free_name(df, out)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        weights, bias = shared.value
        known: dict[str, tuple[str, ...]] = {}
        for b in batches:
            scores = []
            for t in b[text].to_pylist():
                hits: set[str] = set()
                for w in words_of(t):
                    f = known.get(w)
                    if f is None:
                        if len(known) > 1_000_000:
                            known.clear()
                        f = known[w] = tuple(x for x in features((w,)) if x in weights)
                    if f:
                        hits.update(f)
                z = bias + sum(weights[x] for x in sorted(hits))
                scores.append(1 / (1 + np.exp(-z)) if z > -500 else 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], names=[*b.schema.names, out])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())]))


def keep_clean(df: DataFrame, model: tuple[dict[str, float], float], text: str = "text") -> DataFrame:
    """The rows whose score is below 0.5, with the input's columns."""
    out = unused(df, "__tox")
    return score(df, model, text, out).where(F.col(out) < 0.5).drop(out)


def op1(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest of the contract: one row per document."""
    d = documents.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "text")
    out = score(d, train(documents, labels))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
