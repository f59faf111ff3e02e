"""Operator 7, language identification: multinomial naive Bayes over hashed character n-grams.

Counting: every task sums the bucket counts of its texts per language and returns the non-zero ones; Spark adds
them up into a table of (language, bucket, count). The log probabilities of up to ``LANGS_AT_ONCE`` languages at a time are
broadcast as a matrix to the scoring tasks, which score whole batches with numpy; each text keeps its best
language so far and the sum of all likelihoods, so any number of languages is scored exactly, a matrix per step. After every
``STEPS_A_JOB`` steps the state is written, so that a task never holds more matrices than that.

Cases: a null text or one without a letter is ``und`` with score 0, as are all texts when nothing could be learned;
rows without a language are not learned from; ties go to the first language by name; repeated rows count as often
as they occur; texts of any length are read whole; other columns pass through, whatever their names; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import fold, free_name, small_batches, stored, unused

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 16
#: Languages in one broadcast matrix (a quarter MB each), and matrices in one job.
LANGS_AT_ONCE, STEPS_A_JOB = 64, 2
SMOOTHING = 0.5
LETTER = re.compile(r"[^\W\d_]")
_MULT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
#: Code points per numpy slice.
SLICE = 1 << 20


def gram_buckets(texts: list[str]):
    """Yield (first text, bucket pairs, starts, lengths): buckets of the 2- and 3-grams that start at each position.

    Every text stands between blanks, so its grams don't depend on its neighbours; the grams of text k are the
    positions starts[k] to starts[k] + lengths[k].
    """
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (size == 0 or size + len(texts[j]) <= SLICE):
            size += len(texts[j]) + 3
            j += 1
        low = [" " + t.lower() + "  " for t in texts[i:j]]
        sizes = np.fromiter(map(len, low), np.int64, len(low))
        code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
        two = code[:-1] * _MULT[0] + code[1:] * _MULT[1]
        three = two[:-1] + code[2:] * _MULT[2]
        pairs = []
        for g in (two[:-1], three):
            g = (g ^ (g >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            pairs.append((g ^ (g >> np.uint32(13))) & np.uint32(BUCKETS - 1))
        yield i, pairs, np.cumsum(sizes) - sizes, sizes - 2
        i = j


def train(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, bucket, n) from all rows with a text and a language: the n-grams of each language per bucket, in the shared folder."""
    small_batches(df)

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            texts, langs = b["t"].to_pylist(), np.array(b["l"].to_pylist(), object)
            for first, pairs, starts, lengths in gram_buckets(texts):
                names, which = np.unique(langs[first:first + len(starts)].astype(str), return_inverse=True)
                keep = np.zeros(len(pairs[0]) + 1, np.int8)
                np.add.at(keep, starts, 1)
                np.add.at(keep, starts + lengths, -1)
                keep = np.cumsum(keep[:-1]) > 0
                owner = np.repeat(which, np.diff(np.append(starts, len(keep))))[keep]
                for p in pairs:
                    n = np.bincount(owner * BUCKETS + p[keep], minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
                    for k, name in enumerate(names):
                        sums[name] = sums[name] + n[k] if name in sums else n[k]
        for name, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()),
                                              pa.array(n[at], pa.int64())], names=["lang", "bucket", "n"])

    rows = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("t"), F.col(lang).cast("string").alias("l"))
    counts = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    return stored(counts, "langid")


def matrices(counts: DataFrame):
    """Yield (languages, log probabilities) for all languages in the order of their names, LANGS_AT_ONCE at a time (so many times BUCKETS counts at most)."""
    names = sorted(r["lang"] for r in counts.select("lang").distinct().collect())  # a name per language
    for k in range(0, len(names), LANGS_AT_ONCE):
        part = names[k:k + LANGS_AT_ONCE]
        at = F.create_map(*[F.lit(x) for i, name in enumerate(part) for x in (name, i)])[F.col("lang")]
        got = counts.where(F.col("lang").isin(part)).select(at.alias("k"), "bucket", "n").toArrow()
        n = np.zeros((len(part), BUCKETS))
        n[got["k"].to_numpy(), got["bucket"].to_numpy()] = got["n"].to_numpy()
        yield part, np.log((n + SMOOTHING) / (n.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)).astype(np.float32)


def likelihoods(texts: list[str], matrix: np.ndarray) -> np.ndarray:
    """Log likelihood of each text (columns) in each language (rows)."""
    total = np.zeros((len(matrix), len(texts)))
    for first, pairs, starts, lengths in gram_buckets(texts):
        cuts = np.ravel(np.column_stack([starts, starts + lengths]))
        for k, own in enumerate(matrix):
            w = own[pairs[0]] + own[pairs[1]]
            total[k, first:first + len(starts)] = np.add.reduceat(np.append(w, np.float32(0)).astype(np.float64), cuts)[::2]
    return total


def predict(df: DataFrame, model: DataFrame, text: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """The input plus the predicted language and its posterior under equal priors; names are lengthened by ``_`` while the input has them."""
    small_batches(df)
    lang_out, score_out = free_name(df, lang_out), free_name(df, score_out)
    p = unused(df, "__lid")
    best, top, every = f"{p}l", f"{p}t", f"{p}s"
    out = df.withColumns({best: F.lit(None).cast("string"), top: F.lit(float("-inf")), every: F.lit(float("-inf"))})
    for step, (names, matrix) in enumerate(matrices(model)):
        if step and step % STEPS_A_JOB == 0:
            out = stored(out, "langid-steps")
        shared = df.sparkSession.sparkContext.broadcast((names, matrix))

        def run(batches, shared=shared):
            names, matrix = shared.value
            for b in batches:
                total = likelihoods([t if t and LETTER.search(t) else "" for t in b[text].to_pylist()], matrix)
                k = total.argmax(axis=0)
                most = total[k, np.arange(b.num_rows)]
                sums = np.log(np.exp(total - most).sum(axis=0)) + most
                old, held = b[top].to_numpy(), b[best].to_pylist()
                new = [names[i] if m > o else h for i, m, o, h in zip(k.tolist(), most, old, held)]
                state = [pa.array(new, pa.string()), pa.array(np.maximum(most, old)), pa.array(np.logaddexp(b[every].to_numpy(), sums))]
                yield pa.RecordBatch.from_arrays([*b.columns[:-3], *state], names=b.schema.names)

        out = out.mapInArrow(run, out.schema)
    letters = F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False)) & F.col(best).isNotNull()
    return out.withColumns({lang_out: F.when(letters, F.col(best)).otherwise("und"),
                            score_out: F.when(letters, F.exp(F.col(top) - F.col(every))).otherwise(0.0)}).drop(best, top, every)


def op7(documents: DataFrame) -> DataFrame:
    """The digest of the contract: learned from folds 0, 1 and 3 of 4, predicted for every document."""
    part = fold(F.col("doc_id"), 4)
    model = train(documents.where(part != 2).select("text", "lang"))
    out = predict(documents.select("doc_id", (part == 2).alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "lang_pred", "score")
