"""Operator 11, filter interaction audit: Hart-Mas-Colell potentials of the removal game over 32 coalitions.

Five filters judge every whole text. The worth v(S) of a coalition S of filters is the number of documents that at least
one of them removes. The potential is P(S) = (v(S) + sum of P(S without i) over i in S) / |S|, P(empty) = 0, and a filter's
Shapley value is P(all) - P(all without it): 32 potentials stand for all 120 orders. They are kept as whole numbers,
Q(S) = |S|! P(S) = (|S|-1)! v(S) + sum of Q(S without i). What a filter removes at its step of an order is the coalition
difference v(T with it) - v(T), T being the filters before it; the same holds for lost good and toxic documents.

Spark counts documents per (part, set of failed filters), at most 32 rows a part with map-side aggregation, so a hot
source is 32 counters of a task. A part's 32 counts are all that the potentials need. Filter E compares texts over the
whole table: ``min(doc_id)`` per digest of the text (aggregated before the shuffle), then the rows that are first are
found by an equi-join on digest and id, which no group of copies makes hot.

Cases: a null text is empty (and equal to empty ones); a null source is the part ``''``, as an empty source is; rows with a null id have
no smaller id and so never fail E, and no labels; repeated rows with one id and text are all first; an id with several labels counts as
good or toxic if one of them says so, null labels say nothing; texts of any length are judged whole, one at a time;
other columns, whatever their names, are not read; an empty table gives no part and no row.
"""

from __future__ import annotations

import hashlib
import sys
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 200, 50, 2
SYMBOLS = b"#$%&*|"
UPPER = bytes(range(65, 91))
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)


def text_failures(text: str) -> int:
    """Bits of the filters A to D that ``text`` fails."""
    raw = text.encode()
    words = raw.split()  # of bytes: splits at space and \t to \r only
    upper = len(raw) - len(raw.translate(None, UPPER))
    return ((len(words) < MIN_WORDS) | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
            | (100 * upper > MAX_UPPER_PERCENT * len(text)) << 2 | (len(raw.translate(None, SYMBOLS)) < len(raw)) << 3)


def _judge(batches):
    for b in batches:
        texts = [t or "" for t in b["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([
            b["id"], b["part"], pa.array(map(text_failures, texts), pa.int32()),
            pa.array((hashlib.blake2b(t.encode(), digest_size=16).digest() for t in texts), pa.binary())],
            names=["id", "part", "fails", "digest"])


def failures(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, n, good, toxic): documents per part and set of failed filters (bit k: letter k of FILTERS)."""
    small_batches(documents)
    rows = documents.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                            F.col("text").cast("string").alias("text"))
    judged = stored(rows.mapInArrow(_judge, "id long, part string, fails int, digest binary"), "audit")
    known = judged.where("id is not null")
    first = stored(known.groupBy("digest").agg(F.min("id").alias("id")), "audit-first")
    marked = stored(labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id"))
                    .agg(F.max(F.expr("int(quality = 1)")).alias("good"), F.max(F.expr("int(toxic = 1)")).alias("toxic"))
                    .where("good = 1 or toxic = 1"), "audit-labels")
    # both joins have plain scans below, so Spark can split a hot id
    whole = (known.join(first.withColumn("first", F.lit(True)), ["digest", "id"], "left").drop("digest")
             .join(marked, "id", "left")
             .select("part", F.expr(f"fails | if(first is null, {1 << 4}, 0)").alias("fails"), "good", "toxic"))
    nameless = judged.where("id is null").selectExpr("part", "fails", "int(null) good", "int(null) toxic")
    return whole.unionByName(nameless).groupBy("part", "fails").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def worths(counts: np.ndarray) -> np.ndarray:
    """v(S) for every coalition: the sum of ``counts`` (last axis: sets of failed filters) over the sets that meet S."""
    sets = np.arange(ALL + 1)
    return counts @ ((sets[:, None] & sets[None, :]) != 0).astype(np.int64)


def potentials(v: np.ndarray) -> np.ndarray:
    """Q(S) = |S|! P(S) for every coalition (last axis), by the recursion over smaller coalitions."""
    q = np.zeros_like(v)
    for s in range(1, ALL + 1):  # a coalition's subsets have smaller numbers
        members = [i for i in range(len(FILTERS)) if s >> i & 1]
        q[..., s] = factorial(len(members) - 1) * v[..., s] + sum(q[..., s ^ 1 << i] for i in members)
    return q


def _steps() -> list[tuple[str, int, int, int]]:
    """(order, step, coalition before it, its filter) of all orders."""
    out = []
    for order in permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[i] for i in order), 0
        for k, i in enumerate(order):
            out.append((name, k + 1, before, i))
            before |= 1 << i
    return out


def _report(batches):
    steps = _steps()
    names, at = [s[0] for s in steps], [s[1] for s in steps]
    before, own = np.array([s[2] for s in steps]), np.array([s[3] for s in steps])
    after = before | 1 << own
    for b in batches:
        parts = b["part"].to_pylist()
        counts = np.zeros((3, len(parts), ALL + 1), np.int64)
        for row, sets in enumerate(b["sets"].to_pylist()):
            for x in sets:
                counts[:, row, x["fails"]] += x["n"], x["good"], x["toxic"]
        v, good, toxic = worths(counts)
        total, q = counts[0].sum(-1, keepdims=True), potentials(v)
        share = q[:, [ALL]] - len(FILTERS) * q[:, [ALL ^ 1 << i for i in range(len(FILTERS))]]  # |N|! (P(N) - P(N without i))
        removed = v[:, after] - v[:, before]
        table = [total - v[:, after], removed, v[:, 1 << own] - removed, v[:, [ALL]] - v[:, ALL ^ 1 << own],
                 good[:, after] - good[:, before], toxic[:, after] - toxic[:, before], share[:, own]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array(parts, object), len(steps)), pa.string()), pa.array(names * len(parts), pa.string()),
             pa.array(at * len(parts), pa.int32()), *[pa.array(x.ravel(), pa.int64()) for x in table]],
            names=["part", "filter_order", "step", *COUNTS])


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step; see SCHEMA."""
    sets = failures(documents, labels).groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("sets"))
    return sets.mapInArrow(_report, SCHEMA)


def op11(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest of the contract."""
    return audit(documents, labels)
