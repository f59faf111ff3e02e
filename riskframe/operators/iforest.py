"""Isolation forest (Liu, Ting, Zhou, ICDM 2008) as Spark jobs.

* sampling: every row draws tree slots from a hash of its id, so each tree
  gets about ``sample_size`` rows without any global sort;
* building: ``groupBy(tree).applyInPandas`` grows one small tree per group
  (a group holds at most ``sample_size`` rows by construction);
* scoring: the forest (at most ``trees * (2 * sample_size - 1)`` nodes, a
  proven bound) is broadcast and every partition is scored with vectorized
  numpy in ``mapInPandas``.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The tree builder and scorer run in Python workers: ship this module's code with the
# tasks (pickled by value) so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EULER = 0.5772156649015329
NODE_SCHEMA = "tree_id int, node_id int, feature int, threshold double, left int, right int, size long"


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful search in a binary tree of ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    nodes: list = []
    stack = [(np.arange(len(x)), 0, -1, 0)]  # (rows, depth, parent, side)
    while stack:
        idx, depth, parent, side = stack.pop()
        me = len(nodes)
        nodes.append([-1, 0.0, -1, -1, len(idx)])
        if parent >= 0:
            nodes[parent][2 + side] = me
        if depth >= max_depth or len(idx) <= 1:
            continue
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if cand.size == 0:
            continue
        f = int(rng.choice(cand))
        t = float(rng.uniform(lo[f], hi[f]))
        nodes[me][0], nodes[me][1] = f, t
        go_left = sub[:, f] < t
        stack.append((idx[~go_left], depth + 1, me, 1))
        stack.append((idx[go_left], depth + 1, me, 0))
    return nodes


def fit(df: DataFrame, features: list[str], id_col: str, trees: int = 100, sample_size: int = 256,
        seed: int = 42) -> DataFrame:
    """Grow the forest; returns the node table (one row per node)."""
    n = df.count()
    psi = min(sample_size, n)
    copies = max(1, math.ceil(trees * psi * 1.2 / max(n, 1)))
    frac = min(1.0, trees * psi * 1.2 / max(n * copies, 1))
    h = F.xxhash64(F.col(id_col), F.lit(seed))
    u = (F.pmod(h, F.lit(1 << 30)) / float(1 << 30))
    s = df.where(u < frac).select(id_col, *[F.col(c).cast("double").alias(c) for c in features])
    s = s.withColumn("__k", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    s = s.withColumn("tree_id", F.pmod(F.xxhash64(F.col(id_col), F.col("__k"), F.lit(seed)), F.lit(trees)).cast("int"))
    s = s.withColumn("__o", F.xxhash64(F.col(id_col), F.lit(seed), F.lit("order"))) \
         .dropDuplicates(["tree_id", id_col])
    max_depth = int(math.ceil(math.log2(max(psi, 2))))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tid = int(pdf["tree_id"].iloc[0])
        pdf = pdf.sort_values("__o").head(psi)
        x = pdf[features].fillna(0.0).to_numpy(dtype=float)
        rng = np.random.default_rng(seed * 100003 + tid)
        nodes = _grow(x, rng, max_depth)
        return pd.DataFrame({"tree_id": tid, "node_id": np.arange(len(nodes), dtype=np.int32),
                             "feature": [r[0] for r in nodes], "threshold": [r[1] for r in nodes],
                             "left": [r[2] for r in nodes], "right": [r[3] for r in nodes],
                             "size": [r[4] for r in nodes]})

    return s.groupBy("tree_id").applyInPandas(build, NODE_SCHEMA)


#: Rows whose way through the trees is followed at a time: their numbers stay in the processor's cache.
SCORED_ROWS = 4096


def _padded(feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, right: np.ndarray, size: np.ndarray) -> tuple:
    """A tree with all its leaves on the last level, children of i at 2i + 1 and 2i + 2: (levels, feature, threshold, path length of the leaf).

    A leaf further up passes all its rows on to the right. A path's length is the leaf's depth plus the mean path that its rows would still have.
    """
    place, depth = {0: 0}, {0: 0}
    todo = [0]
    for x in todo:
        if feature[x] >= 0:
            for side, k in enumerate((left[x], right[x])):
                place[k], depth[k] = 2 * place[x] + 1 + side, depth[x] + 1
                todo.append(k)
    levels = max(depth.values())
    f, t, length = np.zeros((1 << levels) - 1, np.intp), np.full((1 << levels) - 1, -np.inf), np.zeros(1 << levels)
    for x in todo:
        if feature[x] >= 0:
            f[place[x]], t[place[x]] = feature[x], threshold[x]
        else:
            last = (place[x] + 2 << levels - depth[x]) - 2      # the rightmost place below it on the last level
            length[last - (1 << levels) + 1] = depth[x] + c_factor(float(size[x]))
    return levels, f, t, length


def _lengths(x: np.ndarray, trees: list[tuple]) -> np.ndarray:
    """Sum of the path lengths of every row."""
    total = np.zeros(len(x))
    for a in range(0, len(x), SCORED_ROWS):
        part = np.ascontiguousarray(x[a:a + SCORED_ROWS].T)
        n, flat, out = part.shape[1], part.ravel(), total[a:a + SCORED_ROWS]
        rows = np.arange(n)
        for levels, feature, threshold, length in trees:
            lines, node = feature * n, np.zeros(n, np.intp)
            for _ in range(levels):
                right = ~(flat.take(lines.take(node) + rows) < threshold.take(node))
                node += node
                node += 1
                node += right
            out += length.take(node - len(feature))
    return total


def score(df: DataFrame, forest: DataFrame, features: list[str], keep: list[str],
          sample_size: int = 256) -> DataFrame:
    """Anomaly score 2^(-E[h(x)] / c(psi)) for every row (higher = more anomalous)."""
    pdf = forest.orderBy("tree_id", "node_id").toPandas()  # bounded: trees * (2 * psi - 1) rows
    trees = [_padded(*(g[c].to_numpy() for c in ("feature", "threshold", "left", "right", "size"))) for _, g in pdf.groupby("tree_id")]
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(trees)
    psi = min(sample_size, int(max(pdf["size"].max(), 1)))
    cn = c_factor(psi)
    out_schema = T.StructType([*[df.schema[k] for k in keep], T.StructField("anomaly_score", T.DoubleType())])

    def run(batches):
        forest_ = bc.value
        for b in batches:
            total = _lengths(b[features].astype(float).fillna(0.0).to_numpy(), forest_)
            res = b[keep].copy()
            res["anomaly_score"] = np.power(2.0, -(total / len(forest_)) / cn) if cn > 0 else 0.5
            yield res

    return df.select(*keep, *[c for c in features if c not in keep]).mapInPandas(run, out_schema)
