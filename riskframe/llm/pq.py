"""Operator 4, embedding near-dedup: product quantisation with coarse inverted lists and exact rerank.

Equal vectors are one vector with a count. Vectors of different lengths never link: each length has a quantiser and
lists of its own, in one pass over all. Centroids and residual codebooks are fitted on a bounded sample
(``MAX_SAMPLE`` vectors, by a hash of the id, and at least one of each length). Lists are about ``LIST_SIZE`` vectors long
whatever the number of vectors: beyond ``MAX_COARSE`` of them, each coarse centroid is refined by up to ``MAX_FINE`` second centroids, fitted on the
coarse residuals and shared by all. Every vector is put into the list of its nearest centroids, with
one code per subspace of its residual and the length of what the codes leave over. Every vector is also a query: it
probes the ``PROBES`` nearest lists (``FINE_PROBES`` where there are second centroids). There, distances come from lookup tables of the query against the codewords
(asymmetric); as the left-over length of each indexed vector is known, no vector within the distance is lost by the
codes, and the survivors are compared by exact cosine in double precision. Only the choice of lists is approximate
(tests measure the recall against brute force; the README has figures).

A link is found by one end's probes or by both. Rows carry the lists that they probe, so where a vector meets another that
does not probe its list, the link is counted for both ends at once, else each end counts it: ``n_links`` is symmetric.

A list and its queries are a bounded number of rows on even data, so work and shuffle follow the number of vectors; a hot list is
dealt in blocks, and so are its queries: no task holds more than one block of each. Vectors travel in the type that they came in.
A task returns counts per vector and a spanning forest of the links it found, never all pairs of a group.

Cases: null, zero and null or non-finite vectors and null ids link with nothing; copies link with each other and count as links; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import components, stored
from riskframe.operators.keys import broadcastable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_SAMPLE = 20_000
LIST_SIZE, MAX_COARSE, MAX_FINE = 256, 1024, 1024
PROBES, FINE_PROBES = 8, 32
#: Coarse centroids whose second centroids a query looks at.
COARSE_PROBES = 16
SUBSPACES, CODEWORDS = 8, 64
ROUNDS = 8
BLOCK_ROWS, BLOCK_QUERIES = 2048, 8192
COSINE = 0.95


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows of x to rows of c."""
    return np.maximum((x ** 2).sum(1)[:, None] + (c ** 2).sum(1)[None] - 2 * x @ c.T, 0)


def _least(d: np.ndarray, n: int) -> np.ndarray:
    """Columns of the n least values of each row."""
    n = min(n, d.shape[1])
    return np.argpartition(d, n - 1, axis=1)[:, :n]


def _kmeans(x: np.ndarray, k: int, rng) -> np.ndarray:
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        a = _nearest(x, c).argmin(1)
        n = np.bincount(a, minlength=len(c))
        s = np.zeros_like(c)
        np.add.at(s, a, x)
        c[n > 0] = s[n > 0] / n[n > 0, None]
    return c


class Quantizer:
    """Coarse centroids, second centroids of their residuals (one zero vector where a level is enough), and one codebook per subspace."""

    def __init__(self, sample: np.ndarray, lists: int):
        rng = np.random.default_rng(7)
        self.coarse = _kmeans(sample, min(lists, MAX_COARSE), rng)
        left = sample - self.coarse[_nearest(sample, self.coarse).argmin(1)]
        fine = min(-(-lists // MAX_COARSE), MAX_FINE)
        self.fine = _kmeans(left, fine, rng) if fine > 1 else np.zeros((1, sample.shape[1]))
        left = left - self.fine[_nearest(left, self.fine).argmin(1)]
        d = sample.shape[1]
        self.cuts = np.linspace(0, d, min(SUBSPACES, d) + 1).astype(int)
        self.books = [_kmeans(left[:, a:b], CODEWORDS, rng) for a, b in zip(self.cuts, self.cuts[1:])]

    def __len__(self) -> int:
        return len(self.coarse) * len(self.fine)

    def centre(self, at):
        """The point that residuals of a list count from."""
        return self.coarse[at // len(self.fine)] + self.fine[at % len(self.fine)]

    def index(self, x: np.ndarray):
        """(list, codes, length left over) of unit vectors."""
        first = _nearest(x, self.coarse).argmin(1)
        at = first * len(self.fine) + _nearest(x - self.coarse[first], self.fine).argmin(1)
        left = x - self.centre(at)
        codes = np.column_stack([_nearest(left[:, a:b], w).argmin(1) for a, b, w in zip(self.cuts, self.cuts[1:], self.books)])
        back = np.concatenate([w[codes[:, k]] for k, w in enumerate(self.books)], axis=1)
        return at, codes.astype(np.uint8), np.linalg.norm(left - back, axis=1)

    def probes(self, x: np.ndarray, n: int | None) -> np.ndarray:
        """The nearest lists of each row, its own first."""
        d, k = _nearest(x, self.coarse), len(self.fine)
        n = n or (PROBES if k == 1 else FINE_PROBES)
        if k == 1:
            return _least(d, n)
        first = _least(d, COARSE_PROBES)
        far = np.stack([_nearest(x - self.coarse[first[:, j]], self.fine) for j in range(first.shape[1])], axis=1)
        best = _least(far.reshape(len(x), -1), n)
        return np.take_along_axis(first, best // k, 1) * k + best % k

    def distances(self, x: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Distances of queries to the coded vectors of a list, by tables of the query against the codewords."""
        left, out = x - self.centre(at), np.zeros((len(x), len(codes)))
        for k, (a, b, w) in enumerate(zip(self.cuts, self.cuts[1:], self.books)):
            out += _nearest(left[:, a:b], w)[:, codes[:, k]]
        return np.sqrt(out)


class Quantizers:
    """One quantiser per vector length; lists are numbered through."""

    def __init__(self, sample: list, counts: dict[int, int]):
        by: dict[int, list] = {}
        for v in sample:
            by.setdefault(len(v), []).append(v)
        self.of, self.start, n = {}, [], 0
        for d in sorted(by):
            q = Quantizer(unit(pa.array(by[d])), int(max(1, counts[d] // LIST_SIZE)))
            self.of[d] = q, n
            self.start.append((n, q))
            n += len(q)

    def of_list(self, at: int) -> tuple[Quantizer, int]:
        """The quantiser that has a list, and the list's number in it."""
        n, q = self.start[bisect_right(self.start, at, key=lambda x: x[0]) - 1]
        return q, at - n

    def coded(self, column, probes: int | None):
        """(list, codes, length left over, lists to probe) of vectors of any fitted lengths."""
        sizes = np.array([len(v) for v in column])
        at, codes, left, near = np.zeros(len(sizes), np.int32), [b""] * len(sizes), np.zeros(len(sizes)), [[]] * len(sizes)
        for d in np.unique(sizes).tolist():
            (q, n), rows = self.of[d], np.flatnonzero(sizes == d)
            x = unit(column.take(pa.array(rows)))
            own, parts, left[rows] = q.index(x)
            at[rows] = own + n
            for i, c, p in zip(rows.tolist(), parts, (q.probes(x, probes) + n).tolist()):
                codes[i], near[i] = c.tobytes(), p
        return at, codes, left, near


def unit(column) -> np.ndarray:
    x = np.array(column.to_pylist(), np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the given links."""
    root: dict[int, int] = {}
    def find(v):
        while root.setdefault(v, v) != v:
            root[v] = root[root[v]]
            v = root[v]
        return v
    out = []
    for u, v in zip(a.tolist(), b.tolist()):
        p, q = find(u), find(v)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((u, v))
    return out


def _compare(quantizer, cosine: float):
    limit = np.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-6

    def run(key, index: pa.Table, queries: pa.Table) -> pa.Table:
        rows = []
        if index.num_rows and queries.num_rows:
            q, at = quantizer.value.of_list(key[0].as_py())
            codes = np.array([np.frombuffer(c, np.uint8) for c in index["codes"].to_pylist()])
            left, ids, times = index["left"].to_numpy(), index["id"].to_numpy(), index["times"].to_numpy()
            vectors, asked = unit(index["vector"]), unit(queries["vector"])
            who, own, asked_times = queries["id"].to_numpy(), queries["own"].to_numpy(), queries["times"].to_numpy()
            reach = index["probes"].combine_chunks()
            looks = np.unique(np.column_stack([np.repeat(np.arange(len(ids)), reach.value_lengths().to_numpy()), reach.flatten().to_numpy()]), axis=0)
            looks = looks[:, 0].astype(np.int64) << 32 | looks[:, 1]  # (row, list that it probes), sorted
            back = np.zeros(len(ids), np.int64)
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for s in range(0, len(who), 512):
                x = asked[s:s + 512]
                i, j = np.nonzero(q.distances(x, at, codes) <= limit + left[None])
                cos = np.einsum("ij,ij->i", x[i], vectors[j])
                ok = (cos >= cosine) & (who[s + i] != ids[j])
                i, j = i[ok], j[ok]
                n = np.bincount(i, times[j], len(x)).astype(np.int64)
                rows += [(int(who[s + k]), int(n[k]), None) for k in np.flatnonzero(n).tolist()]
                pair = j.astype(np.int64) << 32 | own[s + i]
                place = np.minimum(np.searchsorted(looks, pair), len(looks) - 1)
                alone = looks[place] != pair  # the other end does not ask in this one's list
                back += np.bincount(j[alone], asked_times[s + i[alone]], len(ids)).astype(np.int64)
                found.append((who[s + i], ids[j]))
            rows += [(int(ids[k]), int(back[k]), None) for k in np.flatnonzero(back).tolist()]
            if found:
                rows += [(u, 0, v) for u, v in _forest(*map(np.concatenate, zip(*found)))]
        cols = list(zip(*rows)) if rows else [[], [], []]
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("a", "n", "b"), cols)})

    return run


def valid(df: DataFrame, vec: str = "vector") -> DataFrame:
    """Rows with an id and a finite, non-zero vector."""
    return df.where(F.col("id").isNotNull() & F.col(vec).isNotNull()
                    & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(vec, lambda x: x != 0))


def near_duplicates(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE,
                    probes: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``df``."""
    spark = df.sparkSession
    kind = "float" if df.schema[vector].dataType.simpleString() == "array<float>" else "double"
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast(f"array<{kind}>").alias("vector"))
    classes = stored(valid(rows).groupBy("vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("times")), "pq-classes")
    sample = classes.orderBy(F.xxhash64("id"), "id").limit(MAX_SAMPLE).select("vector").toArrow()["vector"].to_pylist()
    if sample:
        # one row per length
        counts = {r["d"]: r["n"] for r in classes.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
        missing = sorted(set(counts) - {len(v) for v in sample})
        if missing:
            first = classes.where(F.size("vector").isin(missing)).groupBy(F.size("vector").alias("d")).agg(F.min("id").alias("id"))
            sample += [r["vector"] for r in classes.join(first.select("id"), "id", "left_semi").select("vector").collect()]
        shared = spark.sparkContext.broadcast(Quantizers(sample, counts))

        def coded(batches):
            for b in batches:
                at, codes, left, near = shared.value.coded(b["vector"], probes)
                yield pa.RecordBatch.from_arrays([b["id"], b["times"], b["vector"], pa.array(at, pa.int32()),
                                                  pa.array(codes, pa.binary()), pa.array(left), pa.array(near, pa.list_(pa.int32()))],
                                                 names=["id", "times", "vector", "at", "codes", "left", "probes"])

        index = stored(classes.select("id", "times", "vector").mapInArrow(
            coded, f"id long, times long, vector array<{kind}>, at int, codes binary, left double, probes array<int>"), "pq-index")
        asked = index.select(*[F.col(c).alias(c) for c in ("id", "times", "vector")], F.col("at").alias("own"), F.explode("probes").alias("at"))
        # lists too long for one block, or asked too often for one turn: few, as the rest of the lists share what is left
        size = stored(index.select("at", F.lit(1).alias("held"), F.lit(0).alias("wait"))
                      .unionByName(asked.select("at", F.lit(0).alias("held"), F.lit(1).alias("wait")))
                      .groupBy("at").agg(F.sum("held").alias("held"), F.sum("wait").alias("wait"))
                      .where((F.col("held") > BLOCK_ROWS) | (F.col("wait") > BLOCK_QUERIES))
                      .select("at", F.ceil(F.col("held") / BLOCK_ROWS).cast("int").alias("blocks"), F.ceil(F.col("wait") / BLOCK_QUERIES).cast("int").alias("turns")),
                      "pq-long")
        n_long = size.count()
        dealt = lambda x: (x.join(F.broadcast(size) if broadcastable(n_long) else size, "at", "left")
                           .withColumns({"blocks": F.greatest(F.coalesce("blocks", F.lit(1)), F.lit(1)), "turns": F.greatest(F.coalesce("turns", F.lit(1)), F.lit(1))}))
        part = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
        left = dealt(index).withColumn("block", part(F.col("blocks"))).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).drop("blocks", "turns")
        right = dealt(asked).withColumn("turn", part(F.col("turns"))).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks", "turns")
        out = stored(left.groupBy("at", "block", "turn").cogroup(right.groupBy("at", "block", "turn"))
                     .applyInArrow(_compare(shared, cosine), "a long, n long, b long"), "pq-links")
    else:
        out = spark.createDataFrame([], "a long, n long, b long")
    count = out.groupBy("a").agg(F.sum("n").alias("links"))
    parts = components(out.where("b IS NOT NULL").select("a", "b"))
    known = (classes.join(count, F.col("id") == F.col("a"), "left").join(parts, F.col("id") == F.col("node"), "left")
             .select(F.col("vector").alias("v"), (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
                     F.coalesce("component", "id").alias("component_id")))
    got = valid(rows).join(known, F.col("vector") == F.col("v")).select(F.col("id").alias("vec_id"), "n_links", "component_id")
    fine = F.col("id").isNotNull() & F.col("vector").isNotNull()
    rest = rows.join(classes.select(F.col("vector").alias("v")), F.col("vector") == F.col("v"), "left").where(~fine | F.col("v").isNull())
    rest = rest.select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return got.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op4(embeddings: DataFrame) -> DataFrame:
    """The digest of the contract: one row per vector."""
    return near_duplicates(embeddings)
