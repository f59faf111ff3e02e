"""Second-order boosted trees on histograms, depth-wise or leaf-wise (ML-02, ML-03).

Features are cut into quantile bins once, over all rows. Rows travel as blocks: one table row holds the bins, labels and
id hashes of up to ``BLOCK_ROWS`` rows, so a pass over the data is a few array operations per block. The bins of several
features lie together in one joint code (``Joint``, at most ``JOINT`` values), and a row's hessian and its count in one
number, so a pass counts two sums per joint code, not three per feature; a feature's own sums follow by adding up.

A tree grows best-first. The driver holds splits only; Spark adds up, for the leaves in question, gradient, hessian and row
counts per feature and bin. One pass serves all leaves that could be split next: the smaller child of each is counted,
its sibling follows by subtraction. Splits are then accepted in the order of their gains until the leaf limit
(leaf-wise: 31 leaves) or until the depth limit leaves none (depth-wise: then the order does not matter). Children that
were counted but not reached by that order are dropped, so the tree is the one that counting leaf by leaf would give,
in about as many passes as it has levels.

Gain is ``GL^2/(HL+r) + GR^2/(HR+r) - G^2/(H+r)`` (halved), a leaf's value ``-G/(H+r)`` times the rate. Gradients and
hessians are summed as whole numbers (units of ``1/SCALE``), so a sum does not depend on how rows are dealt, a lost
task counted again gives the same tree, and equal gains are settled alike: smaller feature, then smaller bin.

A child that can't be split any more needs no pass: its sums stand in its parent's histogram. A node whose rows take no more
bytes than its histogram travels as rows (``few_rows``); the driver counts its children, and nothing below it needs a pass.

Rows and columns are drawn per tree, rows by a hash of id, tree and seed. The first pass of a tree also brings the margins up
to date and keeps them with the gradients, so no pass applies earlier trees or computes gradients again; every ``REFRESH`` trees the margins are
checkpointed, as the blocks are before the first (``Binned``, which several fits on the same rows share). That
bounds what a lost task counts again and what a job carries. Sums of a pass are combined by feature chunk in Spark, unless they are few; what
comes to the driver is bounded by leaves x features x bins, or by COLLECT_BYTES.
"""

from __future__ import annotations

import heapq
import math
import pickle
import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.session import shared_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 1 << 24
BLOCK_ROWS = 4096
REFRESH = 20
CHUNK = 16
COLLECT_BYTES = 32 << 20
#: Rows that a task works on at a time, that are worth a task of their own, and that a task has at most.
HELD_ROWS, TASK_ROWS, FULL_ROWS = 1 << 19, 1 << 15, 1 << 22
#: Values of a joint code. Bit from which a packed sum counts rows; of PACKED_ROWS rows the hessians stay below it, and all of it is exact in a double.
JOINT, PACK, PACKED_ROWS = 4096, 37, (1 << 15) - 1
#: Accuracy of the quantile sketch: ranks are off by at most rows / SKETCH.
SKETCH = 10_000


@dataclass(frozen=True)
class Boosting:
    """Settings; ``max_leaves`` None grows depth-wise, ``max_depth`` None leaf-wise."""
    rounds: int = 100
    rate: float = 0.1
    regularisation: float = 1.0
    min_hessian: float = 1.0
    min_rows: int = 1
    max_depth: int | None = 6
    max_leaves: int | None = None
    row_share: float = 1.0
    column_share: float = 1.0
    bins: int = 64
    seed: int = 42


@dataclass
class Tree:
    """Flat arrays, root first: split feature (-1: leaf), bin and threshold (at most goes left), children, value."""
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def arrays(self) -> tuple:
        return self.feature, self.bin, self.left, self.right, self.value

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        """Leaf of each row of bin codes."""
        at = np.zeros(len(codes), np.int64)
        rows = np.arange(len(codes))
        while True:
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                return at
            go = codes[rows, np.maximum(f, 0)] <= self.bin[at]
            at = np.where(inner, np.where(go, self.left[at], self.right[at]), at)

    def leaf_rows(self, goes_left, rows: np.ndarray, wanted=None):
        """(leaf, its rows) of the wanted leaves, or of all; ``goes_left(node, rows)`` tells which rows do. Nothing is done for branches without rows or wanted leaves."""
        need = np.ones(len(self.feature), bool)
        if wanted is not None:
            need[:] = False
            need[list(wanted)] = True
            for x in range(len(need) - 1, -1, -1):    # children stand behind their parents
                if self.feature[x] >= 0:
                    need[x] = need[self.left[x]] or need[self.right[x]]
        todo = [(0, rows)] if need[0] else []
        while todo:
            x, rows = todo.pop()
            if not len(rows):
                continue
            if self.feature[x] < 0:
                yield x, rows
                continue
            go = goes_left(x, rows)
            if need[self.left[x]]:
                todo.append((self.left[x], rows.take(np.flatnonzero(go))))
            if need[self.right[x]]:
                todo.append((self.right[x], rows.take(np.flatnonzero(~go))))


@dataclass
class Model:
    """Trees over ``features``; ``edges[f]`` are the upper bounds of all bins of feature f but the last."""
    features: list[str]
    edges: list[np.ndarray]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Bins of raw rows (NaN: the last bin)."""
        out = np.empty(x.shape, np.uint8)
        for f, e in enumerate(self.edges):
            out[:, f] = np.searchsorted(e, x[:, f], side="left")
        return out

    def margins(self, codes: np.ndarray) -> np.ndarray:
        lines, rows, total = np.ascontiguousarray(codes.T), np.arange(len(codes)), np.zeros(len(codes))
        for t in self.trees:
            value = np.zeros(len(codes))
            for leaf, some in t.leaf_rows(lambda x, r, t=t: lines[t.feature[x]].take(r) <= t.bin[x], rows):
                value[some] = t.value[leaf]
            total = total + value
        return self.base + total


def _matrix(batch: pa.RecordBatch, features: list[str]) -> np.ndarray:
    cols = [batch[f].cast(pa.float64()).to_numpy(zero_copy_only=False) for f in features]
    return np.column_stack(cols) if cols else np.zeros((batch.num_rows, 0))


def quantile_edges(train: DataFrame, features: list[str], bins: int) -> list[np.ndarray]:
    """Distinct inner quantiles of every feature, in one aggregate. All hessians are equal before the first tree, so these are also the hessian-weighted ones."""
    at = [i / bins for i in range(1, bins)]
    # a float64 cast on both sides keeps edges and rows comparable
    row = train.agg(*[F.percentile_approx(F.col(f).cast("double"), at, SKETCH).alias(f"q{i}") for i, f in enumerate(features)]).first()
    return [np.unique(np.array([v for v in (row[i] or []) if v is not None], np.float64)) for i in range(len(features))]


class Joint:
    """Features put together into codes of at most JOINT values: ``groups[k]`` lists the features of code k."""

    def __init__(self, edges: list[np.ndarray]):
        self.sizes = [len(e) + 1 for e in edges]
        self.groups, self.values = [], []
        self.group, self.stride = [0] * len(edges), [1] * len(edges)
        for f in sorted(range(len(edges)), key=lambda f: -self.sizes[f]):
            k = next((k for k, v in enumerate(self.values) if v * self.sizes[f] <= JOINT), len(self.values))
            if k == len(self.values):
                self.groups.append([])
                self.values.append(1)
            self.group[f], self.stride[f] = k, self.values[k]
            self.groups[k].append(f)
            self.values[k] *= self.sizes[f]

    def joined(self, codes: np.ndarray) -> np.ndarray:
        """A line of joint codes per group, from a row of bins per table row."""
        out = np.zeros((len(self.groups), len(codes)), np.uint16)
        for f, (k, stride) in enumerate(zip(self.group, self.stride)):
            out[k] += codes[:, f].astype(np.uint16) * np.uint16(stride)
        return out

    def bins(self, f: int) -> np.ndarray:
        """The feature's bin in every value of its code."""
        return np.arange(self.values[self.group[f]]) // self.stride[f] % self.sizes[f]

    def left(self, tree: Tree, codes: np.ndarray):
        """For Tree.leaf_rows: which rows go left at a node."""
        tables: dict = {}

        def go(x, rows):
            f = tree.feature[x]
            if x not in tables:
                tables[x] = self.bins(f) <= tree.bin[x]
            return tables[x].take(codes[self.group[f]].take(rows))
        return go


BLOCK_SCHEMA = "ids binary, codes binary, labels binary"


def _blocks(train: DataFrame, model: Model, joint: Joint, label: str, id_col: str) -> DataFrame:
    features = model.features

    def run(batches):
        for b in batches:
            for s in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(s, BLOCK_ROWS)
                codes = joint.joined(model.codes(_matrix(part, features)))
                ids = part["__id"].to_numpy().astype(np.int64)
                y = part["__y"].to_numpy(zero_copy_only=False).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (ids, codes, y)], names=["ids", "codes", "labels"])

    rows = train.select(F.xxhash64(id_col).alias("__id"), F.col(label).cast("int").alias("__y"), *[F.col(f).cast("double").alias(f) for f in features])
    return rows.mapInArrow(run, BLOCK_SCHEMA)


def drawn(ids: np.ndarray, tree: int, seed: int, share: float) -> np.ndarray:
    """Rows that take part in a tree: a hash of id, tree and seed below the share."""
    if share >= 1:
        return np.ones(len(ids), bool)
    h = ids.astype(np.uint64) ^ np.uint64((tree * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03) & (1 << 64) - 1)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(31))) < np.uint64(min(int(share * 2.0 ** 64), (1 << 64) - 1))


def gradients(margins: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the logistic loss in whole units of 1/SCALE."""
    p = 1 / (1 + np.exp(-margins))
    return np.rint((p - labels) * SCALE), np.rint(p * (1 - p) * SCALE)


def histogram(codes: np.ndarray, slot: np.ndarray, g: np.ndarray, h: np.ndarray, slots: int, bins: int) -> np.ndarray:
    """(slot, feature, bin, [gradient, hessian, rows]) sums of the rows with a slot."""
    use = slot >= 0
    codes, slot, g, h = codes[use], slot[use], g[use], h[use]
    n, width = codes.shape
    at = ((slot[:, None] * width + np.arange(width)) * bins + codes).ravel()
    size = slots * width * bins
    out = [np.bincount(at, np.repeat(w, width), size) for w in (g, h)] + [np.bincount(at, minlength=size)]
    return np.stack(out, -1).astype(np.int64).reshape(slots, width, bins, 3)


def _held(blocks, groups: int):
    """The blocks of a task put together: (joint codes, ids, labels) of up to HELD_ROWS rows or a block more."""
    parts, n = [], 0

    def together():
        codes, ids, labels = zip(*parts)
        return np.concatenate(codes, axis=1), np.concatenate(ids), np.concatenate(labels)

    for ids, codes, labels in blocks:
        parts.append((np.frombuffer(codes, np.uint16).reshape(groups, -1), np.frombuffer(ids, np.int64), np.frombuffer(labels, np.uint8)))
        n += len(parts[-1][1])
        if n >= HELD_ROWS:
            yield together()
            parts, n = [], 0
    if parts:
        yield together()


def _remote(code, name: str, *args):
    """A function of tasks that carries its arguments only: the functions themselves went out once, in the broadcast ``code``.

    With its classes, a function pickled by value takes tens of milliseconds and kilobytes, and a job carries those of all trees since the last checkpoint.
    """
    def run(x):
        if not hasattr(code, "functions"):
            code.functions = pickle.loads(code.value)
        return code.functions[name](x, *args)

    return run


def _kept(rdd: RDD) -> RDD:
    """Kept as bytes that need no unpacking, one element to a batch, so that such RDDs can be zipped as they are."""
    return rdd._reserialize(BatchedSerializer(CPickleSerializer(), 1)).persist(StorageLevel.MEMORY_AND_DISK_DESER)


def _state(margins: np.ndarray, ids: np.ndarray, labels: np.ndarray, number: int, seed: int, share: float) -> tuple:
    """(margins, gradients, hessians) before a tree; rows that are not drawn have a hessian of -1."""
    g, h = gradients(margins, labels)
    if share < 1:
        h = np.where(drawn(ids, number, seed, share), h, -1)
    return margins, g.astype(np.int32), h.astype(np.int32)


def _start(x: tuple, base: float, *draw) -> tuple:
    return _state(np.full(len(x[0]), base), *x, *draw)


def _move(x: tuple, joint: Joint, tree: tuple, *draw) -> tuple:
    (codes, (ids, labels)), (margins, _, _) = x
    margins, tree = margins.copy(), Tree(*tree)
    for leaf, rows in tree.leaf_rows(joint.left(tree, codes), np.arange(len(ids))):
        margins[rows] += tree.value[leaf]
    return _state(margins, ids, labels, *draw)


class Binned:
    """The labeled rows of fits with the same bins: edges, base rate, and blocks of joint codes (``codes``), ids and labels (``rest``) in Spark."""

    def __init__(self, train: DataFrame, features: list[str], label: str, id_col: str, bins: int = 64):
        if not 2 <= bins <= 256:
            raise ValueError("bins must lie between 2 and 256")
        spark = train.sparkSession
        train = train.where(F.col(label).isNotNull())
        n, positive = train.agg(F.count(F.lit(1)), F.sum(F.col(label).cast("int"))).first()
        share = min(max((positive or 0) / max(n, 1), 1e-6), 1 - 1e-6)
        self.bins, self.rows, self.features, self.base = bins, n, list(features), math.log(share / (1 - share))
        self.edges = [np.zeros(0)] * len(features)
        if not n or not features:
            return
        most = max(spark.sparkContext.defaultParallelism, -(-n // FULL_ROWS))
        self.edges = quantile_edges(train.coalesce(most), features, bins)   # one task merges the sketches of all
        self.joint = joint = Joint(self.edges)
        rows = _blocks(train, self.model(), joint, label, id_col).rdd.map(tuple)
        self.tasks = min(rows.getNumPartitions(), most, -(-n // TASK_ROWS))
        groups = len(joint.groups)
        both = rows.coalesce(self.tasks).mapPartitions(lambda blocks: _held(blocks, groups)).persist(StorageLevel.DISK_ONLY)
        shared_dir(spark)
        both.checkpoint()
        both.count()
        both.unpersist()
        self.codes, self.rest = _kept(both.map(lambda x: x[0])), _kept(both.map(lambda x: x[1:]))
        move, count = (lambda x, *a, f=f: f(x, joint, *a) for f in (_move, _count))
        self.code = spark.sparkContext.broadcast(cloudpickle.dumps({"start": _start, "move": move, "count": count}))

    def model(self) -> Model:
        return Model(list(self.features), self.edges, self.base)

    def release(self) -> None:
        if self.rows and self.features:
            self.codes.unpersist()
            self.rest.unpersist()
            self.code.unpersist()

    def before(self, number: int, s: Boosting, trees: list[Tree], last: RDD | None) -> RDD:
        """The state of the rows before a tree, from that before the last one; the margins of rows that were not drawn follow too."""
        draw = number, s.seed, s.row_share
        if last is None:
            return _kept(self.rest.map(_remote(self.code, "start", self.base, *draw)))
        return _kept(self.codes.zip(self.rest).zip(last).map(_remote(self.code, "move", trees[-1].arrays(), *draw)))


def few_rows(columns: int, s: Boosting) -> int:
    """Rows that take no more bytes than a histogram: a code per column and two 32-bit sums, against three 64-bit sums per column and bin."""
    return columns * s.bins * 24 // (columns + 8)


def _joined(a, b):
    """Histograms add up, rows are put together."""
    return np.add(a, b) if isinstance(a, np.ndarray) else tuple(np.concatenate(x, axis=-1) for x in zip(a, b))


def _add(sums: list[tuple], codes: np.ndarray, groups: list[int], rows: np.ndarray, g: np.ndarray, h: np.ndarray) -> None:
    """Add rows to the (gradient, hessian, count) sums of every joint code in ``groups``."""
    for a in range(0, len(rows), PACKED_ROWS):
        some = rows[a:a + PACKED_ROWS]
        gs, packed = g.take(some).astype(np.float64), h.take(some) + float(1 << PACK)
        for k, (sum_g, sum_h, count) in zip(groups, sums):
            c = codes[k].take(some).astype(np.intp)
            sum_g += np.bincount(c, gs, len(sum_g))
            both = np.bincount(c, packed, len(sum_g)).astype(np.int64)
            sum_h += both & ((1 << PACK) - 1)
            count += both >> PACK


def _count(parts, joint: Joint, columns: list[int], route: tuple, slots: dict[int, int], whole: dict[int, int], bins: int) -> list[tuple]:
    """What a task of a pass gives: (feature chunk, sums of the nodes in ``slots``), and (its number, rows) of those in ``whole``."""
    groups, n, route = sorted({joint.group[f] for f in columns}), len(slots), Tree(*route)
    sums = [[tuple(np.zeros(joint.values[k], t) for t in (np.float64, np.int64, np.int64)) for k in groups] for _ in range(n)]
    few, of = [], {f: joint.bins(f) for f in columns}
    for codes, (_, g, h) in parts:
        for leaf, rows in route.leaf_rows(joint.left(route, codes), np.flatnonzero(h >= 0), {*slots, *whole}):
            if leaf in slots:
                _add(sums[slots[leaf]], codes, groups, rows, g, h)
            else:
                own = np.array([of[f].take(codes[joint.group[f]].take(rows)) for f in columns], np.uint8).reshape(len(columns), -1)
                few.append((~whole[leaf], (own, g.take(rows), h.take(rows))))
    total = np.zeros((n, len(columns), bins, 3), np.int64)
    for i in range(n):
        for j, f in enumerate(columns):
            for t, x in enumerate(sums[i][groups.index(joint.group[f])]):
                total[i, j, :, t] = np.bincount(of[f], x, bins)
    return [(c // CHUNK, total[:, c:c + CHUNK]) for c in range(0, max(1, len(columns)), CHUNK) if n] + few


def _counted(held: RDD, data: Binned, columns: np.ndarray, route: Tree, slots: dict[int, int], whole: dict[int, int], number: int,
             s: Boosting) -> tuple[np.ndarray, list[tuple]]:
    """One pass: the histogram of every node in ``slots`` and the rows (codes, gradients, hessians) of every node in ``whole``, over the drawn rows and columns.

    ``held`` are the rows with their state before tree ``number``. The sums of all tasks are added up by Spark, or on the driver where all of them are under COLLECT_BYTES.
    """
    n, bins, chunks = len(slots), s.bins, max(1, -(-len(columns) // CHUNK))
    sums = held.mapPartitions(_remote(data.code, "count", columns.tolist(), route.arrays(), slots, whole, bins))
    if data.tasks * n * len(columns) * bins * 24 > COLLECT_BYTES:
        sums = sums.reduceByKey(_joined, min(chunks, data.tasks))
    parts: dict = {}
    for c, x in sums.collect():
        parts[c] = _joined(parts[c], x) if c in parts else x
    none = (np.zeros((len(columns), 0), np.uint8), np.zeros(0, np.int32), np.zeros(0, np.int32))
    return np.concatenate([parts[c] for c in range(chunks)], axis=1) if n else [], [parts.get(~k, none) for k in range(len(whole))]


def best_split(hist: np.ndarray, s: Boosting) -> tuple[float, int, int]:
    """(gain, column, bin) of the best split of a node's histogram; the gain is 0 where none is allowed."""
    left = hist.cumsum(1)[:, :-1].astype(np.float64)
    if not left.size:
        return 0.0, 0, 0
    all_ = hist[0].sum(0).astype(np.float64)
    gl, hl, nl = left[..., 0] / SCALE, left[..., 1] / SCALE, left[..., 2]
    g, h, n = all_[0] / SCALE, all_[1] / SCALE, all_[2]
    gr, hr, nr = g - gl, h - hl, n - nl
    ok = (nl >= max(1, s.min_rows)) & (nr >= max(1, s.min_rows)) & (hl >= s.min_hessian) & (hr >= s.min_hessian)
    score = lambda a, b: a * a / np.maximum(b + s.regularisation, 1e-16)
    gain = np.where(ok, (score(gl, hl) + score(gr, hr) - score(np.float64(g), np.float64(h))) / 2, -np.inf)
    gain = np.round(gain, 9)
    k = int(gain.argmax())
    f, b = divmod(k, gain.shape[1])
    return (float(gain[f, b]), f, b) if gain[f, b] > 0 else (0.0, 0, 0)


class _Growing:
    """A tree under construction: counted nodes, tentative splits and the accepted ones."""

    def __init__(self, columns: np.ndarray, s: Boosting):
        self.columns, self.s = columns, s
        self.hist: dict[int, np.ndarray] = {}
        self.best: dict[int, tuple[float, int, int]] = {}
        self.kids: dict[int, tuple[int, int]] = {}
        self.parent: dict[int, int] = {}
        self.depth = {0: 0}
        self.rows: dict[int, tuple] = {}

    def counted(self, node: int, hist: np.ndarray) -> None:
        self.hist[node], self.best[node] = hist, best_split(hist, self.s)
        if self.s.max_depth is not None and self.depth[node] >= self.s.max_depth:
            self.best[node] = (0.0, 0, 0)

    def held(self, node: int, rows: tuple) -> None:
        """A node of which the rows are here."""
        codes, g, h = self.rows[node] = rows
        self.counted(node, histogram(codes.T, np.zeros(len(g), np.int64), g, h, 1, self.s.bins)[0])

    def route(self, inner: set[int] | None = None) -> tuple[Tree, dict[int, int]]:
        """The tree of the split nodes (all tentative ones, or the accepted), and the places of nodes in it."""
        order, place = [0], {0: 0}
        for node in order:
            if node in self.kids and (inner is None or node in inner):
                for k in self.kids[node]:
                    place[k] = len(order)
                    order.append(k)
        n = len(order)
        t = Tree(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n))
        for node in order:
            i = place[node]
            if node in self.kids and (inner is None or node in inner):
                _, f, t.bin[i] = self.best[node]
                t.feature[i] = self.columns[f]
                t.left[i], t.right[i] = (place[k] for k in self.kids[node])
            else:
                g, h = self.hist[node][0].sum(0)[:2] / SCALE if node in self.hist else (0.0, 0.0)
                t.value[i] = -g / (h + self.s.regularisation) * self.s.rate if h + self.s.regularisation > 0 else 0.0
        return t, place

    def grow(self, count) -> Tree:
        """``count(growing, nodes, whole)`` gives the histograms of ``nodes`` and the rows of ``whole``."""
        self.counted(0, count(self, [0], [])[0][0])
        limit = self.s.max_leaves or math.inf
        accepted: set[int] = set()
        heap = [(-self.best[0][0], 0)]
        while heap and len(accepted) + 1 < limit:
            gain, node = heapq.heappop(heap)
            if gain >= 0:
                break
            leaves, room = [node, *(x for _, x in sorted(heap))], limit - len(accepted) - 1
            if node not in self.kids:
                self._split(leaves, room)
            if self.kids[node][0] not in self.hist:
                self._count_children(leaves, room, count)
            accepted.add(node)
            for k in self.kids[node]:
                heapq.heappush(heap, (-self.best[k][0], k))
        return self.route(accepted)[0]

    def _split(self, leaves: list[int], room: float) -> None:
        """Split the leaves that could be next, tentatively."""
        todo = [x for x in leaves if x not in self.kids and self.best[x][0] > 0]
        for x in todo[:int(min(room, len(todo)))]:
            a = 1 + 2 * len(self.kids)
            self.kids[x] = (a, a + 1)
            self.parent[a] = self.parent[a + 1] = x
            self.depth[a] = self.depth[a + 1] = self.depth[x] + 1

    def _count_children(self, leaves: list[int], room: float, count) -> None:
        """Count the children of the first leaf: from its own histogram or rows, or in a pass, with those of the others that need one."""
        last = lambda x: room == 1 or self.depth[x] + 1 == self.s.max_depth
        x = leaves[0]
        _, f, b = self.best[x]
        if last(x):
            left, all_ = self.hist[x][f, :b + 1].sum(0), self.hist[x][f].sum(0)
            for k, sums in zip(self.kids[x], (left, all_ - left)):
                self.hist[k], self.best[k] = sums.reshape(1, 1, 3), (0.0, 0, 0)
            return
        if x in self.rows:
            codes, g, h = self.rows[x]
            left = codes[f] <= b
            for k, side in zip(self.kids[x], (left, ~left)):
                self.held(k, (codes[:, side], g[side], h[side]))
            return
        todo = [x for x in leaves if x in self.kids and self.kids[x][0] not in self.hist and x not in self.rows and not last(x)]
        todo = todo[:int(min(room, len(todo)))]
        small = {}
        for x in todo:
            _, f, b = self.best[x]
            n_left = self.hist[x][f, :b + 1, 2].sum()
            small[x] = 0 if 2 * n_left <= self.hist[x][f, :, 2].sum() else 1
        most = few_rows(len(self.columns), self.s)
        whole = [x for x in todo if self.hist[x][0, :, 2].sum() <= most]
        todo = [x for x in todo if x not in whole]
        kids = [k for x in whole for k in self.kids[x]]
        got, rows = count(self, [self.kids[x][small[x]] for x in todo], kids)
        for k, x in zip(kids, rows):
            self.held(k, x)
        for x, hist in zip(todo, got):
            k = self.kids[x]
            self.counted(k[small[x]], hist)
            self.counted(k[1 - small[x]], self.hist[x] - hist)


def columns_of(tree: int, width: int, s: Boosting) -> np.ndarray:
    """The columns drawn for a tree."""
    n = max(1, int(round(s.column_share * width))) if width else 0
    return np.sort(np.random.default_rng([s.seed, tree]).permutation(width)[:n])


def fit(train: DataFrame, features: list[str], label: str, id_col: str, settings: Boosting = Boosting(), binned: Binned | None = None) -> Model:
    """Boosted trees for a 0/1 label (rows without a label don't take part; without rows or features the model is the base rate).

    ``binned``: the same rows and features, prepared once for several fits; the caller releases it.
    """
    data = binned or Binned(train, features, label, id_col, settings.bins)
    if data.bins != settings.bins or data.features != list(features):
        raise ValueError("the rows were prepared for other bins or features")
    model, width, held = data.model(), len(features), None
    for number in range(settings.rounds if data.rows and width else 0):
        columns = columns_of(number, width, settings)

        def count(growing, nodes, whole):
            route, place = growing.route(set(growing.kids) - set(growing.rows))
            slots, few = ({place[x]: k for k, x in enumerate(some)} for some in (nodes, whole))
            return _counted(both, data, columns, route, slots, few, number, settings)

        last, held = held, data.before(number, settings, model.trees, held)
        both = data.codes.zip(held)
        if number and number % REFRESH == 0:
            held.checkpoint()
        model.trees.append(_Growing(columns, settings).grow(count))
        if last is not None:
            last.unpersist()
    if held is not None:
        held.unpersist()
    if binned is None:
        data.release()
    return model


def predict(df: DataFrame, model: Model, keep: list[str], name: str = "probability") -> DataFrame:
    """The ``keep`` columns plus the probability of label 1 (the model goes to every task: trees x leaves nodes)."""
    shared = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))  # with its class: workers need no installed package
    inner = [f"__x{i}" for i in range(len(model.features))]

    def run(batches):
        m = pickle.loads(shared.value)
        for b in batches:
            p = 1 / (1 + np.exp(-m.margins(m.codes(_matrix(b, inner)))))
            yield pa.RecordBatch.from_arrays([*[b[f"__k{i}"] for i in range(len(keep))], pa.array(p)], names=[*keep, name])

    schema = ", ".join([*[f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep], f"{name} double"])
    return df.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)],
                     *[F.col(f).cast("double").alias(x) for f, x in zip(model.features, inner)]).mapInArrow(run, schema)
