"""Shared helpers of the llm operators: folds, scratch tables, vectorised word hashing, connected components.

Python code of this package runs in Spark's Python workers; each module registers itself to be pickled by
value, so executors need no installed copy.
"""

from __future__ import annotations

import gc
import hashlib
import sys
import time
import types

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Code points that end a word in every contract of this package: space, and \t to \r.
SPACE_BYTES = b" \t\n\x0b\x0c\r"
#: Arrow batches are cut by rows; long texts make them large, so numpy work goes through slices of this many bytes.
SLICE_BYTES = 1 << 20
#: Rows per Arrow batch handed to Python: bounds a batch by rows times the longest text.
ARROW_ROWS = 1000
#: Rows of a few numbers that are worth a file of their own.
FILE_ROWS = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE_BYTES)] = True

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def fold(col: Column, parts: int) -> Column:
    """crc32 of the id's text, modulo ``parts`` (null ids: fold 0)."""
    return F.coalesce(F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(parts)), F.lit(0)).cast("int")


def small_batches(df: DataFrame) -> None:
    """Bound the Arrow batches that Python tasks of this session get (texts can be long)."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that survives lost executors."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few_files(df: DataFrame, rows: int, most: int = FILE_ROWS) -> DataFrame:
    """``df`` in a task per ``most`` of its ``rows`` (or whatever measures the work), or in as many as run at a time, where its shuffle has more.

    A small table is not a file for every partition: on local disks each file costs an executor processes to set its permissions.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // most)))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` begins with it."""
    while any(c.lower().startswith(name.lower()) for c in df.columns):
        name += "_"
    return name


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened by ``_`` while ``df`` has a column of that name (names differ in more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remembered(kind: str, spec: bytes, make):
    """``make(spec)``, built once per worker process: code sent by value gets new globals with every task, modules stay."""
    held = sys.modules.setdefault("riskframe_worker_memory", types.ModuleType("riskframe_worker_memory")).__dict__
    key = kind + hashlib.sha256(spec).hexdigest()
    if key not in held:
        held[key] = make(spec)
    return held[key]


def release(spark) -> None:
    """Let go of finished stages' shuffle files now (Spark's cleaner drops what the driver's garbage collector has found)."""
    for _ in range(2):  # the cleaner works on its own thread; what its first round frees can hold more
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def shuffle_parts(spark) -> int:
    """The session's number of shuffle partitions (the default parallelism where it is not a number)."""
    v = spark.conf.get("spark.sql.shuffle.partitions", "200")
    return max(1, int(v)) if v.isdigit() else max(1, spark.sparkContext.defaultParallelism)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        one = np.ones(1, np.uint64)
        _POWERS["up"] = np.concatenate([one, np.cumprod(np.full(size - 1, _BASE), dtype=np.uint64)])
        _POWERS["down"] = np.concatenate([one, np.cumprod(np.full(size - 1, _BASE_INV), dtype=np.uint64)])
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 constants)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary column without nulls."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    kind = np.int64 if str(column.type).startswith("large") else np.int32
    off = np.frombuffer(ends, kind, count=len(column) + 1, offset=column.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def text_slices(column):
    """Yield (first row, bytes, offsets) for runs of whole texts of about SLICE_BYTES (a longer text is a slice of its own)."""
    raw, off = text_bytes(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + SLICE_BYTES, side="right")) - 1)
        yield i, raw[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def word_hashes(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word in order, words before each text) after lower-casing A-Z.

    A word is a maximal run of bytes other than SPACE_BYTES inside one text. Hashes are differences of
    polynomial prefix sums modulo 2^64, so all words of a slice take a few array passes.
    """
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    inside = ~_IS_SPACE[raw]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
    return mix((total[e] - total[s]) * down[s]), np.searchsorted(s, off)


def shingle_hashes(words: np.ndarray, before: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of ``size``-word shingles, one array per text (fewer words: the whole sequence as one)."""
    out = []
    mult = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    total = np.zeros(len(words), np.uint64)
    if len(words) >= size:
        total = sum((words[j:len(words) - size + 1 + j] * mult[j] for j in range(size)), np.zeros(1, np.uint64))
        total = mix(total)
    for a, b in zip(before[:-1], before[1:]):
        if b - a >= size:
            g = np.sort(total[a:b - size + 1])
            out.append(g[np.concatenate([[True], g[1:] != g[:-1]])])
        elif b > a:
            out.append(mix((words[a:b] * mult[:b - a]).sum(keepdims=True) + np.uint64(b - a)))
        else:
            out.append(words[:0])
    return out


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected ``links``: (node, component), the smallest id that links reach.

    Alternating large-star and small-star steps (Kiveris et al., 2014): each is one group-by whose output is no
    larger than the links, the stars halve the paths, and every round is written to the shared folder, in files by its size. A node
    with very many neighbours is a group only in the sense of a ``min`` aggregate and a join on it, both of which
    Spark can split. Empty input gives an empty frame.
    """
    spark = links.sparkSession
    edges = (links.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u <> v").distinct())
    n = links.count()
    edges = stored(few_files(edges, n), "cc")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour of u goes to u's minimum
        large = both.join(low, "u").where("v > u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        # small star: a node and its smaller neighbours go to the smallest of them
        small = (large.join(low, "v").select(F.col("m").alias("p"), "u", "v")
                 .selectExpr("inline(array(struct(p, u as c), struct(p, v as c)))").where("p <> c").distinct()
                 .select(F.col("p").alias("u"), F.col("c").alias("v")))
        small = stored(few_files(small, n), "cc")
        now = tuple(small.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        edges, state = small, now
    return edges.groupBy("v").agg(F.min("u").alias("component")).withColumnRenamed("v", "node").unionByName(
        edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()) if state[0] else \
        spark.createDataFrame([], f"node {links.schema[a].dataType.simpleString()}, component {links.schema[a].dataType.simpleString()}")
