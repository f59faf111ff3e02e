"""Operator 5, language-model scoring: deleted interpolation of word n-grams.

A token's probability given the word before it is

    l2(b) * c(w1 w2) / c(w1) + l1(b) * c(w2) / N + l0(b) / (V + 1)

where c are counts of the training texts and b is the bucket of the context's count c(w1) (powers of two). The
weights of each bucket come from expectation-maximisation on held-out counts: every training token in turn is deleted
from the counts, and its probability is that of the counts without it.

How the counts move: each task turns its texts into blocks of at most about ``BLOCK_TOKENS`` tokens and counts the
block's distinct words and word pairs. The counts, keyed by hash, are dealt into buckets; one task per bucket adds
them up and answers every block with the totals of its words and pairs. So a word or pair travels once per
block that has it, however often it occurs there, and a frequent one is no hot key. The number of buckets grows with
the tokens, so a bucket's size does not. Words are told apart by 64-bit hashes, pairs by their bucket and 40 bits more
(about one pair in three million shares both with another).

Cases: a null text counts as empty; an empty text is its end token; null ids are in fold 0; repeated rows count as
often as they occur; without training texts all counts are 0 and every token gets 1 / (V + 1) = 1; an empty table
gives an empty result; other columns are not carried.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import fold, mix, release, shuffle_parts, small_batches, stored, text_slices, word_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_TOKENS = 1_000_000
#: Tokens for which one more bucket of counts is made.
BUCKET_TOKENS = 2_000_000
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
CONTEXTS = 24
PER_OCTAVE = 4
CELLS = 128  # bins of a probability: 0, then PER_OCTAVE per halving, from 1 downwards
ROUNDS = 40
BLOCK = "block long, doc_ids array<long>, trained array<boolean>, sizes array<int>, words binary, codes binary"


def _block(number: int, ids, trained, sizes, tokens) -> pa.RecordBatch:
    """One block row: its distinct words from the most frequent on, and every token as an index into them."""
    words, code, n = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    return pa.RecordBatch.from_arrays([
        pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([trained], pa.list_(pa.bool_())),
        pa.array([sizes], pa.list_(pa.int32())), pa.array([_packed(words[order])], pa.binary()),
        pa.array([_packed(rank[code])], pa.binary())], names=[c.split()[0] for c in BLOCK.split(", ")])


def _blocks(batches):
    number = TaskContext.get().partitionId() << 24
    ids, trained, sizes, tokens, held = [], [], [], [], 0
    for b in batches:
        rows, flags = b["doc_id"].to_pylist(), b["trained"].to_pylist()
        for first, raw, off in text_slices(b["text"]):
            words, before = word_hashes(raw, off)
            k = len(off) - 1
            ids += rows[first:first + k]
            trained += flags[first:first + k]
            sizes += (np.diff(before) + 1).tolist()
            tokens.append(np.insert(words, before[1:], END))
            held += len(tokens[-1])
            if held >= BLOCK_TOKENS:
                yield _block(number, ids, trained, sizes, tokens)
                number, ids, trained, sizes, tokens, held = number + 1, [], [], [], [], 0
    if ids:
        yield _block(number, ids, trained, sizes, tokens)


class Grams:
    """The distinct words and word pairs of a block, each with its count in the block's training texts."""

    def __init__(self, words, codes, sizes, trained):
        u = len(words)
        sizes = np.asarray(sizes, np.int64)
        prev = np.empty(len(codes), np.int64)
        prev[1:] = codes[:-1]
        prev[np.cumsum(sizes) - sizes] = u  # the start of a text
        self.prev, self.code, self.sizes = prev, codes, sizes
        learn = np.repeat(np.asarray(trained, bool), sizes)
        pairs, self.pair = np.unique(prev * (u + 1) + codes, return_inverse=True)
        self.local = [np.bincount(codes[learn], minlength=u), np.bincount(self.pair[learn], minlength=len(pairs))]
        known = np.append(words, START)
        self.keys = [words, mix(known[pairs // (u + 1)] * np.uint64(0x9E3779B97F4A7C15) + known[pairs % (u + 1)])]

    def buckets(self, n: int):
        """Yield (order, bucket, indices of its grams by the key that travels)."""
        for order, keys in enumerate(self.keys):
            bucket = ((keys >> np.uint64(40)) * np.uint64(n)) >> np.uint64(24)
            by = np.lexsort((keys & PAIR_MASK if order else keys, bucket))
            cut = np.searchsorted(bucket[by], np.arange(n + 1, dtype=np.uint64))
            for k in np.flatnonzero(np.diff(cut)).tolist():
                yield order, k, by[cut[k]:cut[k + 1]]


def _grams(row: dict) -> Grams:
    return Grams(_unpacked(row["words"]), _unpacked(row["codes"]), row["sizes"], row["trained"])


def _rows(b: pa.RecordBatch):
    for i in range(b.num_rows):
        yield b.slice(i, 1).to_pylist()[0]


def _packed(a: np.ndarray) -> bytes:
    """An integer array, compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T
    return len(a).to_bytes(8, "little") + a.dtype.str.encode() + pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes) -> np.ndarray:
    n, kind = int.from_bytes(raw[:8], "little"), np.dtype(raw[8:11].decode())
    data = pa.decompress(raw[11:], n * kind.itemsize, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(kind.itemsize, n).T).view(kind).ravel()


#: Bits that are kept of a pair's key, besides its bucket.
PAIR_MASK = np.uint64((1 << 40) - 1)


def _pack_keys(keys: np.ndarray, order: int) -> bytes:
    """Keys of one bucket, ascending: words whole, pairs as differences of their low bits."""
    if order == 0:
        return _packed(keys)
    keys = keys & PAIR_MASK
    gap = np.diff(keys, prepend=np.uint64(0))
    return _packed(gap.astype(np.uint32) if gap.max(initial=0) < 1 << 32 else gap)


def _unpack_keys(raw: bytes, order: int) -> np.ndarray:
    out = _unpacked(raw)
    return out if order == 0 else np.cumsum(out, dtype=np.uint64)


def _totals(blocks: DataFrame, n: int) -> DataFrame:
    """(block, bucket, ord, n): the totals of a block's grams in a bucket, in the order of their keys.

    A row with block -1 for each bucket has the number of distinct training words of that bucket.
    """
    def ask(batches):
        for b in batches:
            for row in _rows(b):
                g = _grams(row)
                out = [(order, k, _pack_keys(g.keys[order][at], order), _packed(g.local[order][at].astype(np.uint32))) for order, k, at in g.buckets(n)]
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array([row["block"]] * len(out), pa.int64()), pa.array(cols[0], pa.int32()),
                                                  pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())],
                                                 names=["block", "ord", "bucket", "keys", "counts"])

    def answer(table: pa.Table) -> pa.Table:
        bucket, out = table["bucket"][0].as_py(), []
        order = np.array(table["ord"].to_pylist())
        for o in (0, 1):
            rows = np.flatnonzero(order == o).tolist()
            keys = [_unpack_keys(table["keys"][i].as_py(), o) for i in rows]
            if not keys:
                continue
            own = [_unpacked(table["counts"][i].as_py()) for i in rows]
            distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(where, np.concatenate(own), len(distinct)).astype(np.uint32)
            if o == 0:
                out.append((-1, bucket, o, _packed(np.array([(total > 0).sum()], np.uint32))))
            cuts = np.cumsum([0, *map(len, keys)])
            out += [(table["block"][i].as_py(), bucket, o, _packed(total[where[a:b]])) for i, a, b in zip(rows, cuts, cuts[1:])]
        cols = list(zip(*out))
        return pa.table({"block": pa.array(cols[0], pa.int64()), "bucket": pa.array(cols[1], pa.int32()), "ord": pa.array(cols[2], pa.int32()),
                         "n": pa.array(cols[3], pa.binary())})

    asked = blocks.mapInArrow(ask, "block long, ord int, bucket int, keys binary, counts binary")
    return asked.groupBy("bucket").applyInArrow(answer, "block long, bucket int, ord int, n binary")


def _bin(p: np.ndarray) -> np.ndarray:
    """The bin of a probability: 0 for none, else 1 + PER_OCTAVE per halving."""
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.clip(1 + np.rint(-PER_OCTAVE * np.log2(p)), 1, CELLS - 1), 0).astype(np.int64)


def _context(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(count, 0) + 1).astype(np.int64), CONTEXTS - 1)


def _probabilities(g: Grams, one: np.ndarray, two: np.ndarray, end: int, total: int, deleted: int):
    """(context bucket, pair and word probability) per token; ``deleted``: 1 takes the token itself out of the counts."""
    context = np.append(one, end)[g.prev] - deleted
    c1, c2 = one[g.code] - deleted, two[g.pair] - deleted
    p2 = np.divide(c2, context, out=np.zeros(len(c2)), where=context > 0)
    return _context(context), np.maximum(p2, 0), np.maximum(c1, 0) / max(total - deleted, 1)


def _joined(blocks: DataFrame, totals: DataFrame, n: int, total: int) -> DataFrame:
    """Blocks with the totals of their words and pairs, and the histogram of deleted probabilities for the fit."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        for row in (left.slice(i, 1).to_pylist()[0] for i in range(left.num_rows)):
            g = _grams(row)
            counts = [np.zeros(len(k), np.int64) for k in g.keys]
            answers = {(o, k): i for i, (o, k) in enumerate(zip(right["ord"].to_pylist(), right["bucket"].to_pylist()))}
            for o, k, at in g.buckets(n):
                counts[o][at] = _unpacked(right["n"][answers[o, k]].as_py())
            words = _unpacked(row["words"])
            end = int(counts[0][words == END][0])
            b, p2, p1 = _probabilities(g, counts[0], counts[1], end, total, 1)
            learn = np.repeat(np.asarray(row["trained"], bool), g.sizes)
            cell, times = np.unique(((b * CELLS + _bin(p2)) * CELLS + _bin(p1))[learn], return_counts=True)
            rows.append((row["block"], row["doc_ids"], row["trained"], row["sizes"], row["codes"], end, _packed(counts[0].astype(np.uint32)),
                         _packed(counts[1].astype(np.uint32)), cell.tolist(), times.tolist()))
        cols = list(zip(*rows)) if rows else [[]] * 10
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.int64(), pa.binary(), pa.binary(),
                 pa.list_(pa.int32()), pa.list_(pa.int32())]
        names = ["block", "doc_ids", "trained", "sizes", "codes", "end", "one", "two", "cells", "times"]
        return pa.table({m: pa.array(c, t) for m, c, t in zip(names, cols, kinds)})

    return blocks.groupBy("block").cogroup(totals.where("block >= 0").groupBy("block")).applyInArrow(
        run, "block long, doc_ids array<long>, trained array<boolean>, sizes array<int>, codes binary, end long, one binary, two binary, "
             "cells array<int>, times array<int>")


def fit_weights(cells: np.ndarray, times: np.ndarray, distinct: int) -> np.ndarray:
    """Mixture weights (CONTEXTS x 3: pair, word, uniform) by expectation-maximisation on the histogram of cells."""
    b, bin2, bin1 = cells // CELLS ** 2, cells // CELLS % CELLS, cells % CELLS
    value = lambda k: np.where(k > 0, np.exp2(-(k - 1) / PER_OCTAVE), 0.0)
    p = np.column_stack([value(bin2), value(bin1), np.full(len(cells), 1.0 / (distinct + 1))])
    weights = np.full((CONTEXTS, 3), 1 / 3)
    for _ in range(ROUNDS if len(cells) else 0):
        share = weights[b] * p
        share *= (times / np.maximum(share.sum(axis=1), 1e-300))[:, None]
        got = np.column_stack([np.bincount(b, share[:, k], CONTEXTS) for k in range(3)])
        seen = got.sum(axis=1) > 0
        weights[seen] = got[seen] / got[seen].sum(axis=1, keepdims=True)
    weights = np.maximum(weights, [0.0, 0.0, 1e-9])
    return weights / weights.sum(axis=1, keepdims=True)


def score_corpus(df: DataFrame, trained: Column) -> DataFrame:
    """Scores of all texts (columns doc_id, text) by the model of the rows where ``trained`` holds.

    Returns doc_id, trained, n_tokens, n_known, train_tokens, base_score (add-half unigrams), score (the model), both
    log10 probabilities of the whole text.
    """
    small_batches(df)
    spark = df.sparkSession
    d = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(trained, F.lit(False)).alias("trained"),
                  F.coalesce("text", F.lit("")).alias("text"))
    blocks = stored(d.mapInArrow(_blocks, BLOCK), "lm-blocks")
    sums = blocks.select(F.expr("aggregate(sizes, 0L, (s, x) -> s + x)").alias("all"),
                         F.expr("aggregate(zip_with(sizes, trained, (x, t) -> IF(t, x, 0)), 0L, (s, x) -> s + x)").alias("own"))
    tokens, total = sums.agg(F.coalesce(F.sum("all"), F.lit(0)), F.coalesce(F.sum("own"), F.lit(0))).first()
    n = max(shuffle_parts(spark), tokens // BUCKET_TOKENS)
    totals = stored(_totals(blocks, n), "lm-totals")
    release(spark)
    distinct = sum(int(_unpacked(r["n"])[0]) for r in totals.where("block = -1").select("n").collect())  # one number a bucket
    ready = stored(_joined(blocks, totals, n, total), "lm-ready")
    release(spark)
    hist = ready.select(F.explode(F.arrays_zip("cells", "times")).alias("x")).groupBy("x.cells").agg(F.sum("x.times").alias("times"))
    got = hist.toPandas()  # at most CONTEXTS * CELLS ** 2 rows
    weights = fit_weights(got["cells"].to_numpy(np.int64), got["times"].to_numpy(float), distinct)

    def run(batches):
        for b in batches:
            for row in _rows(b):
                one, two = _unpacked(row["one"]).astype(np.int64), _unpacked(row["two"]).astype(np.int64)
                g = Grams(np.zeros(len(one), np.uint64), _unpacked(row["codes"]), row["sizes"], row["trained"])
                ctx, p2, p1 = _probabilities(g, one, two, row["end"], total, 0)
                w = weights[ctx]
                p = w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] / (distinct + 1)
                starts = np.cumsum(g.sizes) - g.sizes
                count = one[g.code]
                base = np.log10((count + 0.5) / (total + 0.5 * (distinct + 1)))
                per = lambda x: np.add.reduceat(x, starts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array(row["trained"], pa.bool_()), pa.array(g.sizes),
                    pa.array(per((count > 0).astype(np.int64))), pa.array(np.full(len(starts), total, np.int64)),
                    pa.array(per(base)), pa.array(per(np.log10(p)))],
                    names=["doc_id", "trained", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return ready.drop("cells", "times").mapInArrow(
        run, "doc_id long, trained boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op5(documents: DataFrame) -> DataFrame:
    """The digest of the contract: learned from all folds of 5 but number 1, every document scored."""
    out = score_corpus(documents, fold(F.col("doc_id"), 5) != 1)
    return out.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
