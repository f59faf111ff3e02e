"""Operator 2, n-gram Jaccard join: prefix lists bounded by position, answers derived from a similar set's answers.

A text's set is its distinct five-word shingles. Two sets link when 100 * |a & b| >= 80 * |a | b|. The join is exact:

1. One pass gives every text its set's size and signature and, per block of texts, the shingles that several of them
   have. Texts with equal sets are one set from here on, known by its signature.
2. All shingles have one global order: rare before frequent, then by hash. The counts behind it are those of step 1
   and, over all texts, those of each set's shingles of lowest hash, which are its prefix as long as none is frequent;
   the table of frequent ones is bounded and only orders. Linked sets share a shingle among the first n - ceil(0.8 n) + 1 of each (the prefix). The
   prefixes go to inverted lists, dealt by hash. Of a long list only one block, that of low positions, is read: a set
   probes it in two size classes and reads every posting there; further blocks by position are not skipped.
3. Short lists give all their pairs; a long list first gives the pairs with its centre only, the set that holds the
   shingle at the lowest position. Exact overlaps of these pairs give links and first components.
4. In long lists only pairs of sets of different components are left. Their overlap is first bounded by the overlaps
   that both already have with a common centre (the computed answers of a similar set); pairs that the bounds don't
   settle are compared.

Nothing is lost: every pair that shares a prefix shingle is settled by its overlap, by a bound on it, or by lying in
one component already.

Cases: null and empty texts and texts without words have an empty set and are linked with nothing; fewer than five
words are one shingle; texts with equal sets are linked; rows with one id are one document each, in the component of
their own set; rows without an id don't lend their id and have their set's component, null where no row with an id
has that set; an empty table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import (components, few_files, mix, release, shingle_hashes, shuffle_parts, small_batches, stored, text_slices,
                                  unused, word_hashes)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 5
PERCENT = 80
#: Shingles of a block (memory of a task), and postings of a bucket of lists.
BLOCK_SHINGLES = 500_000
BUCKET_POSTINGS = 250_000
#: Shingles of the sets that a task compares (64 MB of hashes).
COMPARED_SHINGLES = 8_000_000
#: Lists up to this length give all their pairs.
SHORT_LIST = 24
#: Shingles in at least this many texts are ordered last; a hint that is bounded by MAX_FREQUENT and changes no result.
FREQUENT, MAX_FREQUENT = 12, 500_000


def need(a, b):
    """Least overlap of linked sets of sizes a and b."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def signature(g: np.ndarray) -> int:
    """A set's signature: an order-free 64-bit hash of its shingles."""
    return int(mix(mix(g).sum(keepdims=True) + np.uint64(len(g)))[0].view(np.int64))


def _sets(batches):
    """Yield (ids, sets) of runs of about BLOCK_SHINGLES shingles."""
    ids, sets, held = [], [], 0
    for b in batches:
        rows = b["doc_id"].to_pylist()
        for first, raw, off in text_slices(b["text"]):
            words, before = word_hashes(raw, off)
            got = shingle_hashes(words, before, WORDS)
            ids += rows[first:first + len(got)]
            sets += got
            held += sum(map(len, got))
            if held >= BLOCK_SHINGLES:
                yield ids, sets
                ids, sets, held = [], [], 0
    if ids:
        yield ids, sets


def _survey(batches):
    for ids, sets in _sets(batches):
        sigs = [signature(g) for g in sets]
        one = {s: k for k, s in enumerate(sigs)}  # equal sets count once
        keys, n = np.unique(np.concatenate([sets[k] for k in one.values()]), return_counts=True)
        often = n > 1
        yield pa.RecordBatch.from_arrays([
            pa.array([ids], pa.list_(pa.int64())), pa.array([[len(g) for g in sets]], pa.list_(pa.int64())),
            pa.array([sigs], pa.list_(pa.int64())), pa.array([keys[often].view(np.int64)], pa.list_(pa.int64())),
            pa.array([n[often]], pa.list_(pa.int64()))], names=["ids", "sizes", "sigs", "keys", "counts"])


def prefix(g: np.ndarray, often: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The prefix of a set in the global order; ``often`` are the frequent shingles (sorted), ``rank`` their order."""
    k = len(g) - (-(-PERCENT * len(g) // 100)) + 1
    if len(often):
        at = np.minimum(np.searchsorted(often, g), len(often) - 1)
        common = often[at] == g
        rare = g[~common]
        if len(rare) < k:
            last = at[common]
            return np.concatenate([rare, often[last[np.argsort(rank[last], kind="stable")][:k - len(rare)]]])
        return rare[:k]
    return g[:k]


def _postings(often_rank, buckets: int):
    def run(batches):
        often, rank = often_rank.value
        for _, sets in _sets(batches):
            one = {}
            for g in sets:
                if len(g):
                    one.setdefault(signature(g), g)
            if not one:
                continue
            heads = [prefix(g, often, rank) for g in one.values()]
            size = np.fromiter(map(len, heads), np.int64, len(heads))
            key = np.concatenate(heads)
            sig = np.repeat(np.fromiter(one, np.int64, len(one)), size)
            n = np.repeat(np.fromiter(map(len, one.values()), np.int64, len(one)), size).astype(np.int32)
            pos = (np.arange(len(key)) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32)
            by = np.argsort(key, kind="stable")
            key, sig, n, pos = key[by], sig[by], n[by], pos[by]
            cut = np.searchsorted((key >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24), np.arange(buckets + 1, dtype=np.uint64))
            full = np.flatnonzero(np.diff(cut)).tolist()
            cols = [[x[cut[k]:cut[k + 1]].tobytes() for k in full] for x in (key, sig, n, pos)]
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *(pa.array(c, pa.binary()) for c in cols)],
                                             names=["bucket", "key", "sig", "n", "pos"])

    return run


def fits(n1, p1, n2, p2):
    """Whether sets of these sizes that share the shingle at these positions (0-based) can link."""
    return np.minimum(n1 - p1, n2 - p2) >= need(n1, n2)


def _candidates(table: pa.Table) -> pa.Table:
    """Pairs of one bucket's lists: (a, b, pa, pb, na, nb, key null) and the postings of its long lists."""
    load = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in table[c].to_pylist()])
    key, sig, n, pos = load("key", np.uint64), load("sig", np.int64), load("n", np.int32).astype(np.int64), load("pos", np.int32).astype(np.int64)
    by = np.lexsort((sig, n, pos, key))
    key, sig, n, pos = key[by], sig[by], n[by], pos[by]
    keep = np.concatenate([[True], (key[1:] != key[:-1]) | (sig[1:] != sig[:-1])])  # one set from several blocks
    key, sig, n, pos = key[keep], sig[keep], n[keep], pos[keep]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(start, len(key)))
    owner = np.repeat(np.arange(len(start)), size)
    place = np.arange(len(key)) - start[owner]
    left, right = [], []
    for d in range(1, SHORT_LIST):  # short lists: every pair at distance d
        i = np.flatnonzero((place >= d) & (size[owner] <= SHORT_LIST))
        if not len(i):
            break
        left.append(i - d)
        right.append(i)
    long = size[owner] > SHORT_LIST
    i = np.flatnonzero(long & (place > 0))
    left.append(start[owner[i]])  # the centre: the lowest position of the list
    right.append(i)
    i, j = np.concatenate(left), np.concatenate(right)
    ok = fits(n[i], pos[i], n[j], pos[j])
    i, j = i[ok], j[ok]
    swap = sig[i] > sig[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    k = np.flatnonzero(long)
    none = pa.nulls(len(i), pa.int64())
    pairs = pa.table({"key": none, "a": sig[i], "b": sig[j], "na": n[i], "nb": n[j], "pa": pos[i], "pb": pos[j]})
    zero = np.zeros(len(k), np.int64)
    lists = pa.table({"key": key[k].view(np.int64), "a": sig[k], "b": zero, "na": n[k], "nb": zero, "pa": pos[k], "pb": zero})
    return pa.concat_tables([pairs, lists])


def _lowest(buckets: int):
    """Rows (bucket, keys, counts) of the shingles of lowest hash of every set, one and a half prefixes of each."""
    def run(batches):
        for _, sets in _sets(batches):
            one = {signature(g): g for g in sets if len(g)}
            if not one:
                continue
            key, n = np.unique(np.concatenate([g[:3 * (len(g) - (-(-PERCENT * len(g) // 100)) + 1) // 2] for g in one.values()]), return_counts=True)
            cut = np.searchsorted((key >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24), np.arange(buckets + 1, dtype=np.uint64))
            full = np.flatnonzero(np.diff(cut)).tolist()
            cols = [[x[cut[k]:cut[k + 1]].tobytes() for k in full] for x in (key, np.minimum(n, 255).astype(np.uint8))]
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *(pa.array(c, pa.binary()) for c in cols)], names=["bucket", "keys", "counts"])

    return run


def _frequent(table: pa.Table) -> pa.Table:
    """(keys, n) of one bucket's shingles that reach FREQUENT."""
    key, where = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in table["keys"].to_pylist()]), return_inverse=True)
    n = np.bincount(where, np.concatenate([np.frombuffer(x, np.uint8) for x in table["counts"].to_pylist()])).astype(np.int64)
    often = n >= FREQUENT
    return pa.table({"keys": key[often].view(np.int64), "n": n[often]})


PAIR = "key long, a long, b long, na long, nb long, pa long, pb long"


def buckets(docs: DataFrame, total: int) -> int:
    """Buckets of lists for so many shingles: a bucket's size stays the same."""
    return max(shuffle_parts(docs.sparkSession), total // (5 * BUCKET_POSTINGS))


def survey(docs: DataFrame) -> tuple[DataFrame, tuple[np.ndarray, np.ndarray], int]:
    """(documents with size and signature, frequent shingles with their rank, shingles in all)."""
    p1 = stored(docs.mapInArrow(_survey, "ids array<long>, sizes array<long>, sigs array<long>, keys array<long>, counts array<long>"), "jaccard-sets")
    sized = p1.selectExpr("inline(arrays_zip(ids, sizes, sigs))").toDF("doc_id", "n", "sig")
    total = p1.select(F.sum(F.expr("aggregate(sizes, 0L, (s, x) -> s + x)"))).first()[0] or 0
    lowest = docs.mapInArrow(_lowest(buckets(docs, total)), "bucket int, keys binary, counts binary").groupBy("bucket").applyInArrow(
        _frequent, "keys long, n long")
    local = p1.selectExpr("inline(arrays_zip(keys, counts))").groupBy("keys").agg(F.sum("counts").alias("n")).where(F.col("n") >= FREQUENT)
    often = lowest.unionByName(local).groupBy("keys").agg(F.max("n").alias("n"))
    got = often.orderBy(F.desc("n"), "keys").limit(MAX_FREQUENT).toPandas()
    keys, n = got["keys"].to_numpy(np.int64).view(np.uint64), got["n"].to_numpy(np.int64)
    by = np.argsort(keys)
    rank = np.empty(len(keys), np.int64)
    rank[np.lexsort((keys[by], n[by]))] = np.arange(len(keys))
    release(docs.sparkSession)
    return sized, (keys[by], rank), total


def candidates(docs: DataFrame, often: tuple[np.ndarray, np.ndarray], total: int) -> DataFrame:
    """Rows of PAIR: pairs that may link (key null), and the postings of long lists (b unused)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(often)
    posted = docs.mapInArrow(_postings(shared, buckets(docs, total)), "bucket int, key binary, sig binary, n binary, pos binary")
    return few_files(posted.groupBy("bucket").applyInArrow(_candidates, PAIR), total, 5 * BUCKET_POSTINGS)


def set_rows(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sig, grams): the sets of the documents in ``wanted`` (sig, doc_id), hashed again from their texts."""
    small = wanted.count() <= BROADCAST_IDS
    side = wanted.select(F.col("doc_id").alias("id"), F.col("sig").alias("want"))
    rows = docs.join(F.broadcast(side) if small else side, F.col("doc_id") == F.col("id")).select("want", "doc_id", "text")

    def run(batches):
        for b in batches:
            want, sets = b["want"].to_pylist(), []
            for first, raw, off in text_slices(b["text"]):
                sets += shingle_hashes(*word_hashes(raw, off), WORDS)
            same = [k for k, g in enumerate(sets) if signature(g) == want[k]]  # rows of one id can differ in text
            yield pa.RecordBatch.from_arrays([pa.array([want[k] for k in same], pa.int64()),
                                              pa.array([sets[k].view(np.int64) for k in same], pa.list_(pa.int64()))], names=["sig", "grams"])

    return rows.mapInArrow(run, "sig long, grams array<long>").dropDuplicates(["sig"])


#: Ids that may be broadcast (8 MB); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def overlaps(docs: DataFrame, pairs: DataFrame, homes: DataFrame, shingles: int, name: str) -> DataFrame:
    """(a, b, na, nb, common) of pairs, stored; ``homes`` has one document per signature, ``shingles`` is about what the sets of all pairs have."""
    used = pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
    sets = set_rows(docs, homes.join(used, "sig").select("sig", "doc_id"))
    left, right = sets.toDF("a", "ga"), sets.toDF("b", "gb")
    out = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).cast("long").alias("common"))
    return stored(few_files(out, shingles, COMPARED_SHINGLES), name)


def linked(df: DataFrame) -> DataFrame:
    """The pairs that link, as (a, b)."""
    return df.where(100 * F.col("common") >= PERCENT * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def _need(a: str, b: str):
    return F.ceil(PERCENT * (F.col(a) + F.col(b)) / (100 + PERCENT))


def cross_pairs(lists: DataFrame, found: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs in long lists that first components leave open: (a, b, na, nb, settled), settled where bounds prove a link.

    The larger set of a pair probes the list: it asks for the two size classes that can hold a partner, and of those
    only the block of low positions: a smaller partner that holds the shingle beyond is skipped without being read.
    """
    p = lists.select("key", F.col("a").alias("sig"), F.col("na").alias("n"), F.col("pa").alias("pos"))
    p = p.join(parts.select(F.col("node").alias("sig"), "component"), "sig", "left").withColumn("part", F.coalesce("component", "sig"))
    many = p.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.min(F.struct("pos", "n", "sig")).alias("c"))
    p = p.join(many.where("lo <> hi").select("key", F.col("c.sig").alias("centre"), F.col("c.n").alias("nc")), "key")
    both = found.select(F.col("a").alias("centre"), F.col("b").alias("sig"), "common").unionByName(
        found.select(F.col("b").alias("centre"), F.col("a").alias("sig"), "common"))
    p = p.join(both, ["centre", "sig"], "left").withColumn("class", F.floor(F.log("n") / F.log(F.lit(1.26))))
    # the smaller set of a linked pair has the shingle among its first n - ceil(2 * 0.8 / 1.8 * n) + 1
    low = F.col("pos") <= F.col("n") - F.ceil(2 * PERCENT * F.col("n") / (100 + PERCENT))
    index = p.where(low).select("key", "class", *[F.col(c).alias(f"{c}2") for c in ("sig", "n", "pos", "part", "common")])
    probe = p.withColumn("class", F.explode(F.array(F.col("class"), F.col("class") - 1)))
    order = F.struct("n2", "sig2") < F.struct("n", "sig")
    can = (F.least(F.col("n") - F.col("pos"), F.col("n2") - F.col("pos2")) >= _need("n", "n2")) & (F.col("part") != F.col("part2"))
    most = F.least("common", "common2") + F.least(F.col("n") - F.col("common"), F.col("n2") - F.col("common2"))
    can = can & F.coalesce(most >= _need("n", "n2"), F.lit(True))
    j = probe.join(index, (probe["key"] == index["key"]) & (probe["class"] == index["class"]) & order & can)
    least = F.coalesce(F.col("common") + F.col("common2") - F.col("nc") >= _need("n", "n2"), F.lit(False))
    first = F.col("sig") < F.col("sig2")
    return j.select(F.least("sig", "sig2").alias("a"), F.greatest("sig", "sig2").alias("b"), F.when(first, F.col("n")).otherwise(F.col("n2")).alias("na"),
                    F.when(first, F.col("n2")).otherwise(F.col("n")).alias("nb"), least.alias("settled")) \
        .groupBy("a", "b", "na", "nb").agg(F.max("settled").alias("settled"))


def groups(df: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``df`` (columns doc_id, text)."""
    small_batches(df)
    spark = df.sparkSession
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sized, often, total = survey(docs)
    homes = sized.where("n > 0 AND doc_id IS NOT NULL").groupBy("sig").agg(F.min("doc_id").alias("doc_id"))
    found = stored(candidates(docs, often, total), "jaccard-candidates")
    release(spark)
    pairs = found.where("key IS NULL").groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"))
    size = F.coalesce(F.sum(F.col("na") + F.col("nb")), F.lit(0))
    exact = overlaps(docs, pairs, homes, found.where("key IS NULL").select(size).first()[0], "jaccard-overlaps")
    links = linked(exact)
    parts = components(links)
    lists = found.where("key IS NOT NULL")
    if not lists.isEmpty():
        rest = stored(cross_pairs(lists, exact, parts).join(exact.select("a", "b"), ["a", "b"], "left_anti"), "jaccard-rest")
        open_ = rest.where("NOT settled")
        more = overlaps(docs, open_.select("a", "b", "na", "nb"), homes, open_.select(size).first()[0], "jaccard-overlaps")
        more = linked(more).unionByName(rest.where("settled").select("a", "b"))
        if not more.isEmpty():
            parts = components(links.unionByName(more))
    own = homes.join(parts.select(F.col("node").alias("sig"), "component"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    least = own.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    where = own.join(least, "component").select("sig", "component_id")
    out = sized.join(where, "sig", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(df: DataFrame) -> DataFrame:
    """One document of each group (that of the component's id), with the input's columns.

    Rows of one id are one document; rows without an id are kept.
    """
    keep = unused(df, "__keep")
    kept = groups(df).where("doc_id = component_id").select(F.col("doc_id").alias(keep)).distinct()
    kept = stored(few_files(kept, df.count()), "jaccard-kept")
    kept = F.broadcast(kept) if kept.count() <= BROADCAST_IDS else kept  # then the texts take no shuffle
    return df.join(kept, F.col("doc_id") == F.col(keep), "left").where(F.col("doc_id").isNull() | F.col(keep).isNotNull()).drop(keep)


def op2(documents: DataFrame) -> DataFrame:
    """The digest of the contract: one row per document."""
    return groups(documents)
