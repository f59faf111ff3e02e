"""Operator 12, target-distribution importance resampling over an Aho-Corasick dictionary with CRC payloads.

Words are maximal runs of digits, letters a to z (A to Z lower-cased) and characters beyond ASCII. For each slice of text
an automaton is built over its distinct words, each bounded by delimiters on both sides, so that a word is found only where
it stands whole. A word's entry carries its payload: CRC-32 and length in bytes. Scanning the slice emits the payloads in
order, and payloads of adjacent words compose to those of runs of words, as crc(xy) = shift(crc(x), length of y) ^ crc(y):
no run is ever cut out of the text or hashed. A run's bucket is its CRC modulo ``BUCKETS``.

Spark adds up the buckets of all raw and all target texts (each task sends at most BUCKETS sums). A bucket's gain
is the scaled log ratio of its smoothed shares, a document's weight the sum of its features' gains. The draw adds
Gumbel noise that depends on seed and id only, and keeps the highest scores among long enough documents: sampling without replacement in
proportion to the weights. Rows are ranked by a range shuffle and counts per range, without a task that sees all.

The buckets of a document are written once, two or four bytes a feature, so that texts are scanned once. Memory: an
automaton covers about SLICE bytes; a longer text is cut at delimiters, and words of over LONG_WORD bytes stand in the scanned
text by a short mark (a control character, which no word holds, and a number) that carries their payload.

Cases: a null text has no words; a text without words has weight 0 and is never drawn; a null id counts as the empty string in the noise
and comes after equal scores; repeated rows are scored and ranked one by one; texts of any length are counted whole; other columns,
whatever their names, are not read; an empty table gives an empty result, an empty target has T = 0.
"""

from __future__ import annotations

import re
import sys
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches, stored
from riskframe.operators.keys import row_index

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS, RUN, SEED, MIN_WORDS, PERCENT, SCALE = 10_000, 1, 2024, 20, 10, 1000
SLICE = 1 << 20
LONG_WORD = 256
#: Bytes outside words become a space; A to Z become a to z.
NORMAL = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_LONG = re.compile(rb"(?<![^ ])[^ ]{%d,}" % (LONG_WORD + 1))
MARK = b"\x01"


def _steps() -> np.ndarray:
    """steps[k][j]: what bit j of a CRC becomes when 2^k zero bytes follow."""
    poly, one = 0xEDB88320, []
    for j in range(32):
        c = 1 << j
        for _ in range(8):
            c = c >> 1 ^ (poly if c & 1 else 0)
        one.append(c)
    steps = [np.array(one, np.uint64)]
    for _ in range(31):
        steps.append(_times(steps[-1], steps[-1]))
    return np.array(steps)


def _times(matrix: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """The linear map ``matrix`` (images of the 32 bits) applied to each CRC."""
    out = np.zeros_like(crc)
    for j in range(32):
        out ^= np.where(crc >> np.uint64(j) & np.uint64(1), matrix[j], np.uint64(0))
    return out


def compose(crc_a: np.ndarray, crc_b: np.ndarray, length_b: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """CRC-32 of each a followed by b, from the CRCs of both and the length of b."""
    out = crc_a.copy()
    for k in range(int(length_b.max(initial=0)).bit_length()):
        moved = length_b >> k & 1 == 1
        if moved.any():
            out[moved] = _times(steps[k], out[moved])
    return out ^ crc_b


def payloads(texts: list[str]) -> list[np.ndarray]:
    """The payloads of each text's words in order (CRC in the low 32 bits, length above), about SLICE bytes at a time."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    waiting: list[tuple[int, bytes]] = []
    held = 0
    for k, t in enumerate(texts):
        raw, at = t.encode().translate(NORMAL), 0
        while at < len(raw):
            end = min(len(raw), at + SLICE)
            if end < len(raw):  # to the end of the word
                end = raw.find(b" ", end)
                end = len(raw) if end < 0 else end
            waiting.append((k, raw[at:end]))
            held, at = held + end - at, end
            if held >= SLICE:
                _flush(waiting, out)
                waiting, held = [], 0
    _flush(waiting, out)
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]


def _flush(pieces: list[tuple[int, bytes]], out: list[list[np.ndarray]]) -> None:
    if not pieces:
        return
    from ahocorasick import STORE_INTS, Automaton
    marks: dict[bytes, int] = {}

    def mark(m: re.Match) -> bytes:
        w = m[0]
        return MARK + b"%d" % marks.setdefault(w, len(marks))

    cut = [_LONG.sub(mark, p) for _, p in pieces]
    data = b" " + b" ".join(cut) + b" "
    entries = [(w, w) for w in set(data.split(b" ")) if w and not w.startswith(MARK)] + [(MARK + b"%d" % i, w) for w, i in marks.items()]
    if not entries:
        return
    trie = Automaton(STORE_INTS)
    for i, (seen, _) in enumerate(entries):
        trie.add_word(f" {seen.decode()} ", i)
    trie.make_automaton()
    carried = np.array([zlib.crc32(w) | len(w) << 32 for _, w in entries], np.int64)
    ends, entry = np.fromiter(chain.from_iterable(trie.iter(data.decode())), np.int64).reshape(-1, 2).T
    found = carried[entry]
    stops = np.cumsum([len(p.decode()) + 1 for p in cut])  # where the space after each piece stands
    for (k, _), a, b in zip(pieces, np.searchsorted(ends, np.concatenate([[0], stops[:-1]]), side="right"), np.searchsorted(ends, stops, side="right")):
        out[k].append(found[a:b])


def runs(words: np.ndarray, longest: int, steps: np.ndarray) -> np.ndarray:
    """CRCs of all runs of 1 to ``longest`` adjacent words joined by one space, from the words' payloads."""
    crc, size = (words & 0xFFFFFFFF).astype(np.uint64), words >> 32
    out, run = [crc], crc
    gap = np.uint64(zlib.crc32(b" "))
    for n in range(2, longest + 1):
        run = run[:-1]
        if not len(run):
            break
        run = compose(run, np.full(len(run), gap), np.ones(len(run), np.int64), steps)
        run = compose(run, crc[n - 1:], size[n - 1:], steps)
        out.append(run)
    return np.concatenate(out)


def _width(buckets: int):
    return np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")


def features(df: DataFrame, id_col: str, longest: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, features): the bucket of every feature of each text, packed; written once."""
    small_batches(df)
    steps, kind = _steps(), _width(buckets)

    def run(batches):
        for b in batches:
            words = payloads([t or "" for t in b["text"].to_pylist()])
            packed = [(runs(w, longest, steps) % np.uint64(buckets)).astype(kind).tobytes() for w in words]
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(map(len, words), pa.int64()), pa.array(packed, pa.binary())],
                                             names=["id", "n_words", "features"])

    d = df.select(F.col(id_col).cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return stored(d.mapInArrow(run, "id long, n_words long, features binary"), "resample")


def bucket_counts(held: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all texts: summed in the tasks, then by Spark; at most ``buckets`` rows come to the driver."""
    kind = _width(buckets)

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for x in b["features"]:
                total += np.bincount(np.frombuffer(x.as_buffer(), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in held.select("features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Scaled log ratio of the smoothed shares of each bucket, rounded down."""
    n = float(len(raw))
    s, t = raw.astype(np.float64), target.astype(np.float64)
    return np.floor(SCALE * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weigh(held: DataFrame, gain: np.ndarray) -> DataFrame:
    """(id, n_words, n_features, weight) of each text."""
    kind = _width(len(gain))
    shared = held.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        for b in batches:
            per = [np.frombuffer(x.as_buffer(), kind) for x in b["features"]]
            yield pa.RecordBatch.from_arrays([b["id"], b["n_words"], pa.array(map(len, per), pa.int64()),
                                              pa.array((int(shared.value[x].sum()) for x in per), pa.int64())],
                                             names=["id", "n_words", "n_features", "weight"])

    return held.mapInArrow(run, "id long, n_words long, n_features long, weight long")


def resample(raw: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, longest: int = RUN,
             buckets: int = BUCKETS, seed: int = SEED, target_id: str = "item_id") -> DataFrame:
    """Every raw document's (doc_id, n_features, weight, score, rank); rank is null where the document isn't drawn."""
    held = features(raw, "doc_id", longest, buckets)
    gain = gains(bucket_counts(held, buckets), bucket_counts(features(target, target_id, longest, buckets), buckets))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    noise = F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))
    scored = stored(weigh(held, gain).withColumn("score", F.col("weight") + noise)
                    .withColumn("out", (F.col("n_words") < min_words).cast("int"))
                    .withColumn("down", -F.col("score")).withColumn("nameless", F.col("id").isNull().cast("int")), "resample-scores")
    draw = percent * scored.where("out = 0").count() // 100
    ranked = row_index(scored, ["out", "down", "nameless", "id", "weight", "n_features"], "rank")
    return ranked.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", F.expr(f"if(rank <= {draw}, rank, null)").alias("rank"))


def drawn(raw: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The documents that are drawn, with all their columns (rows without an id can't be told apart and stay out)."""
    ids = resample(raw, target, **options).where("rank is not null and doc_id is not null").select("doc_id").distinct()
    return raw.join(ids, "doc_id", "left_semi")


def op12(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest of the contract."""
    return resample(documents, benchmark)
