"""Operator 10, packing: order-preserving dynamic programming over document and sentence boundaries.

Documents are dealt into ranges of their id (and a hash of the text, as many rows may have one id) and tokenised in order. The token stream of a range is cut into windows
of at most ``MAX_TOKENS``: windows may end at the end of a document (free), after a sentence (``SENTENCE_COST``) or,
inside sentences longer than ``FORCED_EVERY``, at every such step (``FORCED_COST``). The dynamic programme minimises
padding plus these truncation penalties. As the padding of a window from i to j is MAX_TOKENS - (T[j] - T[i]), the
best start of each window is the minimum of cost[i] + T[i] over a sliding range, which a monotone queue gives in
constant time; windows of a power of two tokens need no padding and are tried besides. Runs of ``RUN_TOKENS`` are
solved one after another; the last window of a run stays open and is solved again with the next.

A task holds one run of tokens, whatever the size of its range. Sequence numbers are unique, not consecutive: the
range's number and a count within it.

Cases: a null text counts as empty, an empty text is its end id alone; a document longer than a window lies in several
pieces; repeated rows and ids are packed one by one, null ids come first; an empty table gives an empty result; other
columns are not carried.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import remembered, shuffle_parts, small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_TOKENS = 4096
END_ID = 2
SENTENCE_COST, FORCED_COST, SEQUENCE_COST = 8, 256, 1
FORCED_EVERY = 1024
SMALLEST_POWER = 256
RUN_TOKENS = 1 << 19
#: Bytes that a worker's remembered words may take, what a word takes besides its letters and ids, the longest word that stays.
MEMORY_BYTES, WORD_BYTES, LONG_WORD = 112 << 20, 160, 64
#: Words of letters that go to the tokenizer in one call.
TOGETHER = 64
#: Small letters of Latin-1 in UTF-8.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
#: How byte-level vocabularies write a byte: itself where Latin-1 has a printable character, the others from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_NAMES = dict(zip(_SHOWN, _SHOWN)) | {b: 256 + k for k, b in enumerate(x for x in range(256) if x not in set(_SHOWN))}
#: A word that ends in ASCII marks: the part up to its last letter (small, or beyond ASCII), and the marks.
MARKED = re.compile(rb"([^\x00-\x20<]*[a-z\x80-\xff])([!-&(-;=?-@\[-`{-~]+)")
#: Stands for the end of a text among its words.
CLOSE = b""
#: Characters tokenised at a time.
SLICE = 1 << 20
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class _Codes(dict):
    """Numbers of words in the order they are first asked for; ``new`` lists those that wait for their ids."""

    def __init__(self):
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class WordIds:
    """Ids of texts under a tokenizer that drops white space, from the ids of their space-separated words.

    Normalisation and splitting of such a tokenizer never look across white space, so a text's ids are those of its
    words in order. A word's ids are taken from the tokenizers library once and remembered. A letter and the ASCII marks behind it
    are always split, so a word that ends in marks is put together from its two parts; words of letters alone are
    one piece each and go to the library many to a call, told apart by their word ends.

    What is remembered is bounded by bytes: beyond MEMORY_BYTES, words used once or longer than LONG_WORD go, and of the
    others the less used, until half of it is free.
    """

    def __init__(self, spec: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_buffer(spec)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.batch = getattr(self.tok, "encode_batch_fast", self.tok.encode_batch)
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.sentence_end = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.word_end = np.zeros(len(self.sentence_end), bool)
        for t, i in vocab.items():
            if t.endswith("</w>"):
                self.word_end[i] = True
                self.sentence_end[i] = t[-5:-4] in tuple(".!?")
        self.forget()

    def forget(self) -> None:
        self.code = _Codes()
        self.code[CLOSE] = 0
        self.flat, self.n = np.array([END_ID], np.uint32), 1
        self.start, self.size, self.used = np.zeros(1, np.int64), np.ones(1, np.int32), np.zeros(1, np.int64)
        self.held = 0

    def _encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(the library's ids of all words in order, ids per word); words of letters alone, where every run keeps its word ends."""
        runs = [words[k:k + TOGETHER] for k in range(0, len(words), TOGETHER)]
        got = self.batch([b" ".join(r).decode() for r in runs], add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in got), np.uint32)
        n = np.fromiter((len(e) for e in got), np.int64, len(got))
        ends = np.flatnonzero(self.word_end[ids])
        want = np.cumsum([len(r) for r in runs])
        if len(ends) == len(words) and (ends[want - 1] + 1 == np.cumsum(n)).all():
            return ids, np.diff(np.concatenate([[-1], ends]))
        return self._one_by_one(words)

    def _one_by_one(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.batch([w.decode() for w in words], add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(got), np.uint32), np.fromiter(map(len, got), np.int64, len(got))

    def _pieces(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for small letters of PLAIN: such a word is one piece that no normalisation changes, so the merges alone make its ids."""
        piece = self.tok.model.tokenize
        got = [[t.id for t in piece(w.decode() if w.isascii() else w.decode("latin-1").translate(BYTE_NAMES))] for w in words]
        return np.fromiter(chain.from_iterable(got), np.uint32), np.fromiter(map(len, got), np.int64, len(got))

    def learn(self) -> None:
        """Take in the ids of the words that wait for them."""
        first, new = len(self.start), self.code.new
        plain, letters, single, whole, front, back = [], [], [], [], [], []
        for k, w in enumerate(new):  # grows by the parts that are new themselves
            if (w.isalpha() and w.islower()) or (w[-1] > 127 and PLAIN.fullmatch(w)):
                plain.append(k)
                continue
            m = MARKED.fullmatch(w)
            if m and (m[1][-1] < 128 or m[1].decode()[-1].lower().isalpha()):
                whole.append(k)
                front.append(self.code[m[1]])
                back.append(self.code[m[2]])
            elif w.decode().isalpha():
                letters.append(k)
            else:
                single.append(k)
        start, size = np.zeros(len(new), np.int64), np.zeros(len(new), np.int32)
        for some, take in ((plain, self._pieces), (letters, self._encoded), (single, self._one_by_one)):
            if some:
                ids, n = take([new[k] for k in some])
                start[some], size[some] = self.n + np.cumsum(n) - n, n
                self._append(ids)
        self.start, self.size = np.concatenate([self.start, start]), np.concatenate([self.size, size])
        if whole:  # the parts end in no mark or are marks alone, so they are known by now
            parts = np.array([front, back]).T.ravel()
            ids = self._gather(parts)
            n = self.size[parts].reshape(-1, 2).sum(1)
            at = first + np.array(whole)
            self.start[at], self.size[at] = self.n + np.cumsum(n) - n, n
            self._append(ids)
        self.used = np.concatenate([self.used, np.zeros(len(new), np.int64)])
        self.held += sum(map(len, new)) + WORD_BYTES * len(new) + 4 * int(self.size[first:].sum())
        self.code.new = []

    def _append(self, ids: np.ndarray) -> None:
        need = self.n + len(ids)
        if need > len(self.flat):
            self.flat = np.resize(self.flat, need + need // 4)
        self.flat[self.n:need] = ids
        self.n = need

    def _gather(self, code: np.ndarray) -> np.ndarray:
        """The ids of words in order."""
        size = self.size[code]
        total = np.cumsum(size, dtype=np.int64)
        return self.flat[np.repeat(self.start[code] - (total - size), size) + np.arange(total[-1] if len(total) else 0)]

    def shrink(self) -> None:
        """Forget what is used least, until half of the memory is free."""
        words = list(self.code)
        cost = np.fromiter(map(len, words), np.int64, len(words)) + WORD_BYTES + 4 * self.size
        keep = np.flatnonzero((self.used > 1) & (cost <= LONG_WORD + WORD_BYTES + 4 * self.size))
        keep = keep[keep > 0]
        keep = keep[np.argsort(-self.used[keep], kind="stable")]
        keep = keep[np.cumsum(cost[keep]) <= MEMORY_BYTES // 2]
        start, size, flat, used = self.start[keep], self.size[keep], self.flat, self.used[keep] // 2
        self.forget()
        for k in keep.tolist():
            self.code[words[k]] = len(self.code)
        total = np.cumsum(size, dtype=np.int64)
        n = int(total[-1]) if len(total) else 0
        self.flat = np.concatenate([self.flat, flat[np.repeat(start - (total - size), size) + np.arange(n)]])
        self.n, self.held = 1 + n, int(cost[keep].sum())
        self.start, self.size = np.concatenate([self.start, 1 + total - size]), np.concatenate([self.size, size])
        self.used = np.concatenate([self.used, used])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each closed by END_ID; ids per text), SLICE characters at a time."""
        ids, sizes, i = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], 0
        while i < len(texts):
            words, ends, held = [], [], 0
            while i < len(texts) and held < SLICE:
                raw = texts[i].encode()
                # the vocabulary is lower case; only the special tokens, which hold "<|", tell cases apart
                words += (raw if b"<|" in raw else raw.lower()).split()
                words.append(CLOSE)
                ends.append(len(words))
                held, i = held + len(raw), i + 1
            if self.held > MEMORY_BYTES:
                self.shrink()
            code = np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))
            if self.code.new:
                self.learn()
            self.used += np.bincount(code, minlength=len(self.used))
            total = np.cumsum(self.size[code], dtype=np.int64)
            ids.append(self._gather(code))
            sizes.append(np.diff(np.concatenate([[0], total[np.array(ends) - 1]])))
        return np.concatenate(ids), np.concatenate(sizes)


def boundaries(ids: np.ndarray, doc_ends: np.ndarray, sentence_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(allowed cuts from 0 to the end, penalty of each)."""
    cut, end = np.zeros(len(ids) + 1, bool), np.zeros(len(ids) + 1, bool)
    cut[1:] = sentence_end[ids]
    end[doc_ends] = True
    cut |= end
    cut[0] = True
    at = np.flatnonzero(cut)
    wide = np.flatnonzero(np.diff(at) > FORCED_EVERY)
    forced = np.concatenate([np.arange(at[i] + FORCED_EVERY, at[i + 1], FORCED_EVERY) for i in wide]) if len(wide) else at[:0]
    cost = np.full(len(at), SENTENCE_COST, np.int64)
    cost[end[at]] = 0
    cost[0] = 0
    if len(forced):
        at = np.concatenate([at, forced])
        cost = np.concatenate([cost, np.full(len(forced), FORCED_COST, np.int64)])
        order = np.argsort(at, kind="stable")
        at, cost = at[order], cost[order]
    return at, cost


def cut_windows(at: np.ndarray, cost: np.ndarray, max_tokens: int = MAX_TOKENS) -> np.ndarray:
    """Indices into ``at`` of the best cuts, first and last included."""
    n = len(at)
    exact: list[list[int] | None] = [None] * n
    size = SMALLEST_POWER
    while size <= max_tokens:
        i = np.searchsorted(at, at - size)
        for j, k in zip(hit := np.flatnonzero(at[np.minimum(i, n - 1)] == at - size).tolist(), i[hit].tolist()):
            exact[j] = [*(exact[j] or ()), k]
        size *= 2
    t, pen = at.tolist(), (cost + SEQUENCE_COST + max_tokens).tolist()
    best, back = [0] * n, [0] * n
    # the queue: keys best[i] + t[i], increasing, and their i, from head to tail
    keys, where, head, tail = [t[0]] * (n + 1), [0] * (n + 1), 0, 1
    for j in range(1, n):
        end = t[j]
        low = end - max_tokens
        while t[where[head]] < low:
            head += 1
        i = where[head]
        b = keys[head] - end
        if exact[j]:
            for k in exact[j]:
                if best[k] - max_tokens < b:
                    b, i = best[k] - max_tokens, k
        b += pen[j]
        best[j], back[j] = b, i
        key = b + end
        while tail > head and keys[tail - 1] >= key:
            tail -= 1
        keys[tail], where[tail] = key, j
        tail += 1
    path = [n - 1]
    while path[-1]:
        path.append(back[path[-1]])
    return np.array(path[::-1])


def _pieces(ids, doc_ids, doc_starts, doc_ends, doc_first, doc_total, windows, sequence):
    """Rows of SCHEMA for windows given by their token cuts; documents by their token ranges in ``ids``."""
    cuts = np.unique(np.concatenate([windows, doc_ends[doc_ends <= windows[-1]]]))
    starts, ends = cuts[:-1], cuts[1:]
    doc = np.searchsorted(doc_ends, starts, side="right")
    win = np.searchsorted(windows, starts, side="right") - 1
    raw = np.ascontiguousarray(ids, "<u4")
    crc = [zlib.crc32(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
    return pa.RecordBatch.from_arrays([
        pa.array([doc_ids[k] for k in doc.tolist()], pa.int64()), pa.array(doc_first[doc] + starts - doc_starts[doc]),
        pa.array(ends - starts), pa.array(crc, pa.int64()), pa.array(doc_total[doc]), pa.array(sequence + win),
        pa.array(starts - windows[win])], names=[c.split()[0] for c in SCHEMA.split(", ")])


def pack_stream(batches, words: WordIds, sequence: int):
    """Rows of SCHEMA for the documents of one range in order; ``sequence`` is the first sequence number."""
    ids, doc_ids = np.zeros(0, np.uint32), []
    first, total, held = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    more = chain(((b["doc_id"].to_pylist(), b["text"].to_pylist()) for b in batches), [None])
    waiting, waiting_ids, waiting_n, size = [], [], [], 0
    for got in more:
        if got is not None:
            new, n = words.encode(got[1])
            waiting.extend(got[0])
            waiting_ids.append(new)
            waiting_n.append(n)
            size += len(new)
            if len(ids) + size < RUN_TOKENS:
                continue
        if not waiting and not doc_ids:
            continue
        ids = np.concatenate([ids, *waiting_ids])
        n = np.concatenate([np.zeros(0, np.int64), *waiting_n]).astype(np.int64)
        doc_ids, held = doc_ids + waiting, np.concatenate([held, n])
        first, total = np.concatenate([first, np.zeros(len(n), np.int64)]), np.concatenate([total, n])
        waiting, waiting_ids, waiting_n, size = [], [], [], 0
        ends = np.cumsum(held)
        at, cost = boundaries(ids, ends, words.sentence_end)
        windows = at[cut_windows(at, cost)]
        if got is not None:  # the last window stays open
            windows = windows[:-1]
        if len(windows) > 1:
            yield _pieces(ids, doc_ids, ends - held, ends, first, total, windows, sequence)
            sequence += len(windows) - 1
        done = int(windows[-1])
        k = int(np.searchsorted(ends, done, side="right"))
        ids, doc_ids, total = ids[done:], doc_ids[k:], total[k:]
        starts = (ends - held)[k:]
        first, held = first[k:].copy(), held[k:].copy()
        if len(held):
            cut = max(0, done - int(starts[0]))
            first[0] += cut
            held[0] -= cut


def vocabulary(path: str | None = None) -> bytes:
    """The tokenizer file (a small fixed file, read on the driver and sent to the tasks)."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, "rb") as f:
        return f.read()


def pack(df: DataFrame, path: str | None = None) -> DataFrame:
    """The pieces of all documents (columns doc_id, text), one row per piece; see SCHEMA."""
    small_batches(df)
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary(path))

    def run(batches):
        yield from pack_stream(batches, remembered("words", shared.value, WordIds), TaskContext.get().partitionId() << 40)

    d = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("place", F.xxhash64("text"))  # rows of one id, and those without an id, spread over ranges
    ranges = d.repartitionByRange(shuffle_parts(spark), "doc_id", "place").sortWithinPartitions("doc_id", "place", "text")
    return ranges.drop("place").mapInArrow(run, SCHEMA)


def op10(documents: DataFrame) -> DataFrame:
    """The digest of the contract: one row per piece."""
    return pack(documents)
