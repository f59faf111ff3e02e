"""Operator 8, byte-level BPE encoding and decoding by tree concatenation.

A text is first cut where a blank follows a character that is not white space: no token of the vocabulary's
splitting pattern spans such a place, so the parts encode independently. What stays long is unsplit text. Its
pattern pieces are cut into leaves, the leaves are encoded on their own, and halves are joined by encoding a window
of tokens around the join again, twice as wide each time, until the first and the last token of the window agree
with what both sides had. Every neighbouring pair of the joined tokens then occurs in a correct encoding, which
makes the whole correct.

Texts of more than ``LONG_CHARS`` are spread: their parts and leaves are rows of their own that many tasks encode;
one task per text then only joins them. Shorter texts are encoded in the task that read them.

Cases: a null text counts as empty; an empty text has no ids and decodes to the empty text; the special token's own
string in a text becomes its id; repeated rows and ids are encoded one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import remembered, small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAF_BYTES = 512
LONG_CHARS = 1 << 20
PART_CHARS = 1 << 18
CUT = re.compile(r"\S ")
#: The splitting pattern of byte-level BPE vocabularies (fixed value, published with them).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Codec:
    """Encoder and decoder of one vocabulary file of the tokenizers library (byte-level BPE)."""

    def __init__(self, spec: bytes):
        import tiktoken
        d = json.loads(spec)
        model, chars = d["model"], self._bytes_of_chars()
        vocab = {bytes(chars[c] for c in tok): i for tok, i in model["vocab"].items()
                 if tok not in {a["content"] for a in d["added_tokens"]}}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if any(a >= b for a, b in zip(merged, merged[1:])):
            raise ValueError("the ids of this vocabulary do not follow its merges")
        self.special = {a["content"]: a["id"] for a in d["added_tokens"]}
        self.core = tiktoken.Encoding("llm", pat_str=PATTERN, mergeable_ranks=vocab, special_tokens=self.special)
        self.pieces = regex.compile(PATTERN)
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.long = re.compile("[^ ]{%d}" % LEAF_BYTES)

    @staticmethod
    def _bytes_of_chars() -> dict[str, int]:
        """The byte for each printable stand-in of a byte-level vocabulary."""
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}

    def join(self, left: list[int], right: list[int], window: int = 8) -> list[int]:
        """Tokens of the two halves of a piece as one: encode windows around the join until both sides agree."""
        if not left or not right:
            return left + right
        while True:
            a, b = left[-window:], right[:window]
            mid = self.core._encode_single_piece(self.core.decode_bytes(a + b))
            if (window >= len(left) or mid[0] == a[0]) and (window >= len(right) or mid[-1] == b[-1]):
                return left[:-window] + mid + right[window:]
            window *= 2

    def piece(self, data: bytes) -> list[int]:
        """Tokens of one pattern piece: halves are encoded on their own, then joined."""
        if len(data) <= LEAF_BYTES:
            return self.core._encode_single_piece(data)
        half = len(data) // 2
        return self.join(self.piece(data[:half]), self.piece(data[half:]))

    def unsplit(self, text: str) -> list[int]:
        """Tokens of a text without safe cuts: by special tokens, then pieces, long pieces as trees."""
        out: list[int] = []
        for k, part in enumerate(self.marks.split(text) if self.marks else [text]):
            if k % 2:
                out.append(self.special[part])
            else:
                for m in self.pieces.finditer(part):
                    out += self.piece(m[0].encode())
        return out

    def encode(self, text: str) -> list[int]:
        if not self.long.search(text):
            return self.core.encode(text, allowed_special="all")
        out, done = [], 0
        for cut in [*(m.start() + 1 for m in CUT.finditer(text)), len(text)]:
            if cut - done > LEAF_BYTES:
                out += self.unsplit(text[done:cut])
            elif cut > done:
                out += self.core.encode(text[done:cut], allowed_special="all")
            done = cut
        return out

    def decode(self, ids) -> str:
        return self.core.decode_bytes(ids).decode("utf-8", "replace")

    def parts(self, text: str):
        """(continues the piece before, bytes) of a long text: safe parts of about PART_CHARS; longer pieces cut into leaves."""
        done = last = 0
        for cut in [*(m.start() + 1 for m in CUT.finditer(text)), len(text)]:
            if cut - done > PART_CHARS and last > done:
                yield False, text[done:last].encode()
                done = last
            if cut - done > PART_CHARS:
                yield from self._leaves(text[done:cut])
                done = cut
            last = cut
        if done < len(text):
            yield False, text[done:].encode()

    def _leaves(self, text: str):
        """Parts of a text without safe cuts: runs of whole pieces, and leaves of pieces longer than a part."""
        def flush(held):
            k = len(held)
            while k and held[k - 1][-1].isspace():  # white space at the end of a run would be split otherwise than before more text
                k -= 1
            for run in (["".join(held[:k])] if k else []) + held[k:]:
                yield False, run.encode()

        for k, part in enumerate(self.marks.split(text) if self.marks else [text]):
            held, size = [], 0
            for m in ([part] if k % 2 else (m[0] for m in self.pieces.finditer(part))):
                if len(m) > PART_CHARS:
                    yield from flush(held)
                    held, size, data = [], 0, m.encode()
                    for at in range(0, len(data), PART_CHARS):
                        yield (at > 0), data[at:at + PART_CHARS]
                elif m:
                    held.append(m)
                    size += len(m)
                    if size > PART_CHARS:
                        yield from flush(held)
                        held, size = [], 0
            yield from flush(held)


def codec(spec: bytes) -> Codec:
    """The codec of a vocabulary file's content, built once per worker."""
    return remembered("bpe", spec, Codec)


def vocabulary(path: str | None = None) -> bytes:
    """The vocabulary file (a small fixed file, read on the driver and sent to the tasks)."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, "rb") as f:
        return f.read()


def _ids_of_long(df: DataFrame, shared) -> DataFrame:
    """(doc_id, ids) of long texts: parts as rows, encoded wherever Spark deals them, joined per text."""
    def split(batches):
        c = codec(shared.value)
        for b in batches:
            for i, row, text in zip(b["doc_id"].to_pylist(), b["row"].to_pylist(), b["text"].to_pylist()):
                for k, (more, data) in enumerate(c.parts(text)):
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([row], pa.int64()), pa.array([k], pa.int32()),
                                                      pa.array([more]), pa.array([data], pa.binary())],
                                                     names=["doc_id", "row", "k", "more", "data"])

    def encode(batches):
        c = codec(shared.value)
        for b in batches:
            data, more = b["data"].to_pylist(), b["more"].to_pylist()
            follows = b["followed"].to_pylist()
            ids = [np.array(c.piece(d) if m or f else c.encode(d.decode()), np.int32).tobytes() for d, m, f in zip(data, more, follows)]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["row"], b["k"], b["more"], pa.array(ids, pa.binary())],
                                             names=["doc_id", "row", "k", "more", "ids"])

    def merge(table: pa.Table) -> pa.Table:
        c, table = codec(shared.value), table.sort_by("k")
        out, run = [], []
        def close():
            while len(run) > 1:  # a tree: neighbours are joined in pairs
                run[:] = [c.join(run[i], run[i + 1]) if i + 1 < len(run) else run[i] for i in range(0, len(run), 2)]
            out.extend(run.pop() if run else [])
        for more, ids in zip(table["more"].to_pylist(), table["ids"].to_pylist()):
            if not more:
                close()
            run.append(np.frombuffer(ids, np.int32).tolist())
        close()
        return pa.table({"doc_id": table["doc_id"][:1], "ids": pa.array([np.array(out, np.int32).tobytes()], pa.binary())})

    rows = df.withColumn("row", F.monotonically_increasing_id()).mapInArrow(split, "doc_id long, row long, k int, more boolean, data binary")
    # a leaf is encoded as a bare piece also where only its follower says so
    after = rows.where("more").select("row", (F.col("k") - 1).alias("k"), F.lit(True).alias("followed"))
    rows = rows.join(after, ["row", "k"], "left").withColumn("followed", F.coalesce("followed", F.lit(False)))
    coded = rows.repartition("row", "k").mapInArrow(encode, "doc_id long, row long, k int, more boolean, ids binary")
    return coded.groupBy("row").applyInArrow(merge, "doc_id long, ids binary")


def encode(df: DataFrame, path: str | None = None, long_chars: int = LONG_CHARS) -> DataFrame:
    """(doc_id, ids): the ids of every text as little-endian 32-bit integers, one row per input row (columns doc_id, text)."""
    small_batches(df)
    shared = df.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches):
        c = codec(shared.value)
        for b in batches:
            ids = [np.array(c.encode(t), np.int32).tobytes() for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    d = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    short = d.where(F.length("text") <= long_chars).mapInArrow(run, "doc_id long, ids binary")
    return short.unionByName(_ids_of_long(d.where(F.length("text") > long_chars), shared))


def decode(df: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids)."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches):
        c = codec(shared.value)
        for b in batches:
            texts = [c.decode(np.frombuffer(x, np.int32).tolist()) for x in b["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"])

    return df.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op8(documents: DataFrame) -> DataFrame:
    """The digest of the contract: ids of every document and the text they decode to, as counts and hashes."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary())

    def digest(batches):
        c = codec(shared.value)
        for b in batches:
            n, a, t = [], [], []
            for x in b["ids"].to_pylist():
                ids = np.frombuffer(x, np.int32).tolist()
                n.append(len(ids))
                a.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                t.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(t, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encode(documents).mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
