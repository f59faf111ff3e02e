"""Operator 6, personal data: regular expressions propose spans, checksums confirm them, context words adjust the score.

Every whole text is searched in one pass over Arrow batches; each text is a row of its own, so nothing is shuffled.
The patterns run in time linear in the text: they start only where a run of their characters starts and use
possessive quantifiers, which finds the same leftmost matches.

Cases: a null text is searched as an empty one and stays null when redacted; an empty text or table has no spans;
repeated rows are searched one by one; texts of any length are searched whole; other columns pass through untouched, whatever
their names.
"""

from __future__ import annotations

import hashlib
import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import free_name, small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The kinds of the contract, in its order; the method adds the others.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("iban", "ssn")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
DIGIT = re.compile("[0-9]")
NOT_DIGIT = re.compile("[^0-9]")
WORD = re.compile(r"[^\W\d_]+")

#: Score of a span by kind before context; validated kinds start higher. A span counts from ACCEPT on.
START = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
ACCEPT = 0.5
CONTEXT_CHARS = 40
SUPPORT = {
    "email": {"mail", "email", "contact", "write"}, "ip": {"ip", "address", "host", "server"},
    "card": {"card", "visa", "mastercard", "credit", "payment"}, "phone": {"phone", "call", "tel", "telephone", "mobile"},
    "iban": {"iban", "account", "bank", "transfer"}, "ssn": {"ssn", "social", "security"},
}
OPPOSE = {"version", "isbn", "order", "serial", "example"}


def luhn(digits: str) -> bool:
    """The Luhn check of a digit string."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The ISO 13616 check of an IBAN without blanks."""
    return 15 <= len(iban) <= 34 and int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses: for each @ the run of local characters before it and the domain after it."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        s = at
        while s > done and text[s - 1] in LOCAL:
            s -= 1
        m = DOMAIN.match(text, at + 1) if s < at else None
        if m:
            out.append((s, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) in the order of KINDS, then start; offsets in code points, end exclusive."""
    found = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = NOT_DIGIT.sub("", m[0])
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                    found.append(("phone", *m.span()))
        for m in IBAN.finditer(text):
            if mod97(m[0].replace(" ", "")):
                found.append(("iban", *m.span()))
        if "-" in text:
            found += [("ssn", *m.span()) for m in SSN.finditer(text)]
    out = []
    for kind, s, e in found:
        near = {w.lower() for w in WORD.findall(text[max(0, s - CONTEXT_CHARS):s] + " " + text[e:e + CONTEXT_CHARS])}
        score = START[kind] + 0.25 * bool(near & SUPPORT[kind]) - 0.15 * bool(near & OPPOSE)
        if kind in BASE_KINDS or score >= ACCEPT:
            out.append((kind, s, e, round(min(1.0, score), 3)))
    return out


def redact_text(text: str) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping spans the one that starts first stands."""
    out, done = [], 0
    for kind, s, e, _ in sorted(find_spans(text), key=lambda x: (x[1], -x[2])):
        if s >= done:
            out += [text[done:s], f"[{kind.upper()}]"]
            done = e
    return "".join(out) + text[done:] if out else text


def find(df: DataFrame, text: str = "text", out: str = "pii_spans") -> DataFrame:
    """The input plus ``out``: array of (kind, start, end, score); the name is lengthened by ``_`` while the input has it."""
    small_batches(df)
    out = free_name(df, out)
    item = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                         T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches):
        for b in batches:
            spans = [[dict(zip(("kind", "start", "end", "score"), x)) for x in find_spans(t or "")] for t in b[text].to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(spans, kind)], names=[*b.schema.names, out])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(item))]))


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """The input with every span in ``text`` replaced by its kind; the columns stay as they are."""
    small_batches(df)
    at = df.columns.index(text)

    def run(batches):
        for b in batches:
            new = pa.array([t if t is None else redact_text(t) for t in b[text].to_pylist()], b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([new if i == at else c for i, c in enumerate(b.columns)], names=b.schema.names)

    return df.mapInArrow(run, df.schema)


def op6(documents: DataFrame) -> DataFrame:
    """The digest of the contract: one row per document."""
    small_batches(documents)
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"

    def run(batches):
        for b in batches:
            counts, shas, alls = [[] for _ in BASE_KINDS], [], []
            for t in b["text"].to_pylist():
                spans = find_spans(t) if t else []
                joined = [f"{k}:{s}:{e}" for k, s, e, _ in spans]
                base = [x for x, (k, *_) in zip(joined, spans) if k in BASE_KINDS]
                for k, c in zip(BASE_KINDS, counts):
                    c.append(sum(x[0] == k for x in spans))
                shas.append(hashlib.sha256(",".join(base).encode()).hexdigest())
                alls.append(",".join(joined))
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], *(pa.array(c, pa.int64()) for c in counts), pa.array(shas, pa.string()), pa.array(alls, pa.string())],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
