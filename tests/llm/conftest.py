import zlib

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def fold(i, m):
    return zlib.crc32(str(i).encode()) % m


@pytest.fixture(scope="session")
def small():
    from conftest import SF_SMALL
    return SF_SMALL


@pytest.fixture(scope="session")
def texts(spark, small):
    """doc_id -> text of the small documents."""
    return {r[0]: r[1] or "" for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, empty and long texts, ties and repeated rows, and clashing extra columns."""
    long = "the cat sat on a mat and " * 3000
    line = "Anna wrote to bob@example.com about the card 4111 1111 1111 1111 on monday morning"
    rows = [(1, None, "en", None, None), (2, "", None, "s", 0), (3, long, "en", "s", len(long)), (4, long, "en", "s", len(long)),
            (5, line, "en", "s", 1), (5, line, "en", "s", 1), (None, line + " again", None, None, None), (None, None, None, None, None),
            (6, " \t\n ", "en", "s", 4), (7, "x" * 5000, "de", "s", 5000), (8, "é中\x00<|endoftext|> á ok", "fr", "s", 9), (9, "idiot", "en", "s", 5)]
    d = spark.createDataFrame(rows, DOCS)
    extra = {c: d.doc_id for c in ("row", "key", "sig", "block", "score", "id", "n", "words", "component", "__keep", "a", "b")}
    return d.withColumns(extra)
