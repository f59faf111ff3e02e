"""Filter audit, importance resampling and sharding: SQL twins, brute force and odd tables."""

import math
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pytest

import __spark_entry__ as E
from oracle import compare, duck
from riskframe.llm import audit, resample, sharding

NEW = ["op11_filter_audit", "op12_importance_resampling", "op13_sharding"]
LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize("name", NEW)
def test_sql(spark, small, name):
    r = compare(E.queries()[name](spark, small), duck(small), E.oracle_sql()[name])
    assert r["cols_match"] and r["types_match"] and r["hash_match"], r


def simulated(docs, labels):
    """Orders applied one document after another."""
    def fails(i, text):
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        e = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs)
        return {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                "D": bool(re.search(r"[#$%&*|]", t)), "E": e}
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    out, parts = {}, {(s or "") for _, _, s in docs}
    for part in parts:
        own = [(i, fails(i, t)) for i, t, s in docs if (s or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        for o in permutations("ABCDE"):
            left = own
            for k, c in enumerate(o):
                gone = [x for x in left if x[1][c]]
                left = [x for x in left if not x[1][c]]
                total[c] += len(gone)
                out[part, "".join(o), k + 1] = [len(left), len(gone), sum(x[1][c] for x in own) - len(gone),
                                               sum(x[1][c] and sum(x[1].values()) == 1 for x in own),
                                               sum(x[0] in good and x[0] is not None for x in gone), sum(x[0] in toxic and x[0] is not None for x in gone)]
        for o in permutations("ABCDE"):
            for k, c in enumerate(o):
                out[part, "".join(o), k + 1].append(total[c])
    return out


def test_audit_against_simulation(spark, odd):
    rng = random.Random(3)
    words = ["a", "b", "Cat", "DOG", "5%", "x#", "tea", "é"] + [f"w{i}" for i in range(300)]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([0, 3, 30, 250, 400]))), rng.choice(["s", "t", "", None])) for i in range(60)]
    docs += [(100 + i, docs[i % 7][1], "u") for i in range(20)] + [(3, docs[3][1], "s"), (None, docs[0][1], "s"), (None, None, None), (200, "", "t"), (201, None, "t")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 100, 2)] + [(4, 1, 1), (None, 1, 1), (999, 1, 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = audit.op11(d.withColumns({c: d.doc_id for c in ("id", "part", "digest", "n", "first")}), spark.createDataFrame(labels, LABELS))
    rows = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in audit.COUNTS] for r in got.collect()}
    assert rows == simulated(docs, labels)


def test_potentials_give_shapley_values():
    v = np.random.default_rng(1).integers(0, 1000, (4, audit.ALL + 1)).cumsum(-1)
    v[:, 0] = 0
    q = audit.potentials(v)
    for i in range(5):
        want = np.zeros(4, np.int64)
        for o in permutations(range(5)):
            before = sum(1 << j for j in o[:o.index(i)])
            want += v[:, before | 1 << i] - v[:, before]
        assert (q[:, audit.ALL] - 5 * q[:, audit.ALL ^ 1 << i] == want).all()


def words_of(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def test_payloads_of_hostile_texts(monkeypatch):
    monkeypatch.setattr(resample, "SLICE", 300)
    texts = ["", " ", "a a b a", "A-b.C d", "x" * 5000 + " y " + "x" * 5000, "é中 \x01" + "7 \x011 \x010", "q" * 256 + " " + "q" * 257,
             "ab abc bc " * 200, "Ünï Ü", "\x00\x01", "z" * 300 + "-" + "z" * 299]
    rng = random.Random(5)
    texts += ["".join(rng.choices("abAB  -\x01é中1\n", k=rng.randint(0, 900))) for _ in range(60)]
    got = resample.payloads(texts)
    for t, p in zip(texts, got):
        w = [x.encode() for x in words_of(t)]
        assert p.tolist() == [zlib.crc32(x) | len(x) << 32 for x in w]


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_runs_compose(longest):
    rng = random.Random(longest)
    for n in (0, 1, 2, 3, 50):
        w = ["".join(rng.choices("abcé7", k=rng.randint(1, 40))) for _ in range(n)]
        p = np.array([zlib.crc32(x.encode()) | len(x.encode()) << 32 for x in w], np.int64)
        want = [zlib.crc32(" ".join(w[i:i + k]).encode()) for k in range(1, longest + 1) for i in range(n - k + 1)]
        assert resample.runs(p, longest, resample._steps()).tolist() == want


def test_resampling_against_brute_force(spark, odd):
    import hashlib
    docs = [(i, f"word{i % 7} " * (i % 40) + "the cat" * (i % 3), f"s{i % 2}") for i in range(400)] + [(401, None, None), (402, "", "s"), (7, "the cat " * 30, "s")]
    bench = [(1, "the cat sat"), (2, None), (3, "word3 word4")]
    got = resample.op12(spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("rank", resample.F.lit(1)),
                        spark.createDataFrame(bench, "item_id long, text string")).collect()
    n = 10_000
    s, t = np.zeros(n), np.zeros(n)
    for _, x, _ in docs:
        for w in words_of(x):
            s[zlib.crc32(w.encode()) % n] += 1
    for _, x in bench:
        for w in words_of(x):
            t[zlib.crc32(w.encode()) % n] += 1
    rows = []
    for i, x, _ in docs:
        w = words_of(x)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (s.sum() + n) / ((s[b] + 1) * (t.sum() + n)))) for b in (zlib.crc32(y.encode()) % n for y in w))
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(w), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    long = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[3], r[0], r[2], r[1]))
    rank = {r: k + 1 for k, r in enumerate(long[:10 * len(long) // 100])}
    assert sorted(map(str, got)) == sorted(str(resample_row(r, rank.get(r))) for r in rows)
    kept = resample.drawn(spark.createDataFrame(docs, "doc_id long, text string, source string"), spark.createDataFrame(bench, "item_id long, text string"))
    assert {r[0] for r in kept.collect()} == {r[0] for r in rank} and kept.columns == ["doc_id", "text", "source"]


def resample_row(values, rank):
    from pyspark.sql import Row
    return Row(**dict(zip(("doc_id", "n_features", "weight", "score", "rank"), (*values, rank))))


def test_shards_match_the_mixture(spark):
    docs = [(i, "same" if i % 3 else f"t{i}é", ["hot", "hot", "b", None, ""][i % 5]) for i in range(1003)]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in sharding.op13(d.withColumns({c: d.doc_id for c in ("key", "size", "p", "r", "stratum", "shard")})).collect()}
    assert len(got) == len(docs)
    per = [[i for i in got if got[i]["shard"] == k] for k in range(8)]
    assert max(map(len, per)) - min(map(len, per)) <= 1
    for k in range(8):
        assert sorted(got[i]["slot"] for i in per[k]) == list(range(len(per[k])))
    for s in {x[2] for x in docs}:
        n = [sum(1 for i in p if docs[i][2] == s) for p in per]
        assert max(n) - min(n) <= 2, (s, n)
    for i, t, _ in docs:
        assert got[i]["size"] == len(t.encode()) + 1 and got[i]["text_crc32"] == zlib.crc32(t.encode())
        assert got[i]["law"] == "rows" and got[i]["grown_shard"] is None


def test_odd_rows_and_empty_tables(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 1), (5, None, None)], LABELS)
    bench = spark.createDataFrame([(1, "the cat"), (None, None)], "item_id long, text string")
    ids = sorted(str(r["doc_id"]) for r in odd.select("doc_id").collect())
    for op in (lambda d, e: resample.op12(d, e), lambda d, e: sharding.op13(d)):
        assert sorted(str(r["doc_id"]) for r in op(odd, bench).collect()) == ids
        assert op(odd.limit(0), bench).collect() == []
        assert len(op(odd, bench.limit(0)).collect()) == len(ids)
    got = {r["doc_id"]: r for r in sharding.op13(odd).collect()}
    assert got[1]["size"] == got[2]["size"] == 1 and got[1]["text_crc32"] == 0
    got = {r["doc_id"]: r for r in resample.op12(odd, bench).collect()}
    assert got[1]["n_features"] == got[2]["n_features"] == got[6]["weight"] == 0 and got[2]["rank"] is None
    rows = audit.op11(odd, labels).where("filter_order = 'ABCDE' and step = 5").collect()
    assert {r["part"] for r in rows} == {"", "s"}
    assert audit.op11(odd.limit(0), labels).collect() == [] and audit.op11(odd, labels.limit(0)).count() == 2 * 600
