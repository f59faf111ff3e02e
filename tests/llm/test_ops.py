"""The contract queries against brute force on the small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
from conftest import SF_MID
from oracle import compare, duck

QUERIES, ORACLE = E.queries(), E.oracle_sql()


def fold(i, m):
    return zlib.crc32(str(i).encode()) % m


def rows(spark, name, d):
    df = QUERIES[name](spark, d)
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.parametrize("name", ["op2_ngram_jaccard", "op4_embedding_pq", "op9_quality_rules"])
def test_sql(spark, small, name):
    r = compare(QUERIES[name](spark, small), duck(small), ORACLE[name])
    assert r["cols_match"] and r["types_match"] and r["hash_match"], r


def test_all_ten_registered():
    assert all(any(n.startswith(f"op{k}_") for n in QUERIES) for k in range(1, 11)) and "pipeline" in QUERIES


def test_pii_base_spans(spark, small, texts):
    def luhn(g):
        return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(g))) % 10 == 0
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    got = rows(spark, "op6_pii", small)
    for i, t in texts.items():
        want = []
        for kind, p in patterns.items():
            for m in re.finditer(p, t):
                g = re.sub("[^0-9]", "", m[0])
                if kind == "email" or kind == "ip" and max(map(int, m[0].split("."))) <= 255 \
                        or kind == "card" and 16 <= len(g) <= 19 and luhn(g) or kind == "phone" and 8 <= len(g) <= 15:
                    want.append(f"{kind}:{m.start()}:{m.end()}")
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(got[i]["spans"].split(",")) | {""}
        assert sum(got[i][f"n_{k}"] for k in patterns) == len(want)


def test_pii_hostile_texts():
    from riskframe.llm.pii import find_spans, mod97, redact_text
    t = "a@b@c.de x..y@z.com. 1.2.3.4.5.6.7.8 999.1.1.1 IBAN DE89 3704 0044 0532 0130 00 ssn 123-45-6789 id 123-45-6780"
    base = [(k, t[s:e]) for k, s, e, _ in find_spans(t)]
    assert ("email", "b@c.de") in base and ("email", "x..y@z.com") in base
    assert [x for k, x in base if k == "ip"] == ["1.2.3.4", "5.6.7.8"]
    assert ("iban", "DE89 3704 0044 0532 0130 00") in base and mod97("DE89370400440532013000")
    assert ("ssn", "123-45-6789") in base
    assert "[EMAIL]" in redact_text(t) and "c.de" not in redact_text(t)
    assert find_spans("1" * 200_000) == [] and len(find_spans("9@" * 50_000)) == 0  # linear time


def test_language_identification_held_out(spark, small):
    got = rows(spark, "op7_language_id", small)
    lang = {r[0]: r[1] for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang").collect()}
    held = [i for i in got if fold(i, 4) == 2]
    assert all(got[i]["held_out"] == (fold(i, 4) == 2) for i in got)
    assert np.mean([got[i]["lang_pred"] == lang[i] for i in held]) > 0.95


def test_bpe_equals_the_library(spark, small, texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = rows(spark, "op8_bpe", small)
    for i, x in texts.items():
        ids = t.encode(x, add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_trees_and_spread_texts(spark):
    from riskframe.llm import bpe
    t, c = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), bpe.codec(bpe.vocabulary())
    rng = np.random.default_rng(5)
    parts = ["a", "the", "ing", "é", "中", "1", "23", "##", ".", "\n", "  ", " ", "'s", "<|endoftext|>", "lololo", "\x1c", "\xa0"]
    made = ["".join(rng.choice(parts, rng.integers(1, 900))) for _ in range(40)]
    made += ["\n\n".join("w%d" % k for k in range(n)) + "\n\n" + "q" * 900 for n in (60, 231, 500)]
    made += ["".join(rng.choice(list("abc"), 6000)) for _ in range(5)] + ["ab" * 4000, "z" * 3000, "\n" * 2000, "中" * 2000]
    for x in made:
        assert c.encode(x) == t.encode(x, add_special_tokens=False).ids
    old, bpe.PART_CHARS = bpe.PART_CHARS, 700
    try:  # every text is spread over parts and leaves
        df = spark.createDataFrame([(k, x) for k, x in enumerate(made)], "doc_id long, text string")
        got = {r["doc_id"]: np.frombuffer(r["ids"], np.int32).tolist() for r in bpe.encode(df, long_chars=0).collect()}
    finally:
        bpe.PART_CHARS = old
    for k, x in enumerate(made):
        assert got[k] == t.encode(x, add_special_tokens=False).ids
    back = bpe.decode(bpe.encode(df))
    assert {r["doc_id"]: r["text"] for r in back.collect()} == dict(enumerate(made))


def test_packing(spark, small, texts):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = QUERIES["op10_packing"](spark, small).toPandas()
    for i, g in got.sort_values("start").groupby("doc_id"):
        ids, at = np.array(t.encode(texts[i], add_special_tokens=False).ids + [2], "<u4"), 0
        for p in g.itertuples():
            assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    assert set(got.doc_id) == set(texts)
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all()
    size = got.groupby("sequence_id").length.sum()
    assert size.max() <= 4096
    assert sum(0 if n & (n - 1) == 0 else 4096 - n for n in size) < 0.05 * size.sum() + 4096 * 8
    first = got.sort_values(["doc_id", "start"])
    assert first.groupby("sequence_id", sort=False).doc_id.min().is_monotonic_increasing  # order is kept


def test_packing_words_equal_the_library():
    from riskframe.llm import packing
    t, w = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), packing.WordIds(packing.vocabulary())
    made = ["The CAT's don't.  Stop!! x\x85y", "ÉCOLE Σίσυφος İstanbul é a.̸b", "<|endoftext|>a<|ENDOFTEXT|> <|startoftext|>", "", " \n", "日本 x1y2 €5_a"]
    ids, n = w.encode(made)
    want = [t.encode(x, add_special_tokens=False).ids + [2] for x in made]
    assert ids.tolist() == sum(want, []) and n.tolist() == list(map(len, want))


def test_packing_cuts_are_optimal():
    from riskframe.llm.packing import SEQUENCE_COST, SMALLEST_POWER, cut_windows
    rng = np.random.default_rng(3)
    for _ in range(30):
        at = np.concatenate([[0], np.cumsum(rng.integers(1, 400, 25))])
        cost = rng.choice([0, 8, 256], len(at))
        most = 512
        price = lambda n: 0 if n >= SMALLEST_POWER and n & (n - 1) == 0 else most - n
        best = [0] + [10 ** 9] * (len(at) - 1)
        for j in range(1, len(at)):
            best[j] = min(best[i] + price(int(at[j] - at[i])) for i in range(j) if at[j] - at[i] <= most) + int(cost[j]) + SEQUENCE_COST
        path = cut_windows(at, cost, most)
        total = sum(price(int(at[j] - at[i])) + int(cost[j]) + SEQUENCE_COST for i, j in zip(path, path[1:]))
        assert total == best[-1] and path[0] == 0 and path[-1] == len(at) - 1


def test_language_model_base(spark, small, texts):
    got = rows(spark, "op5_lm_scoring", small)
    tokens = {i: x.encode().lower().split() + [None] for i, x in texts.items()}
    c = Counter(w for i, ws in tokens.items() if fold(i, 5) != 1 for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tokens.items():
        assert got[i]["held_out"] == (fold(i, 5) == 1)
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert got[i]["base_score"] == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), abs=1e-6)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_language_model_counts(spark):
    """Scores equal a dictionary model with the same weights; probabilities of a context add up to one."""
    from pyspark.sql import functions as F
    from riskframe.llm import lm
    texts = ["a b a b c", "a b d", "c", "", "b a b"] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = {}
    fit = lm.fit_weights
    lm.fit_weights = lambda *x: kept.setdefault("w", fit(*x))
    try:
        got = {r["doc_id"]: r["score"] for r in lm.score_corpus(df, F.col("doc_id") < 10).collect()}
    finally:
        lm.fit_weights = fit
    one, two = Counter(), Counter()
    seqs = [["<s>", *t.split(), "</s>"] for t in texts]
    for s in seqs[:10]:
        one.update(s[1:])
        two.update(zip(s, s[1:]))
    n, v = sum(one.values()), len(one)
    ctx = {**one, "<s>": 10}
    for i, s in enumerate(seqs):
        total = 0.0
        for x, y in zip(s, s[1:]):
            w = kept["w"][min(int(math.log2(ctx.get(x, 0) + 1)), lm.CONTEXTS - 1)]
            total += math.log10(w[0] * (two[x, y] / ctx[x] if ctx.get(x) else 0) + w[1] * one[y] / n + w[2] / (v + 1))
        assert got[i] == pytest.approx(total, abs=1e-9)


def test_toxicity_held_out(spark):
    got = rows(spark, "op1_toxicity", SF_MID)
    label = {r[0]: r[1] for r in spark.read.parquet(f"{SF_MID}/labels.parquet").select("doc_id", "toxic").collect()}
    assert all(got[i]["held_out"] == (fold(i, 5) == 0) for i in got)
    pos = [got[i]["score"] for i in got if got[i]["held_out"] and label.get(i) == 1]
    neg = [got[i]["score"] for i in got if got[i]["held_out"] and label.get(i) == 0]
    assert np.mean([p > q for p in pos for q in neg]) > 0.8
    assert np.mean([q >= 0.5 for q in neg]) < 0.05


def test_toxicity_counterfactual_penalty(spark):
    from riskframe.llm import toxicity
    rng = np.random.default_rng(1)
    filler = [f"word{chr(97 + k)}x" for k in range(26)]
    texts, labels = [], []
    for k in range(300):
        toxic = k % 3 == 0
        words = [*rng.choice(filler, 6), *["scum"] * toxic, *["muslim"] * bool(rng.random() < (0.6 if toxic else 0.1))]
        texts.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    d, lab = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    def gap(strength):
        old, toxicity.FAIRNESS = toxicity.FAIRNESS, strength
        try:
            w, _ = toxicity.train(d, lab)
        finally:
            toxicity.FAIRNESS = old
        value = lambda x: sum(w.get(f, 0) for f in toxicity.features({x}))
        return abs(value("muslim") - value("christian")), value("scum")
    free, bound = gap(0.0), gap(1.0)
    assert bound[0] < 0.35 * free[0] and bound[1] > 1


def test_license_places(spark, small, texts):
    from riskframe.llm.license import TEMPLATES, Scanner, align
    got = rows(spark, "op3_license_scan", small)
    lines = {k: TEMPLATES[k] for k in ("Apache-2.0", "CC-BY-NC-4.0", "GPL-3.0", "MIT")}
    for i, t in texts.items():
        assert {p.split(":")[0] for p in got[i]["places"].split(",") if p} == {k for k, v in lines.items() if v in t}
    s = Scanner(TEMPLATES)
    found = s.scan("foo " + TEMPLATES["MIT-text"] + " bar " + TEMPLATES["MIT"] + " x " + TEMPLATES["MIT"])
    assert [(k, c) for k, c, *_ in found] == [("MIT", 1.0), ("MIT", 1.0), ("MIT-text", 1.0)]
    t = re.findall(r"[^\W_]+", TEMPLATES["ISC"].lower())
    assert len(align(t, [w for k, w in enumerate(t) if k % 10])) == len(t) - len(range(0, len(t), 10))


def brute_components(sets):
    """Smallest id reachable by links, by all pairs."""
    ids, root = sorted(sets), {i: i for i in sets}
    def find(v):
        while root[v] != v:
            v = root[v]
        return v
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in sets}


def test_jaccard_long_lists(spark):
    """Groups of many near copies, a passage that many texts share, and very short texts, against all pairs."""
    from riskframe.llm import jaccard
    rng = np.random.default_rng(11)
    made = []
    base = [f"w{k}" for k in range(60)]
    for k in range(120):  # chains of near copies, far fewer links than pairs
        w = list(base)
        for p in rng.choice(60, rng.integers(0, 4), replace=False):
            w[p] = f"x{rng.integers(10 ** 6)}"
        made.append(" ".join(w))
    passage = [f"p{k}" for k in range(20)]
    for k in range(60):
        made.append(" ".join(passage + [f"y{rng.integers(10 ** 6)}" for _ in range(rng.integers(1, 60))]))
    made += ["a b", "A b", "a b c d e", "a b c d e f", "", " ", "a b"]
    sets = {}
    for i, t in enumerate(made):
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    df = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in jaccard.groups(df).collect()}
    want = brute_components(sets)
    assert {i: got[i]["component_id"] for i in sets} == want
    assert {i: got[i]["n_shingles"] for i in sets} == {i: len(s) for i, s in sets.items()}


def test_components_of_a_chain_and_a_star(spark):
    from riskframe.llm.common import components
    links = [(i, i + 1) for i in range(50)] + [(1000, 1000 + k) for k in range(1, 60)] + [(3, 3), (7, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {1000 + k: 1000 for k in range(60)}


def test_pq_recall_and_bad_vectors(spark):
    from riskframe.llm import pq
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    noise = rng.normal(size=(900, 32))
    near = x[:900] + noise / np.linalg.norm(noise, axis=1, keepdims=True) * rng.uniform(0, 0.32, (900, 1))
    data = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, near]))]
    data += [(5000, None), (5001, [0.0] * 32), (5002, [float("nan")] * 32), (5003, [1.0] * 8), (5004, data[0][1]), (5005, [None] * 32), (5006, [])]
    got = {r["vec_id"]: r for r in pq.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()}
    v = np.array([d[1] for d in data[:2400]] + [data[0][1]])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    links = ((v @ v.T) >= 0.95).sum(1) - 1
    found = np.array([got[d[0]]["n_links"] for d in data[:2400]] + [got[5004]["n_links"]])
    assert (found <= links).all() and found.sum() >= 0.97 * links.sum()
    assert got[5004]["component_id"] == 0 and not got[5004]["kept"]
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (5000, 5001, 5002, 5003, 5005, 5006)) and len(got) == len(data)


def test_small_tables_are_not_a_file_for_every_partition(spark, texts, monkeypatch):
    """Rounds of components, overlaps and kept ids are written by as many tasks as run at a time, whatever the shuffle partitions; texts take no shuffle."""
    from pathlib import Path

    from riskframe.llm import common, jaccard

    paths, scratch = [], common.scratch_path
    monkeypatch.setattr(common, "scratch_path", lambda *a: paths.append(scratch(*a)) or paths[-1])
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    near = [(f"{t} {k}") for t in list(texts.values())[:60] for k in range(3)]
    df = spark.createDataFrame(list(enumerate(near)), "doc_id long, text string").repartition(2)
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        kept = jaccard.keep_one(df)
        n = {p: len([*Path(p.removeprefix("file:")).glob("part-*")]) for p in paths}
        assert any("llm-cc" in p for p in n) and any("jaccard-overlaps" in p for p in n)
        assert max(n.values()) <= spark.sparkContext.defaultParallelism, n
        plan = kept._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert 0 < kept.count() < len(near)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
