"""Boosted trees on histograms against a plain one-process version."""

import math
import os
import subprocess
import sys
import threading

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from riskframe.operators import boosting as B
from riskframe.plans import catalog_ml as C

SCHEMA = "id long, y int, a double, b double, c double"


def _data(n=700, seed=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n).round(2), rng.integers(0, 9, n), rng.exponential(size=n).round(1)]).astype(float)
    p = 1 / (1 + np.exp(-(1.5 * x[:, 0] * (x[:, 1] > 4) + x[:, 2] - 1)))
    return x, (rng.random(n) < p).astype(int), p


def _frame(spark, x, y):
    return spark.createDataFrame([(i, int(b), *map(float, a)) for i, (a, b) in enumerate(zip(x, y))], SCHEMA).repartition(5)


def _plain_tree(codes, g, h, columns, s):
    """Best-first growth, one leaf after another, every histogram counted from its rows."""
    def split(rows):
        hist = B.histogram(codes[rows][:, columns], np.zeros(len(rows), int), g[rows], h[rows], 1, s.bins)[0]
        return B.best_split(hist, s)

    def leaf(rows):
        a, b = g[rows].sum() / B.SCALE, h[rows].sum() / B.SCALE
        return -a / (b + s.regularisation) * s.rate
    root = {"rows": np.arange(len(g)), "depth": 0}
    leaves, made = [root], 1
    while s.max_leaves is None or made < s.max_leaves:
        open_ = [(-split(x["rows"])[0], k) for k, x in enumerate(leaves) if s.max_depth is None or x["depth"] < s.max_depth]
        open_ = [o for o in open_ if o[0] < 0]
        if not open_:
            break
        x = leaves[min(open_)[1]]
        _, f, b = split(x["rows"])
        left = codes[x["rows"], columns[f]] <= b
        x["split"] = (int(columns[f]), b)
        x["kids"] = [{"rows": x["rows"][left], "depth": x["depth"] + 1}, {"rows": x["rows"][~left], "depth": x["depth"] + 1}]
        leaves = [y for y in leaves if y is not x] + x["kids"]
        made += 1
    value = np.zeros(len(g))
    for x in leaves:
        value[x["rows"]] = leaf(x["rows"])

    def listed(x):
        return (x["split"], *map(listed, x["kids"])) if "kids" in x else round(leaf(x["rows"]), 12)
    return listed(root), value


def _listed(t, i=0):
    return ((int(t.feature[i]), int(t.bin[i])), _listed(t, t.left[i]), _listed(t, t.right[i])) if t.feature[i] >= 0 else round(float(t.value[i]), 12)


@pytest.mark.parametrize("collect", [0, 1 << 25])
@pytest.mark.parametrize("settings", [
    B.Boosting(rounds=4, max_depth=4, bins=16),
    B.Boosting(rounds=4, max_depth=None, max_leaves=9, regularisation=0.0, min_hessian=1e-3, min_rows=20, bins=32),
    B.Boosting(rounds=3, max_depth=3, row_share=0.7, column_share=0.7, bins=16),
], ids=["depth", "leaf", "sampled"])
def test_trees_equal_the_plain_version(spark, settings, collect, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_ROWS", 64)
    monkeypatch.setattr(B, "REFRESH", 2)
    monkeypatch.setattr(B, "COLLECT_BYTES", collect)
    x, y, _ = _data()
    df = _frame(spark, x, y)
    model = B.fit(df, ["a", "b", "c"], "y", "id", settings)
    ids = np.array([r["h"] for r in df.select("id", F.xxhash64("id").alias("h")).orderBy("id").collect()])
    codes = model.codes(x)
    assert model.base == pytest.approx(math.log(y.mean() / (1 - y.mean())))
    m = np.full(len(y), model.base)
    for number, tree in enumerate(model.trees):
        take = B.drawn(ids, number, settings.seed, settings.row_share)
        columns = B.columns_of(number, 3, settings)
        g, h = B.gradients(m, y)
        want, _ = _plain_tree(codes[take], g[take], h[take], columns, settings)
        assert _listed(tree) == want, number
        m = m + tree.value[tree.leaves(codes)]
    p = np.array([r[1] for r in B.predict(df, model, ["id"]).orderBy("id").collect()])
    assert np.allclose(p, 1 / (1 + np.exp(-m)), atol=1e-12)
    if settings.max_leaves:
        assert all((t.feature < 0).sum() <= settings.max_leaves for t in model.trees)


def test_trees_do_not_depend_on_how_rows_are_dealt(spark):
    x, y, _ = _data(400, 3)
    s = B.Boosting(rounds=3, max_depth=None, max_leaves=6, bins=16, row_share=0.8)
    df = _frame(spark, x, y)
    a, b = (B.fit(d, ["a", "b", "c"], "y", "id", s) for d in (df, df.repartition(2, "b").sort("a")))
    assert [_listed(t) for t in a.trees] == [_listed(t) for t in b.trees]


def test_learns_and_handles_odd_tables(spark):
    x, y, p = _data(1500, 5)
    df = _frame(spark, x, y)
    model = B.fit(df, ["a", "b", "c"], "y", "id", B.Boosting(rounds=25, max_depth=None, max_leaves=8))
    got = np.array([r[1] for r in B.predict(df, model, ["id"]).orderBy("id").collect()])
    ordered = lambda score: np.mean(score[y == 1][:, None] > score[y == 0][None])
    assert ordered(got) > ordered(p) - 0.02   # about as good as the probabilities that the labels were drawn from
    one = B.fit(df.withColumn("y", F.lit(1)), ["a"], "y", "id", B.Boosting(rounds=2))
    assert B.predict(df, one, ["id"]).where("probability > 0.99").count() == 1500
    assert B.fit(df, [], "y", "id", B.Boosting(rounds=2)).base == pytest.approx(model.base)
    empty = B.fit(df.limit(0), ["a"], "y", "id", B.Boosting(rounds=2))
    assert B.predict(df.limit(0), empty, ["id"]).collect() == []
    nulls = B.fit(df.withColumn("a", F.expr("if(id % 3 = 0, null, a)")), ["a", "b"], "y", "id", B.Boosting(rounds=2))
    assert B.predict(df.withColumn("a", F.lit(None).cast("double")), nulls, ["id"]).count() == 1500


def test_nodes_that_stay_leaves_take_no_pass(spark, monkeypatch):
    """Their sums stand in the parent's histogram: a tree of depth 3 takes three passes, one of two leaves takes one."""
    passes, counted = [], B._counted
    monkeypatch.setattr(B, "_counted", lambda *a: passes.append(a[-2]) or counted(*a))
    x, y, _ = _data(600, 7)
    df = _frame(spark, x, y)
    deep = B.fit(df, ["a", "b", "c"], "y", "id", B.Boosting(rounds=2, max_depth=3, bins=16))
    assert passes == [0] * 3 + [1] * 3 and all((t.feature < 0).sum() > 4 for t in deep.trees)
    passes.clear()
    B.fit(df, ["a", "b", "c"], "y", "id", B.Boosting(rounds=2, max_depth=None, max_leaves=2, bins=16))
    assert passes == [0, 1]


@pytest.mark.parametrize("collect", [0, 1 << 25])
def test_small_nodes_travel_as_rows(spark, collect, monkeypatch):
    """Nothing below them takes a pass, and the trees are those that passes give."""
    monkeypatch.setattr(B, "COLLECT_BYTES", collect)
    passes, counted = [], B._counted
    monkeypatch.setattr(B, "_counted", lambda *a: passes.append(a[-2]) or counted(*a))
    x, y, _ = _data(400, 11)
    df = _frame(spark, x, y)
    s = B.Boosting(rounds=3, max_depth=None, max_leaves=25, regularisation=0.0, min_hessian=1e-3, row_share=0.9)
    assert B.few_rows(3, s) > 400
    a = B.fit(df, ["a", "b", "c"], "y", "id", s)
    assert passes == [0, 0, 1, 1, 2, 2] and all((t.feature < 0).sum() > 12 for t in a.trees)
    passes.clear()
    monkeypatch.setattr(B, "few_rows", lambda columns, s: -1)
    b = B.fit(df, ["a", "b", "c"], "y", "id", s)
    assert len(passes) > 9 and [_listed(t) for t in a.trees] == [_listed(t) for t in b.trees]


def test_a_model_loads_where_the_package_is_not():
    model = B.Model(["a"], [np.array([0.5])], 0.25)
    code = "import pickle, sys; print(pickle.load(sys.stdin.buffer).base)"
    got = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(model), capture_output=True, cwd="/",
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert got.stdout.strip() == b"0.25", got.stderr


def test_prediction_ships_the_class_of_a_model(spark, monkeypatch):
    sent, broadcast = [], spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda x: sent.append(x) or broadcast(x))
    df = _frame(spark, *_data(20, 2)[:2])
    assert B.predict(df, B.Model(["a"], [np.zeros(0)], 0.0), ["id"]).where("probability = 0.5").count() == 20
    assert all(isinstance(x, bytes) for x in sent) and sent


def test_the_models_of_the_runs_are_fitted_at_the_same_time(spark, monkeypatch):
    together = threading.Barrier(3, timeout=20)

    def run(spark, d, name):
        together.wait()
        return spark.createDataFrame([(name,)], "model string")

    monkeypatch.setattr(C, "_prepared", lambda spark, d: None)
    monkeypatch.setattr(C, "_run", run)
    assert [r[0] for r in C._runs(spark, "").collect()] == ["gbt_a", "gbt_b", "iforest"]


def test_joint_codes_give_each_feature_its_own_sums():
    """Sums over joint codes, packed in parts, are the plain ones; no code has more than JOINT values."""
    rng = np.random.default_rng(4)
    sizes, n = [64, 3, 64, 26, 1, 6, 256], 3 * B.PACKED_ROWS + 11
    joint = B.Joint([np.arange(z - 1.0) for z in sizes])
    assert max(joint.values) <= B.JOINT and len(joint.groups) < len(sizes)
    raw = np.column_stack([rng.integers(0, z, n) for z in sizes]).astype(np.uint8)
    codes, columns = joint.joined(raw), [0, 2, 3, 4, 6]
    g, h = rng.integers(-B.SCALE, B.SCALE, n).astype(np.int32), np.full(n, B.SCALE // 4, np.int32)   # the largest hessians there are
    h[rng.random(n) < 0.3] = -1   # not drawn
    tree = B.Tree(np.array([3, -1, -1]), np.array([9, 0, 0]), np.array([1, 0, 0]), np.array([2, 0, 0]), np.zeros(3))
    got = B._count([(codes, (None, g, h))], joint, columns, tree.arrays(), {1: 0}, {2: 0}, 256)
    for leaf, side in ((1, raw[:, 3] <= 9), (2, raw[:, 3] > 9)):
        use = side & (h >= 0)
        want = B.histogram(raw[use][:, columns], np.zeros(use.sum(), int), g[use], h[use], 1, 256)
        if leaf == 1:
            assert np.array_equal(np.concatenate([x for c, x in got if c >= 0], axis=1), want)
        else:
            own, gs, hs = next(x for c, x in got if c < 0)
            assert np.array_equal(B.histogram(own.T, np.zeros(len(gs), int), gs, hs, 1, 256), want)


def test_what_a_pass_sends_is_small_and_rows_are_prepared_once(spark, monkeypatch):
    """Functions go out once, in a broadcast; fits of the same rows share their blocks."""
    x, y, _ = _data(300, 9)
    df = _frame(spark, x, y)
    sent, remote, made, edges = [], B._remote, [], B.quantile_edges
    monkeypatch.setattr(B, "_remote", lambda *a: sent.append(remote(*a)) or sent[-1])
    monkeypatch.setattr(B, "quantile_edges", lambda *a: made.append(1) or edges(*a))
    data = B.Binned(df, ["a", "b", "c"], "y", "id", 16)
    settings = [B.Boosting(rounds=2, max_depth=3, bins=16, row_share=0.8), B.Boosting(rounds=2, max_depth=None, max_leaves=5, bins=16)]
    shared = [B.fit(df, ["a", "b", "c"], "y", "id", s, data) for s in settings]
    assert len(made) == 1 and sent and max(len(cloudpickle.dumps(f)) for f in sent) < 6000
    data.release()
    for s, model in zip(settings, shared):
        own = B.fit(df, ["a", "b", "c"], "y", "id", s)
        assert [_listed(t) for t in own.trees] == [_listed(t) for t in model.trees]
    with pytest.raises(ValueError):
        B.fit(df, ["a", "b"], "y", "id", settings[0], data)


def test_forest_paths_equal_the_plain_ones():
    """Padded trees give the path lengths of a walk from the root, whatever the block."""
    from riskframe.operators import iforest as IF
    rng = np.random.default_rng(6)
    data = np.column_stack([rng.normal(size=200), rng.integers(0, 3, 200), np.ones(200)])
    x = np.vstack([data, [[np.inf, 0, 1], [-np.inf, 9, 1]], rng.normal(size=(IF.SCORED_ROWS, 3))])
    trees, want = [], np.zeros(len(x))
    for k, rows in enumerate((200, 37, 2, 1)):
        t = [np.array(c) for c in zip(*IF._grow(data[:rows], np.random.default_rng(k), 8))]
        trees.append(IF._padded(*t))
        for i, r in enumerate(x):
            at = depth = 0
            while t[0][at] >= 0:
                at, depth = (t[2] if r[t[0][at]] < t[1][at] else t[3])[at], depth + 1
            want[i] += depth + IF.c_factor(float(t[4][at]))
    assert np.array_equal(IF._lengths(x, trees), want)
