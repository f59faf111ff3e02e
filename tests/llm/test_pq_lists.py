"""Recall, symmetry and list sizes of the vector index with many lists, on one and two levels."""

import numpy as np
import pyarrow as pa
import pytest

from riskframe.llm import pq


def made(n, d=32, seed=2):
    """Random unit vectors and one near copy of each, at any distance up to the threshold and a little beyond."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    noise = rng.normal(size=(n, d))
    near = x + noise / np.linalg.norm(noise, axis=1, keepdims=True) * rng.uniform(0, 0.36, (n, 1))
    v = np.concatenate([x, near, x[:n // 10]])
    return v


def links(v):
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    c = u @ u.T
    np.fill_diagonal(c, -1)
    return c >= pq.COSINE


@pytest.mark.parametrize("coarse, size", [(1024, 8), (24, 16)], ids=["one level, many lists", "two levels"])
def test_recall_and_symmetry_with_many_lists(spark, monkeypatch, coarse, size):
    monkeypatch.setattr(pq, "MAX_COARSE", coarse)
    monkeypatch.setattr(pq, "LIST_SIZE", size)
    monkeypatch.setattr(pq, "BLOCK_ROWS", 64)
    monkeypatch.setattr(pq, "BLOCK_QUERIES", 128)
    v = made(2200)
    want = links(v)
    q = pq.Quantizers(v[:2000].tolist(), {32: len(v)}).of[32][0]
    assert len(q) >= len(v) // size - coarse and (len(q.fine) > 1) == (coarse < 100)
    got = {r["vec_id"]: r for r in pq.near_duplicates(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")).collect()}
    n = np.array([got[i]["n_links"] for i in range(len(v))])
    assert (n <= want.sum(1)).all() and n.sum() % 2 == 0                  # no link below the threshold; each is counted at both ends
    assert n.sum() >= 0.9 * want.sum()                                    # recall against brute force
    linked = [i for i in range(len(v)) if got[i]["component_id"] != i or n[i]]
    sizes = {}
    for i in linked:
        sizes.setdefault(got[i]["component_id"], []).append(i)
    for c, members in sizes.items():
        assert len(members) > 1 and all(n[i] > 0 for i in members)        # whoever is in a component has a link, and the other way round


def test_lists_grow_with_the_vectors():
    v = made(600).tolist()
    lists = {n: len(pq.Quantizers(v, {32: n}).of[32][0]) for n in (50_000, 500_000, 5_000_000)}
    for n, k in lists.items():
        assert n / k <= 2 * pq.LIST_SIZE, lists


def test_lists_of_rows_and_their_probes_agree():
    v = pq.unit(pa.array(made(900).tolist()))
    for lists in (40, 3000):
        q = pq.Quantizer(v, lists)
        at, _, left = q.index(v)
        near = q.probes(v, None)
        assert at.max() < len(q) and (near < len(q)).all() and all(len(set(p)) == len(p) for p in near.tolist())
        assert np.mean([a in p for a, p in zip(at.tolist(), near.tolist())]) > 0.99
        assert np.allclose(left >= 0, True)
