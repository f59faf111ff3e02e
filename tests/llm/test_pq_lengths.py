"""Vectors of several lengths in one table."""

import numpy as np
import pytest

from riskframe.llm import pq


@pytest.mark.parametrize("max_sample", [pq.MAX_SAMPLE, 50])
def test_every_length_links(spark, monkeypatch, max_sample):
    monkeypatch.setattr(pq, "MAX_SAMPLE", max_sample)
    rng = np.random.default_rng(3)
    data = []
    for d, n in ((32, 500), (24, 250), (5, 1)):
        x = rng.normal(size=(n, d))
        data += [v.tolist() for v in x] + [v.tolist() for v in x + rng.normal(size=x.shape) * 0.02] + [x[0].tolist()]
    data += [[1.0, 0.0], [2.0, 0.0, 0.0], None, [0.0] * 24]
    df = spark.createDataFrame(list(enumerate(data)), "vec_id long, embedding array<double>").repartition(3)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in pq.near_duplicates(df).collect()}
    unit = [None if v is None or not any(v) else np.array(v) / np.linalg.norm(v) for v in data]
    near = {i: [j for j, y in enumerate(unit) if j != i and x is not None and y is not None and len(x) == len(y) and x @ y >= pq.COSINE]
            for i, x in enumerate(unit)}
    part = {i: i for i in near}
    for _ in range(5):
        part = {i: min([part[i], *(part[j] for j in near[i])]) for i in near}
    assert got == {i: (len(near[i]), part[i]) for i in near}
