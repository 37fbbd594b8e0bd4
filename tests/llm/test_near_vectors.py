"""Links between vectors against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgewise.llm import near_vectors


def cosine(x, y):
    x, y = (np.array(v) / max(map(abs, v)) for v in (x, y))
    return np.dot(x, y) / (np.sqrt(np.dot(x, x)) * np.sqrt(np.dot(y, y)))


def brute(rows, least=0.9):
    fit = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    units = sorted({(i, tuple(v)) for i, v in rows if i is not None and fit(v)})
    links, reach = {u: 0 for u in units}, {i: i for i, _ in units}

    def root(i):
        while reach[i] != i:
            i = reach[i]
        return i

    for n, (i, x) in enumerate(units):
        for j, y in units[:n]:
            if len(x) == len(y) and (x == y or cosine(x, y) >= least):
                links[i, x] += 1
                links[j, y] += 1
                a, b = sorted((root(i), root(j)))
                reach[b] = a
    out = []
    for i, v in rows:
        if i is not None and fit(v):
            out.append((i, links[i, tuple(v)], root(i), root(i) == i))
        else:
            out.append((i, 0, i, True))
    return sorted(out, key=str)


def clusters(n, dim, seed, copies=12, noise=0.35):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for i in range(0, n, copies):
        x[i : i + copies // 2] = x[i] + noise * rng.normal(size=(min(copies // 2, n - i), dim))
    return x


def frame(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumns({c: F.lit("x") for c in ("m", "cid", "vector", "cell", "block", "n", "component", "node", "label")})


@pytest.mark.parametrize("dim, noise", [(2, 0.2), (64, 0.4)])
def test_equals_all_pairs_in_one_cell(spark, dim, noise):
    rows = [(i, v.tolist()) for i, v in enumerate(clusters(240, dim, dim, noise=noise))]
    got = sorted(map(tuple, near_vectors.link(frame(spark, rows), cell=10**6).collect()), key=str)
    assert got == brute(rows) and any(r[1] for r in got)


def test_equals_all_pairs_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "_BLOCK", 40)
    rows = [(i, v.tolist()) for i, v in enumerate(clusters(300, 16, 3))]
    assert sorted(map(tuple, near_vectors.link(frame(spark, rows), cell=10**6).collect()), key=str) == brute(rows)


def test_recall_with_many_cells(spark):
    x = np.float32(clusters(2000, 32, 5, noise=0.3))
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    want = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in near_vectors.link(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)], "float"), cell=40).collect()}
    assert all(got[i] <= n for i, n in enumerate(want.tolist()))
    assert sum(got.values()) >= 0.97 * want.sum() > 0


def test_odd_rows(spark):
    rows = [
        (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [-1.0, 0.0]), (None, [1.0, 0.0]), (None, None), (4, None), (5, []), (6, [0.0, 0.0]),
        (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [None, 1.0]), (10, [1.0, 0.0, 0.0]), (11, [1e300, 1e290]), (12, [1e-300, 0.0]),
        (13, [-0.0, 1.0]), (14, [0.0, 1.0]), (15, [5.0]), (16, [7.0]), (17, [-1.0]), (13, [0.0, -1.0]),
    ]
    got = sorted(map(tuple, near_vectors.link(frame(spark, rows)).collect()), key=str)
    assert got == brute([(i, v and [x if x is None else x + 0.0 for x in v]) for i, v in rows])


def test_copies_without_pairs(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(5000)] + [(i, [float(i), 1.0, -5.0]) for i in range(5000, 5003)]
    got = {r.vec_id: r for r in near_vectors.link(frame(spark, rows)).collect()}
    assert len(got) == 5003 and all(got[i].n_links == 4999 and got[i].component_id == 0 for i in range(5000)) and got[5000].n_links == 2


def test_codes_estimate_without_bias():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = 0.9 * x + math.sqrt(1 - 0.81) * (z := rng.normal(size=x.shape) / 8)
    y /= np.linalg.norm(y, axis=1)[:, None]
    packed, factor = near_vectors.codes(x)
    signs = (np.unpackbits(packed, axis=1) * 2.0 - 1) / math.sqrt(64)
    miss = (signs * (y @ near_vectors.rotation(64).T)).sum(axis=1) / factor - (x * y).sum(axis=1)
    assert len(z) and abs(miss.mean()) < 0.003
    near = (x * y).sum(axis=1) >= 0.9
    assert (miss[near] >= -near_vectors.slack(factor, 0.9, 64, 6.0)[near]).all()
    assert np.allclose(near_vectors.rotation(64) @ near_vectors.rotation(64).T, np.eye(64))


def test_empty_table(spark):
    out = near_vectors.link(frame(spark, []))
    assert out.count() == 0 and out.columns == ["vec_id", "n_links", "component_id", "kept"]
