from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from brute import frame  # noqa: F401

from tillroll.llm import centroids, registry

SCHEMA = "vec_id long, embedding array<double>, label int, v string, cluster double"


def plain(rows, k=16, rounds=3, dims=64, scale=64, seed="1"):
    """``(vec_id, cluster, distance, inertias, sha of the centroid)`` per kept vector."""
    kept = [(i, x) for i, x, *_ in rows if x is not None and len(x) == dims]
    kept = [(i, x) for i, x in kept if all(c is not None and math.isfinite(c) for c in x)]
    kept = [(i, [math.floor(scale * c) for c in x]) for i, x in kept]
    name = lambda i: (i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())
    means = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def place(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(means))

    for _ in range(rounds):
        own = [place(v)[1] for _, v in kept]
        for c in range(len(means)):
            mine = [v for (_, v), x in zip(kept, own) if x == c]
            if mine:
                means[c] = [sum(column) // len(mine) for column in zip(*mine)]
    found = [(i, *place(v)) for i, v in kept]
    shas = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in means]
    per = {c: sum(d for _, d, x in found if x == c) for c in range(len(means))}
    return sorted(((i, c, d, per[c], sum(per.values()), shas[c]) for i, d, c in found), key=repr)


def run(df, **more):
    found, means = centroids.clusters(df, **more)
    return sorted(map(tuple, centroids.summary(found, means).select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


def vectors(n, dims, seed=4, spread=0.4):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(9, dims))
    x = middle[draw.integers(9, size=n)] + spread * draw.normal(size=(n, dims)) * np.linspace(2, 0.1, dims)
    return [(int(i), row.tolist(), 1, "clash", 0.5) for i, row in enumerate(x)]


@pytest.mark.parametrize(("lead", "k", "dims"), [(12, 16, 64), (3, 5, 8), (8, 5, 8), (0, 3, 4)])
def test_same_as_brute_force(frame, lead, k, dims):
    rows = vectors(120, dims)
    rows += [rows[3], rows[3], (None, rows[5][1], 1, "c", 0.1), (None, rows[6][1], 1, "c", 0.1), (3, rows[7][1], 1, "c", 0.1)]
    rows += [(500, None, 1, "c", 0.1), (501, [], 1, "c", 0.1), (502, [1.0] * (dims + 1), 1, "c", 0.1)]
    rows += [(503 + i, [0.5] * (dims - 1) + [bad], 1, "c", 0.1) for i, bad in enumerate([None, math.nan, math.inf, -math.inf])]
    assert run(frame(rows, SCHEMA), lead=lead, k=k, dims=dims) == plain(rows, k=k, dims=dims)


def test_ties_and_repeated_vectors(frame):
    rows = [(i, [float(i % 4), 0.0, -1e-9], 1, "c", 0.1) for i in range(40)]
    assert run(frame(rows, SCHEMA), dims=3, k=6, lead=1) == plain(rows, dims=3, k=6)


def test_few_rows_and_none(frame):
    for rows in ([], vectors(3, 64), [(1, None, 1, "c", 0.1)]):
        assert run(frame(rows, SCHEMA)) == plain(rows)


def test_large_components(frame):
    rows = [(i, [(-1) ** i * 2.0**21, float(i), 2.0**21], 1, "c", 0.1) for i in range(12)]
    assert run(frame(rows, SCHEMA), dims=3, k=3, lead=1) == plain(rows, dims=3, k=3)
    with pytest.raises(Exception, match="too large"):
        run(frame([(1, [0.0, 2.0**22], 1, "c", 0.1)], SCHEMA), dims=2)


def test_bounds_leave_out_most_centroids():
    rows = np.array([r[1] for r in vectors(2000, 64, spread=0.1)])
    v = np.floor(64 * rows).astype(np.int64)
    mean, axes = v.mean(0), np.linalg.eigh(np.cov(v.T))[1][:, ::-1]
    means = v[np.random.default_rng(1).choice(len(v), 16, replace=False)]
    z, turned = (centroids.rotated(x.astype(float), mean, axes, 12) for x in (v, means))
    cluster, distance, verified = centroids.nearest(v, z, means, turned)
    every = ((v[:, None] - means[None]) ** 2).sum(2)
    assert (distance == every.min(1)).all() and (cluster == every.argmin(1)).all()
    low = ((z[:, None] - turned[None]) ** 2).sum(2)
    assert (low <= every * (1 + 1e-9) + 1e-6).all()
    assert verified < 0.5 * every.size


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, registry.QUERIES["op11_rotated_centroids"](spark, folder).collect()), key=repr) == plain(rows)
