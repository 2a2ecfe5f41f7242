"""The inverted file gives what a search of everything gives, and looks at less where bounds allow."""

from __future__ import annotations

import numpy as np
import pytest

from tillroll.operators import neighbours as nb
from tillroll.operators import vector_index as vi


def frames(spark, queries, refs):
    q = [(int(i), x.tolist()) for i, x in queries]
    r = [(int(i), x.tolist()) for i, x in refs]
    return spark.createDataFrame(q, "query_id long, vector array<float>"), spark.createDataFrame(r, "ref_id long, vector array<float>")


def groups(n, dims, seed=3, middles=8, spread=0.05):
    draw = np.random.default_rng(seed)
    centre = 3 * draw.normal(size=(middles, dims))
    return centre[draw.integers(middles, size=n)] + spread * draw.normal(size=(n, dims))


def found(df):
    return sorted((r.query_id, r["rank"], r.ref_id, round(r.score, 4)) for r in df.collect())


@pytest.mark.parametrize(("metric", "cells", "max_values"), [("l2", None, 4_000_000), ("cosine", None, 4_000_000), ("l2", 5, 300), ("cosine", 7, 40)])
def test_exact_search_equals_a_search_of_everything(spark, metric, cells, max_values):
    x = groups(260, 4)
    x[3], x[9], x[10] = 0, x[8], x[8]  # a vector without direction, and equal ones
    queries, refs = frames(spark, enumerate(x[:120]), enumerate(x))
    index = vi.build_index(refs, metric, cells, max_values=max_values)
    assert index.count.sum() == 260 and (index.n_blocks > 1) == (max_values < 1000)
    got, looked = vi.search_index(index, queries, 5, skip_same_id=True)
    assert found(got) == found(nb.nearest(queries, refs, 5, metric, skip_same_id=True))
    assert looked.count() == 120


def test_fewer_references_than_asked_for(spark):
    x = groups(6, 3)
    queries, refs = frames(spark, enumerate(x), enumerate(x[:4]))
    for k in (3, 4, 9):
        got, looked = vi.search_index(vi.build_index(refs), queries, k, skip_same_id=True)
        assert found(got) == found(nb.nearest(queries, refs, k, skip_same_id=True))
        assert {r.candidates for r in looked.collect()} <= {4, 3, 2} or k < 9


def test_empty_sides(spark):
    queries, refs = frames(spark, enumerate(groups(3, 2)), enumerate(groups(9, 2)))
    none, looked = vi.search_index(vi.build_index(refs.limit(0)), queries, 2)
    assert none.count() == 0 and [r.candidates for r in looked.collect()] == [0, 0, 0]
    assert vi.search_index(vi.build_index(refs), queries.limit(0), 2)[0].count() == 0


def test_hot_cells_are_dealt_over_blocks():
    first, shares = vi._packed(np.array([3, 25, 4, 5, 0, 1]), 10)
    assert first.tolist() == [0, 1, 4, 4, 4, 4] and shares.tolist() == [1, 3, 1, 1, 1, 1]


def test_candidates_grow_slower_than_the_references(spark):
    """Separated data of few dimensions: ten times the references, far less than ten times the work."""
    seen = []
    for n in (400, 4000):
        x = groups(n, 3, middles=40, spread=0.1)
        queries, refs = frames(spark, enumerate(x[:100]), enumerate(x))
        got, looked = vi.search_index(vi.build_index(refs), queries, 5)
        assert found(got) == found(nb.nearest(queries, refs, 5))
        seen.append(np.mean([r.candidates for r in looked.collect()]))
    assert seen[1] < 5 * seen[0] and seen[1] < 0.1 * 4000


def test_a_narrow_spread_finds_most_and_looks_at_less(spark):
    draw = np.random.default_rng(2)
    x = draw.normal(size=(3000, 24)) + 1.5 * draw.normal(size=(12, 24))[draw.integers(12, size=3000)]
    queries, refs = frames(spark, enumerate(x[:150]), enumerate(x))
    index = vi.build_index(refs)
    exact, every = vi.search_index(index, queries, 10, skip_same_id=True)
    near, some = vi.search_index(index, queries, 10, skip_same_id=True, spread=0.3)
    pairs = lambda df: {(r.query_id, r.ref_id) for r in df.collect()}
    truth = pairs(exact)
    assert len(pairs(near) & truth) >= 0.9 * len(truth)
    total = lambda df: sum(r.candidates for r in df.collect())
    assert total(some) < 0.8 * total(every)


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_pairs_beyond_the_limit_get_no_exact_cost(monkeypatch, metric):
    """Noise that no bound separates: few pairs are ranked, and the neighbours are those of all pairs."""
    draw = np.random.default_rng(5)
    x = draw.normal(size=(3000, 16)).astype("float32").astype("float64")
    x[7], x[8], x[9] = 0, np.nan, x[10]
    q, ids, starts = x[:200], np.arange(3000), np.arange(0, 3001, 300)
    every = np.ones((200, 10), bool)
    block = vi._Block(starts, ids, x, metric)
    plain = block.search(ids[:200], q, every, 10, True)
    cost = plain[2].reshape(-1, 10) if len(plain[2]) == 2000 else None
    limit = np.full(200, np.inf)
    rows, last = np.unique(plain[0], return_index=True)
    limit[rows] = (np.maximum.reduceat(plain[2], last) * (2 if metric == "cosine" else 1)) + (2 if metric == "cosine" else 0) + 4e-4
    limit[3] *= 1.5
    assert cost is None  # the query that is no number has no neighbours
    ranked = []
    exact = vi._pair_cost
    monkeypatch.setattr(vi, "_pair_cost", lambda a, b, m: ranked.append(len(a)) or exact(a, b, m))
    got = block.search(ids[:200], q, every, 10, True, limit)
    assert all((a == b).all() for a, b in zip(got[:2], plain[:2])) and np.abs(got[2] - plain[2]).max() <= 1e-4
    assert 0 < sum(ranked) < 0.05 * 200 * 3000
