from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.operators import density as dn
from tillroll.operators import evaluate as ev
from tillroll.operators import neighbours as nb


def frame(spark, points, id_name):
    data = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    return spark.createDataFrame(data, f"{id_name} long, vector array<float>")


def brute(q, r, k, metric, skip):
    q, r = q.astype("float32").astype(float), r.astype("float32").astype(float)
    out = {}
    for i, a in enumerate(q):
        if metric == "l2":
            cost = ((r - a) ** 2).sum(1)
        else:
            cost = -(r @ a) / (np.linalg.norm(r, axis=1) * np.linalg.norm(a))
        cost = np.round(cost, 4)
        order = [j for j in np.lexsort((np.arange(len(r)), cost)) if not (skip and j == i)][:k]
        out[i] = [(j, cost[j]) for j in order]
    return out


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("skip", [False, True])
def test_searches_in_blocks_equal_brute_force(spark, metric, skip):
    rng = np.random.default_rng(1)
    # A third of all points sits in one tight blob.
    points = np.concatenate([rng.normal(0, 1, (80, 5)), rng.normal(3, 1e-3, (40, 5))])
    q, r = frame(spark, points, "query_id"), frame(spark, points, "ref_id")
    want = brute(points, points, 4, metric, skip)
    found = []
    for size in (nb.MAX_BROADCAST_VALUES, 100):
        near = nb.nearest(q, r, 4, metric, skip, max_broadcast_values=size, blocks_at_once=4)
        found.append(sorted(map(tuple, near.collect())))
        got = {}
        for x in near.orderBy("query_id", "rank").collect():
            got.setdefault(x["query_id"], []).append((x["ref_id"], x["score"]))
        for i, hits in want.items():
            scores = [abs(s) for _, s in got[i]]
            # Costs within the rounding noise of each other may swap ids, never scores.
            assert scores == pytest.approx([abs(c) for _, c in hits], abs=2e-4)
            assert len(got[i]) == 4 and (not skip or i not in [j for j, _ in got[i]])
    assert found[0] == found[1]


def test_fewer_references_than_k(spark):
    q = frame(spark, np.eye(3), "query_id")
    r = frame(spark, np.eye(3)[:2], "ref_id")
    assert nb.nearest(q, r, 5).count() == 6
    assert nb.nearest(q, r, 5, max_broadcast_values=1).count() == 6


def test_vote_ties_threshold_and_nulls(spark):
    near = spark.createDataFrame(
        [(1, 10, 0.1, 1), (1, 11, 0.2, 2), (1, 12, 0.3, 3), (2, 10, 9.0, 1)],
        "query_id long, ref_id long, score double, rank int",
    )
    cats = spark.createDataFrame([(10, "a"), (11, "b"), (12, "b")], "ref_id long, category string")
    queries = spark.createDataFrame([(1,), (2,), (3,)], "query_id long")
    got = {r["query_id"]: (r["pred_1"], r["pred_2"], r["pred_3"]) for r in nb.vote(queries, near, cats, (1, 2, 3), 5.0).collect()}
    assert got == {1: ("a", "a", "b"), 2: (None, None, None), 3: (None, None, None)}


def test_two_stage_stays_below_the_chosen_parent(spark):
    q = spark.createDataFrame([(1, [1.0, 0.1, 0.0])], "query_id long, vector array<double>")
    one = spark.createDataFrame([("A", [1.0, 0.0, 0.0]), ("B", [0.0, 1.0, 0.0])], "label string, vector array<double>")
    two = spark.createDataFrame(
        [("A", "a1", [0.0, 0.0, 1.0]), ("A", "a2", [1.0, 1.0, 0.0]), ("B", "b1", [1.0, 0.1, 0.0])],
        "parent string, label string, vector array<double>",
    )
    got = nb.two_stage_label(q, one, two).first()
    assert (got["label_1"], got["label_2"]) == ("A", "a2")


def test_two_stage_tie_goes_to_the_smaller_label(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, vector array<double>")
    names = [f"L{i}" for i in range(9, 0, -1)]
    one = spark.createDataFrame([(n, [1.0, 0.0]) for n in names], "label string, vector array<double>")
    two = spark.createDataFrame([(n, n + x, [1.0, 0.0]) for n in names for x in "ba"], "parent string, label string, vector array<double>")
    got = nb.two_stage_label(q, one, two).first()
    assert (got["label_1"], got["label_2"]) == ("L1", "L1a")


def brute_groups(points, eps, min_points):
    p = points.astype("float32").astype(float)
    close = ((p[:, None] - p[None]) ** 2).sum(2) <= eps * eps
    core = close.sum(1) >= min_points
    group = np.full(len(p), -1)
    for i in np.flatnonzero(core):
        if group[i] == -1:
            stack = [i]
            while stack:
                j = stack.pop()
                if group[j] == -1:
                    group[j] = i
                    stack += [x for x in np.flatnonzero(close[j] & core) if group[x] == -1]
    for i in np.flatnonzero(~core):
        near = np.flatnonzero(close[i] & core)
        if len(near):
            group[i] = group[near.min()]
    return group


@pytest.mark.parametrize("tile_rows", [1000, 12])
@pytest.mark.parametrize("min_points", [2, 4])
def test_density_groups_equal_brute_force(spark, tile_rows, min_points):
    rng = np.random.default_rng(5)
    chain = np.stack([np.arange(25) * 0.4, np.zeros(25)], 1) + [10, 10]
    points = np.concatenate([rng.uniform(0, 6, (60, 2)), chain, np.full((30, 2), 3.0)])
    df = frame(spark, points, "id")
    got = {r["id"]: r["group_id"] for r in dn.density_groups(df, 0.5, min_points, tile_rows=tile_rows).collect()}
    want = brute_groups(points, 0.5, min_points)
    assert [got[i] for i in range(len(points))] == list(want)


def exact_groups(points, eps, min_points):
    """Like ``brute_groups``, by differences and for the numbers as they are stored."""
    p = points.astype("float32").astype(float)
    close = np.stack([((p - x) ** 2).sum(1) <= eps * eps + 1e-12 for x in p])
    core = close.sum(1) >= min_points
    group = np.arange(len(p))
    while True:
        least = np.array([group[close[i] & core].min() if core[i] else i for i in range(len(p))])
        if (least == group).all():
            break
        group = least
    return [group[i] if core[i] else next((group[j] for j in np.flatnonzero(close[i] & core)), -1) for i in range(len(p))]


@pytest.mark.parametrize(
    "tile_rows, block_values, min_points",
    [(5000, 4_000_000, 3), (40, 4_000_000, 40), (30, 100, 1), (30, 20, 3), (30, 20, 40)],
)
def test_density_groups_over_tiles_and_blocks(spark, tile_rows, block_values, min_points):
    rng = np.random.default_rng(8)
    lumps = [rng.normal(m, 0.4, (70, 2)) for m in ([0, 0], [3, 0], [0, 4], [50, 50])]
    lone = rng.uniform(-20, 20, (40, 2))
    points = rng.permutation(np.concatenate([*lumps, lone, np.full((4, 2), 30.0), np.full((2, 2), -30.0)]))
    got = dn.density_groups(frame(spark, points, "id"), 0.6, min_points, tile_rows=tile_rows, block_values=block_values)
    want = exact_groups(points, 0.6, min_points)
    found = {r["id"]: r["group_id"] for r in got.collect()}
    assert len(found) == len(points) and [found[i] for i in range(len(points))] == want


def test_density_groups_far_from_the_origin(spark):
    rng = np.random.default_rng(9)
    points = rng.uniform(0, 8, (300, 3)) + 1e4
    got = {r["id"]: r["group_id"] for r in dn.density_groups(frame(spark, points, "id"), 0.7, 3, tile_rows=25).collect()}
    assert [got[i] for i in range(len(points))] == exact_groups(points, 0.7, 3)


def test_density_groups_compare_ever_fewer_of_all_pairs(spark):
    rng = np.random.default_rng(10)
    seen = []
    for n in (1500, 6000):
        points = rng.normal(size=(n, 24))
        points /= np.linalg.norm(points, axis=1, keepdims=True)
        compared = spark.sparkContext.accumulator(0)
        groups = dn.density_groups(frame(spark, points, "id"), 1.1, 3, tile_rows=100, block_values=4800, compared=compared)
        assert groups.select("group_id").distinct().count() == 1
        seen.append(compared.value / n)
    # No bound rules out a tile here: all pairs would be four times as many for every point.
    assert seen[1] < 1.5 * seen[0] and seen[1] < 1500


def test_density_groups_of_odd_rows(spark):
    near = [[1.0, 1.0], [1.0, 1.1], [1.1, 1.0]]
    rows = [*enumerate(near), (7, [0.0, 9.0]), (8, [-0.0, 9.0]), (8, [-0.0, 9.0]), (None, [1.0, 0.9]), (None, [0.1, 9.0])]
    df = spark.createDataFrame([*rows, (9, [float("nan"), 1.0])], "id long, vector array<float>")
    for tile_rows in (100, 1):
        got = dn.density_groups(df, 0.15, 3, tile_rows=tile_rows).collect()
        found = sorted((-1 if r["id"] is None else r["id"], r["group_id"]) for r in got)
        assert found == [(-1, -1), (-1, -1), (0, 0), (1, 0), (2, 0), (7, 7), (8, 7), (8, 7), (9, -1)]
    for bad in ([1.0], None):
        with pytest.raises(ValueError, match="same length"):
            dn.density_groups(spark.createDataFrame([*rows, (9, bad)], "id long, vector array<float>"), 0.15)
    assert dn.density_groups(df.filter("id > 100"), 0.15).count() == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(40)]
    hub = [(100, i) for i in range(101, 200)]
    nodes = spark.createDataFrame([(i,) for i in [*range(41), *range(100, 200), 500]], "id long")
    edges = spark.createDataFrame(chain + hub, "a long, b long")
    got = {r["id"]: r["component"] for r in dn.connected_components(nodes, edges).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 200)} == {100} and got[500] == 500


def test_report_and_accuracy(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", None)], "y string, p string")
    got = {r["class"]: (r["precision"], r["recall"], r["support"]) for r in ev.class_report(df, "y", "p").collect()}
    assert got["a"] == (1.0, 0.5, 2) and got["b"] == (0.5, 1.0, 1)
    acc = ev.accuracy(df, "y", ["p"]).first()
    assert (acc["accuracy"], acc["n"], acc["missing"]) == (pytest.approx(2 / 3), 4, 1)
    assert ev.disagreement(df.withColumn("q", F.lit(None).cast("string")), "p", "q").first()["differ"] == 3
