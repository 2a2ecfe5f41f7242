"""Boosted trees against a plain version, and odd rows."""

from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from tillroll.operators import boosting as bt

SCHEMA = "id long, label int, x array<double>"


def plain(train, test, classes, rounds, depth, bins, rate=0.3, ridge=1.0):
    """Predictions of the same trees, one row and one split at a time."""
    unit = bt.SCALE
    low, high = ([f(r[2][j] for r in train) for j in range(len(train[0][2]))] for f in (min, max))

    def cut(x):
        return [
            max(0, min(bins - 1, math.floor((v - a) / (b - a) * bins))) if b > a else 0
            for v, a, b in zip(x, low, high, strict=True)
        ]

    rows = [(r[1], cut(r[2]), [0.0] * classes) for r in train]
    asked = [(cut(r[2]), [0.0] * classes) for r in test]
    gains = {}

    def grow(members, level):
        g, h = (sum(m[i] for m in members) / unit for i in (1, 2))
        best = (bt.LEAST_GAIN, 0, 0)
        for f in range(len(low)) if level < depth else ():
            for b in sorted({m[0][f] for m in members})[:-1]:
                gl, hl = (sum(m[i] for m in members if m[0][f] <= b) / unit for i in (1, 2))
                if 0 < hl < h:
                    gain = gl * gl / (hl + ridge) + (g - gl) * (g - gl) / (h - hl + ridge) - g * g / (h + ridge)
                    best = max(best, (gain, -f, -b))
        if best[0] <= bt.LEAST_GAIN:
            return lambda x: -rate * g / (h + ridge)
        f, b = -best[1], -best[2]
        gains[f] = gains.get(f, 0.0) + best[0]
        left, right = (grow([m for m in members if (m[0][f] <= b) == side], level + 1) for side in (True, False))
        return lambda x: left(x) if x[f] <= b else right(x)

    for _ in range(rounds):
        trees = []
        for c in range(classes):
            members = []
            for label, x, m in rows:
                total = [math.exp(v - max(m)) for v in m]
                p = total[c] / sum(total)
                members.append((x, math.floor((p - (label == c)) * unit + 0.5), math.floor(p * (1 - p) * unit + 0.5)))
            trees.append(grow(members, 0))
        for c, tree in enumerate(trees):
            for x, m in [(r[1], r[2]) for r in rows] + asked:
                m[c] += tree(x)
    return [m.index(max(m)) for _, m in asked], gains


def some_rows(n, seed):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        label = draw.randrange(3)
        out.append((i, label, [label + draw.gauss(0, 0.7), draw.gauss(0, 1) * label, 5.0, draw.random()]))
    return out


def test_same_as_plain(spark):
    train, test = some_rows(150, 1), some_rows(80, 2)
    model = bt.fit(spark.createDataFrame(train, SCHEMA).repartition(5), "x", rounds=3, depth=3, bins=8)
    got = model.predict(spark.createDataFrame(test, SCHEMA), "x").orderBy("id").collect()
    want, gains = plain(train, test, 3, 3, 3, 8)
    assert [r.predicted for r in got] == want
    assert {f: round(g, 6) for f, g in model.gains.items()} == {f: round(g, 6) for f, g in gains.items()}
    assert 2 not in model.gains  # a constant never splits
    assert model.importance(spark).count() == len(gains)


def test_it_learns(spark):
    train, test = some_rows(400, 3), some_rows(200, 4)
    model = bt.fit(spark.createDataFrame(train, SCHEMA), "x", rounds=4, depth=3)
    right = model.predict(spark.createDataFrame(test, SCHEMA), "x").filter(F.col("predicted") == F.col("label")).count()
    assert right >= 0.7 * len(test)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    train = [(0, None, [1.0, 2.0]), (1, 0, None), (2, 0, [nan, 1.0]), (3, 1, [inf, None]), (4, 1, [3.0, -inf])]
    train += [(5, 0, [1.0, 1.0])] * 3
    table = spark.createDataFrame(train, SCHEMA).withColumn("predicted", F.lit("clash"))
    model = bt.fit(table, "x", rounds=2, depth=2)
    got = model.predict(table, "x")
    assert got.columns == ["id", "label", "x", "predicted"] and got.count() == len(train)
    empty = spark.createDataFrame([], SCHEMA)
    assert {r.predicted for r in bt.fit(empty, "x").predict(table, "x").collect()} == {0}
    assert model.predict(empty, "x").count() == 0 and bt.fit(empty, "x").importance(spark).count() == 0
