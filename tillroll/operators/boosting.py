"""Boosted trees by second-order gradients on binned columns.

Every feature is cut into bins of equal width.  A round grows one tree per class on the gradients of the
softmax loss; a level of all its trees is one pass over the rows, which adds up gradients per
(class, node, feature, bin) in each task, and one small aggregate.  The driver holds the splits only,
whose number depends on rounds, classes and depth.  Gradients are whole units, so sums are the same in
any order of addition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import materialize

#: Units of a gradient.
SCALE = 1 << 20
#: A split must gain more than this.
LEAST_GAIN = 1e-9


@dataclass
class Tree:
    """Splits ``node -> (feature, bin)`` and leaf values; the children of node n are 2n and 2n + 1."""

    splits: dict[int, tuple[int, int]] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)


@dataclass
class Boosted:
    """A fitted model: bounds of the features, and per round one tree per class."""

    low: list[float]
    high: list[float]
    bins: int
    classes: int
    rounds: list[list[Tree]]
    gains: dict[int, float]

    def predict(self, df: DataFrame, vector: str, out: str = "predicted") -> DataFrame:
        """Add the class of the greatest margin; ties go to the smaller class."""
        if not self.rounds:
            return df.withColumn(out, F.lit(0))
        binned = df.withColumn("__bins", _bin(F.col(vector), self.low, self.high, self.bins))
        margins = [F.lit(0.0)] * self.classes
        for trees in self.rounds:
            margins = [m + _worth(t, F.col("__bins")) for m, t in zip(margins, trees, strict=True)]
        at = binned.withColumn("__margins", F.array(*margins))
        return at.withColumn(out, (F.array_position("__margins", F.array_max("__margins")) - 1).cast("int")).drop(
            "__bins", "__margins"
        )

    def importance(self, spark) -> DataFrame:
        """``(feature, gain)`` of every feature that splits a node."""
        rows = [(f, float(g)) for f, g in sorted(self.gains.items())]
        return spark.createDataFrame(rows, "feature int, gain double")


def _bin(vector: Column, low: list[float], high: list[float], bins: int) -> Column:
    """Bin numbers; values outside the bounds go to the outer bins, null and NaN to the first."""
    width = [h - l if h > l else 0.0 for l, h in zip(low, high, strict=True)]
    both = F.arrays_zip(F.lit(low).alias("low"), F.lit(width).alias("width"))

    def place(x: Column, b: Column) -> Column:
        at = F.floor((x.cast("double") - b["low"]) / b["width"] * bins)
        inside = x.isNotNull() & ~F.isnan(x.cast("double")) & (b["width"] > 0)
        return F.when(inside, F.greatest(F.lit(0), F.least(F.lit(bins - 1), at))).otherwise(0).cast("int")

    return F.zip_with(vector, both, place)


def _node(tree: Tree, bins: Column) -> Column:
    """The node that a row reaches."""
    if not tree.splits:
        return F.lit(1)
    features = F.create_map(*[F.lit(x) for n, (f, _) in tree.splits.items() for x in (n, f)])
    cuts = F.create_map(*[F.lit(x) for n, (_, c) in tree.splits.items() for x in (n, c)])
    levels = max(n.bit_length() for n in tree.splits)

    def step(node: Column, _: Column) -> Column:
        feature = F.element_at(features, node)
        right = (F.get(bins, feature) > F.element_at(cuts, node)).cast("int")
        return F.when(feature.isNotNull(), 2 * node + F.coalesce(right, F.lit(0))).otherwise(node)

    return F.aggregate(F.array_repeat(F.lit(0), levels), F.lit(1), step)


def _worth(tree: Tree, bins: Column) -> Column:
    """The value of the leaf that a row reaches."""
    if not tree.values:
        return F.lit(0.0)
    values = F.create_map(*[F.lit(x) for n, v in sorted(tree.values.items()) for x in (n, v)])
    return F.element_at(values, _node(tree, bins))


def _gradients(rows: DataFrame, classes: int) -> DataFrame:
    """First and second derivatives of the softmax loss, in whole units, per class."""
    shifted = F.transform("__margins", lambda m: F.exp(m - F.array_max("__margins")))
    whole = lambda x: F.floor(x * SCALE + 0.5)
    total = F.aggregate("__exp", F.lit(0.0), lambda a, x: a + x)
    share = rows.withColumn("__exp", shifted).withColumn("__p", F.transform("__exp", lambda x: x / total))
    first = F.transform("__p", lambda p, i: whole(p - F.when(i == F.col("label"), 1.0).otherwise(0.0)))
    second = F.transform("__p", lambda p: whole(p * (1 - p)))
    return share.select("__bins", first.alias("g"), second.alias("h"), "__margins", "label")


def _histogram(rows: DataFrame, trees: list[Tree], level: int, features: int, bins: int) -> DataFrame:
    """``(class, node, feature, bin, g, h)``: sums of gradients over the nodes of a level."""
    nodes = F.array(*[_node(t, F.col("__bins")) for t in trees])
    first, classes = 1 << level, len(trees)

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = first * features * bins
        sums = np.zeros((2, classes, size), np.int64)
        for b in batches:
            if not len(b):
                continue
            place = np.stack(b["__bins"].to_numpy()) + np.arange(features) * bins
            node, g, h = (np.stack(b[c].to_numpy()) for c in ("node", "g", "h"))
            for c in range(classes):
                # Rows in a leaf of an earlier level have no share.
                live = node[:, c] >= first
                at = (place[live] + (node[live, c] - first)[:, None] * features * bins).ravel()
                for i, x in enumerate((g, h)):
                    # Sums of a batch stay below 2 to the power 53, where doubles are exact.
                    weights = np.repeat(x[live, c].astype(float), features)
                    sums[i, c] += np.bincount(at, weights, size).astype(np.int64)
        c, at = np.nonzero(sums.any(0))
        yield pd.DataFrame(
            {
                "class": c.astype("int32"),
                "node": (first + at // (features * bins)).astype("int32"),
                "feature": (at // bins % features).astype("int32"),
                "bin": (at % bins).astype("int32"),
                "g": sums[0, c, at],
                "h": sums[1, c, at],
            }
        )

    parts = rows.select("__bins", "g", "h", nodes.alias("node")).mapInPandas(
        add_up, "class int, node int, feature int, bin int, g long, h long"
    )
    return parts.groupBy("class", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def _best_splits(histogram: DataFrame, ridge: float) -> list:
    """One row per class and node: the split of greatest gain, and the sums on its left and in all.

    Ties go to the smaller feature and bin.  The rows are as many as nodes of the level.
    """
    of = Window.partitionBy("class", "node", "feature")
    upto = of.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = histogram.select(
        "class",
        "node",
        "feature",
        "bin",
        F.sum("g").over(upto).alias("gl"),
        F.sum("h").over(upto).alias("hl"),
        F.sum("g").over(of).alias("ga"),
        F.sum("h").over(of).alias("ha"),
    )
    unit = lambda c: F.col(c) / F.lit(float(SCALE))
    score = lambda g, h: g * g / (h + ridge)
    gl, hl, ga, ha = map(unit, ("gl", "hl", "ga", "ha"))
    gain = score(gl, hl) + score(ga - gl, ha - hl) - score(ga, ha)
    allowed = (F.col("hl") > 0) & (F.col("hl") < F.col("ha"))
    best = F.struct("gain", -F.col("feature"), -F.col("bin"))
    return (
        summed.withColumn("gain", F.when(allowed, gain).otherwise(0.0))
        .groupBy("class", "node")
        .agg(F.max_by(F.struct("gain", "feature", "bin", "gl", "hl", "ga", "ha"), best).alias("s"))
        .select("class", "node", "s.*")
        .collect()
    )


def fit(
    train: DataFrame,
    vector: str,
    label: str = "label",
    rounds: int = 10,
    depth: int = 3,
    bins: int = 16,
    rate: float = 0.3,
    ridge: float = 1.0,
) -> Boosted:
    """Fit on arrays of equal length; labels are 0, 1, ...

    Rows without a label or a vector teach nothing.  Bounds of the bins are those of the finite values; null
    and NaN go to the first bin.  Without any row the model predicts 0.
    """
    known = train.select(F.col(vector).cast("array<double>").alias("x"), F.col(label).cast("int").alias("label"))
    known = materialize(known.filter("label is not null and x is not null"))
    classes = (known.agg(F.max("label")).first()[0] or 0) + 1
    value = F.col("col")
    finite = ~F.isnan(value) & (F.abs(value) < float("inf"))
    limits = (
        known.select(F.posexplode("x"))
        .groupBy("pos")
        .agg(F.min(F.when(finite, value)).alias("low"), F.max(F.when(finite, value)).alias("high"))
        .orderBy("pos")
        .collect()
    )
    low, high = [r.low or 0.0 for r in limits], [r.high or 0.0 for r in limits]
    model = Boosted(low, high, bins, classes, [], {})
    if not limits:
        return model
    zero = F.array(*[F.lit(0.0)] * classes)
    rows = known.select(_bin(F.col("x"), low, high, bins).alias("__bins"), zero.alias("__margins"), "label")
    for _ in range(rounds):
        rows = materialize(_gradients(rows, classes))
        trees = [Tree() for _ in range(classes)]
        for level in range(depth):
            found = _best_splits(_histogram(rows, trees, level, len(low), bins), ridge)
            grown = False
            for r in found:
                tree, worth = trees[r["class"]], lambda g, h: -rate * (g / SCALE) / (h / SCALE + ridge)
                tree.values.setdefault(r.node, worth(r.ga, r.ha))
                if r.gain > LEAST_GAIN:
                    grown = True
                    tree.splits[r.node] = (r.feature, r.bin)
                    tree.values[2 * r.node] = worth(r.gl, r.hl)
                    tree.values[2 * r.node + 1] = worth(r.ga - r.gl, r.ha - r.hl)
                    model.gains[r.feature] = model.gains.get(r.feature, 0.0) + r.gain
            if not grown:
                break
        model.rounds.append(trees)
        margins = [F.get("__margins", F.lit(c)) + _worth(t, F.col("__bins")) for c, t in enumerate(trees)]
        rows = rows.select("__bins", F.array(*margins).alias("__margins"), "label")
    return model
