"""The K-means family over named numeric and categorical columns.

A fitted model is a small list of centres.  Labelling is a plain column expression, so the rows are
never moved for it, and one round of a fit is one two-phase aggregate per label.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.session import materialize

MAX_CLUSTERS = 10_000
#: Rows whose sums are taken in one job, bins of a column for their lower bounds, distances held at once.
MEDOID_BLOCK = 4096
MEDOID_BINS = 256
MEDOID_PAIRS = 1 << 18
#: Rows of the first such job, steps towards a cluster's middle, and radii of its curvature.
MEDOID_FIRST = 64
MEDOID_STEPS = 6
MEDOID_RADII = 24
#: Sums that differ by less than this share are equal; partial sums are added in any order.
_TIE = 1e-12


def _literal(value) -> str:
    """SQL text of a centre value."""
    if value is None:
        return "NULL"
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return str(value)


def _distance_sql(numeric: list[str], centre: dict) -> str:
    """Squared Euclidean distance of the row to a centre, as SQL text.

    Fits build hundreds of distances per round; one parsed text each is far cheaper than a tree of
    column calls.
    """
    gaps = [f"pow(double(`{c}`) - ({float(centre[c])!r}D), 2)" for c in numeric]
    return " + ".join(gaps) or "0D"


def _mismatch_sql(categorical: list[str], centre: dict) -> str:
    """Number of categorical columns that differ from the centre, as SQL text."""
    return " + ".join(f"if(`{c}` <=> {_literal(centre[c])}, 0D, 1D)" for c in categorical)


@dataclass(frozen=True)
class Centres:
    """Centres with their distance; ``cost`` is the sum of the distances of all rows."""

    centres: list[dict]
    numeric: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    gamma: float = 1.0
    root: bool = False
    cost: float = math.nan

    def distance_sql(self, centre: dict) -> str:
        d = _distance_sql(self.numeric, centre)
        if self.root:
            d = f"sqrt({d})"
        if self.categorical:
            d = f"{d} + {float(self.gamma)!r}D * ({_mismatch_sql(self.categorical, centre)})"
        return d

    def nearest(self) -> Column:
        """Struct of the smallest distance and its label; ties go to the smaller label."""
        options = ", ".join(
            f"named_struct('cost', {self.distance_sql(c)}, 'label', {j})"
            for j, c in enumerate(self.centres)
        )
        return F.expr(f"array_min(array({options}))")

    def label(self, df: DataFrame, name: str = "label") -> DataFrame:
        return df.withColumn("_near", self.nearest()).select(
            *df.columns, F.col("_near.label").alias(name)
        )


STARTS = ("hash", "first")


def _starting_rows(df: DataFrame, columns: list[str], k: int, seed: int, init: str = "hash") -> list[dict]:
    """``k`` different rows: in a fixed pseudo-random order, or the first in the order of the columns."""
    if init not in STARTS:
        raise ValueError(f"init must be one of {STARTS}")
    key = F.md5(F.concat_ws("\u0001", F.lit(seed), *[F.col(c).cast("string") for c in columns]))
    order = [key, *columns] if init == "hash" else columns
    rows = df.select(*columns).distinct().orderBy(*order).limit(k).collect()
    return [r.asDict() for r in rows]


def _joint_rounds(df: DataFrame, starts: dict, update: dict[str, Column], max_iter: int) -> dict:
    """Alternate labelling and centre update of several fits until nothing changes; costs are those of the result.

    A round of all fits that still move is one aggregate by fit and label, however many there are.
    """
    models, moving = dict(starts), list(starts)
    for turn in range(max_iter + 1):
        if not moving:
            break
        near = [F.struct(F.lit(i).alias("fit"), models[key].nearest().alias("at")) for i, key in enumerate(moving)]
        rows = (
            df.withColumn("_near", F.explode(F.array(*near)))
            .groupBy(F.col("_near.fit").alias("_fit"), F.col("_near.at.label").alias("_label"))
            .agg(F.sum("_near.at.cost").alias("_cost"), *[c.alias(n) for n, c in update.items()])
            .collect()
        )  # one row per centre
        still = []
        for i, key in enumerate(moving):
            own = [r for r in rows if r["_fit"] == i]
            model = replace(models[key], cost=float(sum(r["_cost"] for r in own)))
            fresh = {r["_label"]: {n: r[n] for n in update} for r in own}
            centres = [fresh.get(j, old) for j, old in enumerate(model.centres)]
            if centres != model.centres and turn < max_iter:
                model = replace(model, centres=centres)
                still.append(key)
            models[key] = model
        moving = still
    return models


def _grid(df: DataFrame, columns: list[str], ks: Iterable[int], shape: Centres, update, max_iter, seed, restarts, init) -> dict[int, Centres]:
    """The cheapest of the restarts for every ``k``; a start with fewer centres is the beginning of a longer one."""
    ks = list(ks)
    rows = [_starting_rows(df, columns, max(ks), seed + i, init) for i in range(restarts)]
    starts = {(k, i): replace(shape, centres=r[:k]) for k in ks for i, r in enumerate(rows)}
    fits = _joint_rounds(df, starts, update, max_iter)
    return {k: _best([fits[k, i] for i in range(restarts)]) for k in ks}


def _best(fits: list[Centres]) -> Centres:
    return min(fits, key=lambda m: m.cost)


def kmodes(
    df: DataFrame,
    columns: list[str],
    k: int,
    max_iter: int = 100,
    seed: int = 50,
    restarts: int = 1,
    init: str = "hash",
) -> Centres:
    """K-modes: centres are the most frequent values, distance counts differing columns.

    The smallest of several equally frequent values is taken.
    """
    return kmodes_grid(df, columns, [k], max_iter, seed, restarts, init)[k]


def kmodes_grid(
    df: DataFrame, columns: list[str], ks: Iterable[int], max_iter: int = 100, seed: int = 50, restarts: int = 1, init: str = "hash"
) -> dict[int, Centres]:
    """``kmodes`` for several ``k`` at once."""
    update = {c: F.mode(c, True) for c in columns}
    return _grid(df, columns, ks, Centres([], categorical=columns), update, max_iter, seed, restarts, init)


def default_gamma(df: DataFrame, numeric: list[str]) -> float:
    """Half the mean deviation of the numeric columns."""
    row = df.agg(*[F.stddev_pop(F.col(c).cast("double")).alias(c) for c in numeric]).first()
    return 0.5 * float(np.mean([row[c] or 0.0 for c in numeric]))


def kprototypes(
    df: DataFrame,
    numeric: list[str],
    categorical: list[str],
    k: int,
    gamma: float | None = None,
    max_iter: int = 100,
    seed: int = 50,
    restarts: int = 1,
    init: str = "hash",
) -> Centres:
    """K-prototypes: squared distance of the numbers plus ``gamma`` per differing category."""
    return kprototypes_grid(df, numeric, categorical, [k], gamma, max_iter, seed, restarts, init)[k]


def kprototypes_grid(
    df: DataFrame,
    numeric: list[str],
    categorical: list[str],
    ks: Iterable[int],
    gamma: float | None = None,
    max_iter: int = 100,
    seed: int = 50,
    restarts: int = 1,
    init: str = "hash",
) -> dict[int, Centres]:
    """``kprototypes`` for several ``k`` at once."""
    weight = default_gamma(df, numeric) if gamma is None else gamma
    update = {c: F.avg(F.col(c).cast("double")) for c in numeric}
    update.update({c: F.mode(c, True) for c in categorical})
    shape = Centres([], numeric, categorical, weight)
    return _grid(df, numeric + categorical, ks, shape, update, max_iter, seed, restarts, init)


def kmeans_grid(
    df: DataFrame,
    columns: list[str],
    ks: Iterable[int],
    max_iter: int = 100,
    seed: int = 50,
    weight: str | None = None,
    restarts: int = 1,
    init: str = "hash",
) -> dict[int, Centres]:
    """Plain K-means from given starting rows, for several ``k`` at once."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    update = {c: F.sum(F.col(c).cast("double") * w) / F.sum(w) for c in columns}
    return _grid(df, columns, ks, Centres([], columns), update, max_iter, seed, restarts, init)


def kmeans(
    df: DataFrame,
    columns: list[str],
    k: int,
    max_iter: int = 100,
    seed: int = 50,
    weight: str | None = None,
    scale: bool = False,
    restarts: int = 1,
    init: str = "parallel",
) -> tuple[DataFrame, float, list[np.ndarray]]:
    """K-means labels, cost and centres; ``weight`` counts a row by a column.

    Of several restarts the cheapest is kept.  ``init`` is Spark's parallel start, or one of
    ``STARTS``: then the centres of every round are those of plain K-means from these rows.
    """
    if init != "parallel":
        if scale:
            raise ValueError("scale the columns before a given start")
        model = kmeans_grid(df, columns, [k], max_iter, seed, weight, restarts, init)[k]
        centres = [np.array([float(c[x]) for x in columns]) for c in model.centres]
        return model.label(df), model.cost, centres
    rows = assemble(df, columns, scale)
    estimator = KMeans(k=k, maxIter=max_iter, featuresCol="_vector", predictionCol="label")
    if weight:
        rows = rows.withColumn("_weight", F.col(weight).cast("double"))
        estimator = estimator.setWeightCol("_weight")
    rows = rows.persist()
    fits = [estimator.copy({estimator.seed: seed + i}).fit(rows) for i in range(restarts)]
    model = min(fits, key=lambda m: m.summary.trainingCost)
    cost, centres = model.summary.trainingCost, model.clusterCenters()
    rows.unpersist()
    labelled = model.transform(assemble(df, columns, scale)).drop("_vector")
    return labelled, cost, centres


def assemble(df: DataFrame, columns: list[str], scale: bool = False) -> DataFrame:
    """Add ``_vector`` with the columns, as they are or in units of their deviation."""
    cast = df.withColumns({f"_n_{c}": F.col(c).cast("double") for c in columns})
    names = [f"_n_{c}" for c in columns]
    rows = VectorAssembler(inputCols=names, outputCol="_vector").transform(cast).drop(*names)
    if scale:
        scaler = StandardScaler(inputCol="_vector", outputCol="_scaled", withMean=True)
        rows = scaler.fit(rows).transform(rows).drop("_vector").withColumnRenamed("_scaled", "_vector")
    return rows


def kmedoids(
    df: DataFrame,
    columns: list[str],
    k: int,
    max_iter: int = 100,
    seed: int = 50,
    restarts: int = 1,
    init: str = "hash",
    block: int = MEDOID_BLOCK,
) -> Centres:
    """K-medoids with Euclidean distance; centres are rows of the data.

    The same search at every size: rows go to their nearest medoid, and each cluster's medoid becomes
    the row with the smallest summed distance to the whole cluster, in turns until the cost no longer
    falls.  Every row of a cluster stands for medoid: it is left out only if a lower bound of its sum
    is above the sum of another row, else its sum is taken, ``block`` rows a job.  Of several restarts
    the cheapest is kept.  Rows with a missing value have no distance and are left out of the fit.
    """
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    points = materialize(values.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias("_w")))
    found = []
    for i in range(restarts):
        start = Centres(_starting_rows(points, columns, k, seed + i, init), columns, root=True)
        found.append(_move_medoids(points, start, max_iter, block))
    return _best(found)


def _move_medoids(points: DataFrame, model: Centres, max_iter: int, block: int) -> Centres:
    best = None
    for turn in range(max_iter + 1):
        near = points.select("_w", model.nearest().alias("_near"))
        rows = near.groupBy("_near.label").agg(F.sum(F.col("_near.cost") * F.col("_w")).alias("cost")).collect()
        costs = {r["label"]: r["cost"] for r in rows}
        model = replace(model, cost=math.fsum(costs.values()))
        if best is not None and not model.cost < best.cost:
            break
        best = model
        if turn == max_iter:
            break
        centres = _medoids(points, model, costs, block)
        if centres == model.centres:
            break
        model = replace(model, centres=centres)
    return best


def _medoids(points: DataFrame, model: Centres, costs: dict[int, float], block: int) -> list[dict]:
    """The exact medoid of each cluster of ``model``; of equal sums the current one, then the smallest row."""
    columns = model.numeric
    own = points.select(*columns, "_w", model.nearest()["label"].alias("_label"))
    # Bounds only spare sums; where one job takes all of them, they are not needed.
    few = points.limit(block).count() < block
    if few:
        bounded = own.withColumn("_bound", F.lit(0.0))
    else:
        own = materialize(own)
        middles = _middles(own, model)
        bounded = materialize(_curved_bounds(_sum_bounds(own, model, costs), columns, middles, _bends(own, columns, middles)))
    least = {j: (costs[j], None) for j in costs}
    # The order stays the same while the medoids are sought, so that a block begins where the last one ended.
    # Rows come in the order of their bound in units of their cluster's lowest one, so that all clusters begin.
    low = {r["_label"]: r["low"] for r in bounded.groupBy("_label").agg(F.min("_bound").alias("low")).collect()}
    scale = F.array(*[F.lit(max(low.get(j, 0.0), 1e-300)) for j in range(len(model.centres))])
    names = ["_share", "_label", *columns]
    ranked = bounded.withColumn("_share", F.col("_bound") / scale[F.col("_label")])
    last, taken = None, block if few else min(block, MEDOID_FIRST)
    while True:
        limit = F.array(*[F.lit(float(least.get(j, (0.0,))[0])) for j in range(len(model.centres))])
        rest = ranked.filter(F.col("_bound") <= limit[F.col("_label")])
        if last is not None:
            rest = rest.filter(F.struct(*names) > F.struct(*[F.lit(last[c]).alias(c) for c in names]))
        options = rest.orderBy(*names).limit(taken).collect()
        for at, total in _exact_sums(own, options, columns).items():
            j, row = options[at]["_label"], [options[at][c] for c in columns]
            cost, chosen = least[j]
            gap = _TIE * costs[j]
            if total < cost - gap or (chosen is not None and abs(total - cost) <= gap and row < chosen):
                least[j] = (min(total, cost), row)
        if len(options) < taken:
            break
        last, taken = options[-1], block
    return [
        dict(zip(columns, least[j][1])) if j in least and least[j][1] is not None else centre
        for j, centre in enumerate(model.centres)
    ]


def _label_sums(own: DataFrame, columns: list[str], measure: Callable) -> dict[int, np.ndarray]:
    """Sums over the rows of each label of an array that ``measure(label, values, weights)`` returns.

    One row per label, partition and number; the sums are as many numbers as the arrays have, per label.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for b in batches:
            for j, _, values, weights in _by_label(b, columns):
                found[j] = found.get(j, 0.0) + measure(j, values, weights)
        for j, x in found.items():
            arrays = [pa.array(np.full(len(x), j, np.int32)), pa.array(np.arange(len(x), dtype=np.int32)), pa.array(x)]
            yield pa.RecordBatch.from_arrays(arrays, names=["label", "slot", "x"])

    parts = own.mapInArrow(add, "label int, slot int, x double").groupBy("label", "slot").agg(F.sum("x").alias("x"))
    out: dict[int, dict[int, float]] = {}
    for r in parts.collect():
        out.setdefault(r["label"], {})[r["slot"]] = r["x"]
    return {j: np.array([x[i] for i in range(len(x))]) for j, x in out.items()}


def _directions(y: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances of the rows from ``y``, and the unit vectors from the rows to it (none for ``y`` itself)."""
    gap = y - values
    reach = np.sqrt(np.square(gap).sum(1))
    return reach, gap / np.where(reach > 0, reach, 1.0)[:, None]


def _middles(own: DataFrame, model: Centres) -> dict[int, np.ndarray]:
    """About the point of smallest summed distance of each cluster, by a few Newton steps from the medoid.

    A step that does not lower the sum is replaced by one of Weiszfeld's, which never raises it.
    """
    columns, d = model.numeric, len(model.numeric)
    tried = {j: np.array([float(c[x]) for x in columns]) for j, c in enumerate(model.centres)}
    best: dict[int, tuple] = {}

    def measure(j, values, weights):
        reach, unit = _directions(tried[j], values)
        inverse = np.where(reach > 0, weights / np.where(reach > 0, reach, 1.0), 0.0)
        bend = inverse.sum() * np.eye(d) - (unit * inverse[:, None]).T @ unit
        return np.concatenate([[(weights * reach).sum(), inverse.sum()], (unit * weights[:, None]).sum(0), bend.ravel()])

    for _ in range(MEDOID_STEPS):
        moving = False
        for j, x in _label_sums(own, columns, measure).items():
            total, pull, slope, bend = x[0], x[1], x[2 : 2 + d], x[2 + d :].reshape(d, d)
            if j not in best or total < best[j][0]:
                best[j] = (total, tried[j], pull, slope)
                step = np.linalg.lstsq(bend, slope, rcond=1e-12)[0]
                moving |= bool(slope @ step > 1e-9 * total)
            else:
                _, _, pull, slope = best[j]
                step = slope / pull if pull > 0 else 0.0 * slope
                moving = True
            tried[j] = best[j][1] - step
        if not moving:
            break
    return {j: x[1] for j, x in best.items()}


def _bends(own: DataFrame, columns: list[str], middles: dict[int, np.ndarray]) -> dict[int, tuple]:
    """Per cluster: summed distance and its slope at the middle, and its least curvature within each radius.

    A row at distance ``R`` along ``u`` is, seen from a point ``v`` away from the middle, at least
    ``R + u.v + s*s / (2R + 3r)`` away, where ``s`` is the part of ``v`` across ``u`` and ``r`` its length at
    most.  The last terms add up to a quadratic form per radius.
    """
    d = len(columns)
    spread = _label_sums(own, columns, lambda j, v, w: np.array([(w * _directions(middles[j], v)[0]).sum(), w.sum()]))
    radii = {j: x[0] / x[1] * 2.0 ** np.arange(3, -MEDOID_RADII + 3, -1) for j, x in spread.items()}

    def measure(j, values, weights):
        reach, unit = _directions(middles[j], values)
        forms = []
        for r in radii[j]:
            share = weights / np.maximum(2 * reach + 3 * r, 1e-300)
            forms.append((share.sum() * np.eye(d) - (unit * share[:, None]).T @ unit).ravel())
        return np.concatenate([[(weights * reach).sum()], (unit * weights[:, None]).sum(0), *forms])

    sums = _label_sums(own, columns, measure)
    return {j: (x[0], x[1 : 1 + d], radii[j], x[1 + d :].reshape(-1, d, d), spread[j][1]) for j, x in sums.items()}


def _curved_bounds(bounded: DataFrame, columns: list[str], middles: dict[int, np.ndarray], bends: dict[int, tuple]) -> DataFrame:
    """``bounded`` with a ``_bound`` that also counts how the summed distance rises from the middle."""

    def raised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = b.column("_bound").to_numpy(zero_copy_only=False).copy()
            for j, at, values, _ in _by_label(b, columns):
                total, slope, radii, forms, weight = bends[j]
                v = values - middles[j]
                length = np.sqrt(np.square(v).sum(1))
                level = np.searchsorted(-radii, -length, side="right") - 1  # the smallest radius that holds v
                curved = np.einsum("ni,nij,nj->n", v, forms[np.maximum(level, 0)], v)
                low = total + v @ slope + np.where(level >= 0, curved, 0.0)
                out[at] = np.maximum(out[at], low - 1e-9 * (total + weight * length))
            yield b.set_column(b.schema.get_field_index("_bound"), "_bound", pa.array(out))

    kinds = ", ".join(f"`{c}` {t}" for c, t in bounded.dtypes)
    return bounded.mapInArrow(raised, kinds)


def _by_label(batch, columns: list[str]):
    """Label, values and weights of the rows of each label in a batch."""
    labels = batch.column("_label").to_numpy(zero_copy_only=False)
    values = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns], 1)
    weights = batch.column("_w").to_numpy(zero_copy_only=False)
    for j in np.unique(labels):
        at = np.flatnonzero(labels == j)
        yield int(j), at, values[at], weights[at]


def _sum_bounds(own: DataFrame, model: Centres, costs: dict[int, float]) -> DataFrame:
    """``own`` with ``_bound``: a row's summed distance to its cluster is at least that.

    The sum of distances is at least the length of the vector of summed gaps per column (triangle
    inequality).  Gaps are summed over bins of the column: exact for other bins, and at least the gap
    to the mean for the row's own.  The distance to the current medoid gives a second bound.
    """
    columns = model.numeric
    d, bins = len(columns), MEDOID_BINS
    shares = [i / bins for i in range(1, bins)]
    edges = own.groupBy("_label").agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in columns])
    cuts = {r["_label"]: [np.array(r[c]) for c in columns] for r in edges.collect()}
    centres = [np.array([float(c[x]) for x in columns]) for c in model.centres]

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {}
        for b in batches:
            for j, _, values, weights in _by_label(b, columns):
                sums = found.setdefault(j, np.zeros((3, d * bins)))
                for c in range(d):
                    slot = c * bins + np.searchsorted(cuts[j][c], values[:, c])
                    gap = values[:, c] - centres[j][c]
                    for row, part in zip(sums, (weights, weights * gap, weights * np.abs(gap))):
                        row += np.bincount(slot, part, d * bins)
        for j, sums in found.items():
            slots = np.flatnonzero(sums[0])
            arrays = [pa.array(np.full(len(slots), j, np.int32)), pa.array(slots.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*arrays, *[pa.array(s[slots]) for s in sums]], names=["label", "slot", "n", "s", "a"])

    parts = own.mapInArrow(tally, "label int, slot int, n double, s double, a double")
    tables = {j: np.zeros((3, d * bins)) for j in cuts}
    for r in parts.groupBy("label", "slot").agg(*[F.sum(x).alias(x) for x in "nsa"]).collect():
        tables[r["label"]][:, r["slot"]] = r["n"], r["s"], r["a"]
    tables = {j: t.reshape(3, d, bins) for j, t in tables.items()}

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = {}
        for j, (n, s, _) in tables.items():
            below = [np.cumsum(x, 1) - x for x in (n, s)]
            above = [x.sum(1, keepdims=True) - y - x for x, y in zip((n, s), below)]
            sides[j] = (below, above)
        for b in batches:
            out = np.zeros(b.num_rows)
            for j, at, values, _ in _by_label(b, columns):
                n, s, a = tables[j]
                below, above = sides[j]
                gaps = values - centres[j]
                square, slack = np.zeros(len(at)), np.zeros(len(at))
                for c in range(d):
                    slot, v = np.searchsorted(cuts[j][c], values[:, c]), gaps[:, c]
                    total = below[0][c][slot] * v - below[1][c][slot] + above[1][c][slot] - above[0][c][slot] * v
                    square += np.square(np.maximum(total + np.abs(n[c][slot] * v - s[c][slot]), 0.0))
                    slack += n[c].sum() * np.abs(v) + a[c].sum()
                far = n[0].sum() * np.sqrt(np.square(gaps).sum(1)) - costs[j]
                out[at] = np.maximum(np.sqrt(square), far) - 1e-9 * slack
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], names=[*b.schema.names, "_bound"])

    kinds = ", ".join(f"`{c}` {t}" for c, t in own.dtypes)
    return own.mapInArrow(bound, f"{kinds}, _bound double")


def _exact_sums(own: DataFrame, options: list, columns: list[str]) -> dict[int, float]:
    """Summed distance of each of the ``options`` to all rows of its label, by place in the list."""
    places: dict[int, list[int]] = {}
    for i, r in enumerate(options):
        places.setdefault(r["_label"], []).append(i)
    rivals = {j: np.array([[options[i][c] for c in columns] for i in at]) for j, at in places.items()}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {j: np.zeros(len(r)) for j, r in rivals.items()}
        for b in batches:
            for j, _, values, weights in _by_label(b, columns):
                if j not in rivals:
                    continue
                step = max(1, MEDOID_PAIRS // len(rivals[j]))
                for i in range(0, len(values), step):
                    square = np.zeros((len(values[i : i + step]), len(rivals[j])))
                    for c in range(len(columns)):
                        square += np.square(values[i : i + step, c, None] - rivals[j][None, :, c])
                    sums[j] += (np.sqrt(square) * weights[i : i + step, None]).sum(0)
        for j, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(places[j], pa.int32()), pa.array(total)], names=["at", "total"])

    found = own.mapInArrow(add, "at int, total double").groupBy("at").agg(F.sum("total").alias("total"))
    return {r["at"]: r["total"] for r in found.collect()}


def cluster_statistics(df: DataFrame, columns: list[str], label: str = "label") -> pd.DataFrame:
    """One row per cluster: rows, centroid, summed squared and plain distance to it."""
    return statistics_grid({0: df}, columns, label).drop(columns="_k")


def _stacked(labelled: dict[int, DataFrame], columns: list[str], label: str) -> DataFrame:
    values = [F.col(c).cast("double").alias(c) for c in columns]
    return reduce(DataFrame.unionAll, [df.select(F.lit(k).alias("_k"), label, *values) for k, df in labelled.items()])


def statistics_grid(labelled: dict[int, DataFrame], columns: list[str], label: str = "label") -> pd.DataFrame:
    """``cluster_statistics`` of several labellings in two aggregates, with the key as ``_k``."""
    values = _stacked(labelled, columns, label)
    found = values.groupBy("_k", label).agg(*[F.avg(c).alias(f"m_{c}") for c in columns])
    rows = found.limit(MAX_CLUSTERS + 1).collect()
    if len(rows) > MAX_CLUSTERS:
        raise ValueError(f"{label} has more than {MAX_CLUSTERS} values; these are no clusters")
    means = values.sparkSession.createDataFrame(rows, found.schema)
    gap = F.expr(" + ".join(f"pow(`{c}` - `m_{c}`, 2)" for c in columns))
    return (
        values.join(F.broadcast(means), ["_k", label])
        .withColumn("_gap", gap)
        .groupBy("_k", label, *[f"m_{c}" for c in columns])
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("_gap").alias("ss"),
            F.sum(F.sqrt("_gap")).alias("sd"),
        )
        .toPandas()
    )


def silhouette_grid(labelled: dict[int, DataFrame], stats: pd.DataFrame, columns: list[str], label: str = "label") -> dict[int, float]:
    """Mean silhouettes with squared distances of several labellings, from their statistics, in one aggregate.

    The mean squared distance of a row to a cluster is that to its centroid plus the cluster's own spread, so
    a row needs the centroids only, which come as one array per labelling.
    """
    values = _stacked(labelled, columns, label)
    rows = [
        (int(k), [(int(r[label]), float(r["n"]), float(r["ss"] / r["n"]), [float(r[f"m_{c}"]) for c in columns]) for _, r in own.iterrows()])
        for k, own in stats.groupby("_k")
    ]
    kind = "_k int, _all array<struct<label:int,n:double,spread:double,m:array<double>>>"
    held = F.broadcast(values.sparkSession.createDataFrame(rows, kind))  # one row per labelling

    def away(c: Column) -> Column:
        return reduce(lambda x, y: x + y, [F.pow(F.col(x) - c["m"][i], F.lit(2)) for i, x in enumerate(columns)]) + c["spread"]

    far = F.transform("_all", lambda c: F.struct(away(c).alias("d"), c["label"].alias("label"), c["n"].alias("n")))
    apart = values.join(held, "_k").withColumn("_far", far)
    own = F.filter("_far", lambda c: c["label"] == F.col(label))[0]
    other = F.array_min(F.filter("_far", lambda c: c["label"] != F.col(label)))["d"]
    a = own["d"] * own["n"] / (own["n"] - 1)
    width = F.when(own["n"] == 1, 0.0).when(a < other, 1 - a / other).when(a > other, other / a - 1).otherwise(0.0)
    found = apart.withColumn("_s", width).groupBy("_k").agg(F.avg("_s").alias("s")).collect()
    clusters = stats.groupby("_k").size()
    return {r["_k"]: r["s"] if clusters[r["_k"]] > 1 else math.nan for r in found}


def quality(stats: pd.DataFrame, n_columns: int) -> dict[str, float]:
    """Inertia, Calinski-Harabasz, Davies-Bouldin and BIC from the cluster statistics.

    With one cluster the indices are NaN; so is BIC if a cluster has a single row.
    """
    n, k = float(stats["n"].sum()), len(stats)
    sizes, ss = stats["n"].to_numpy(float), stats["ss"].to_numpy(float)
    centres = stats[[c for c in stats.columns if c.startswith("m_")]].to_numpy(float)
    out = {"elbow": float(ss.sum()), "calinski-harabasz": math.nan, "davies-bouldin": math.nan}
    if k > 1:
        middle = (centres * sizes[:, None]).sum(0) / n
        between = float((sizes * ((centres - middle) ** 2).sum(1)).sum())
        inside = float(ss.sum())
        out["calinski-harabasz"] = 1.0 if inside == 0 else between * (n - k) / (inside * (k - 1))
        spread = stats["sd"].to_numpy(float) / sizes
        apart = np.sqrt(((centres[:, None] - centres[None, :]) ** 2).sum(2))
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = (spread[:, None] + spread[None, :]) / apart
        ratio[~np.isfinite(ratio)] = 0.0
        out["davies-bouldin"] = float(ratio.max(1).mean())
    out["bic"] = _bic(sizes, ss, n, k, n_columns)
    return out


def _bic(sizes, ss, n, k, dims) -> float:
    if (sizes <= 1).any():
        return math.nan
    variance = ss / (sizes - 1)
    if (variance <= 0).any():
        return math.nan
    likelihood = (
        sizes * np.log(sizes)
        - sizes * math.log(n)
        - sizes * dims / 2 * np.log(2 * math.pi * variance)
        - (sizes - 1) / 2
    ).sum()
    parameters = (k - 1) + dims * k + 1
    return float(likelihood - parameters / 2 * math.log(n))


def silhouette(df: DataFrame, columns: list[str], label: str = "label") -> float:
    """Mean silhouette with squared distances; NaN for one cluster."""
    if df.select(label).distinct().limit(2).count() < 2:
        return math.nan
    rows = assemble(df, columns).withColumn("_label", F.col(label).cast("double"))
    return ClusteringEvaluator(featuresCol="_vector", predictionCol="_label").evaluate(rows)


def score_grid(
    fitted: dict[int, tuple[DataFrame, float | None]], columns: list[str], spark, with_silhouette: bool = False
) -> DataFrame:
    """Scores of the fits for several ``k`` as rows ``(k, metric, value)``.

    ``fitted``: the labelled rows and the cost of each ``k`` (None: the inertia of the labels).  All of them
    are scored together, in as many jobs as one.
    """
    labelled = {k: df for k, (df, _) in fitted.items()}
    stats = statistics_grid(labelled, columns)
    widths = silhouette_grid(labelled, stats, columns) if with_silhouette else {}
    rows = []
    for k, (_, cost) in fitted.items():
        scores = quality(stats[stats["_k"] == k], len(columns))
        if cost is not None:
            scores["elbow"] = cost
        if with_silhouette:
            scores["silhouette"] = widths.get(k, math.nan)
        rows += [(k, m, None if math.isnan(x) else float(x)) for m, x in scores.items()]
    return spark.createDataFrame(rows, "k int, metric string, value double")


def knee(ks: list[int], costs: list[float], sensitivity: float = 1.0) -> int | None:
    """Elbow of a falling convex curve (Kneedle, Satopaa et al. 2011); None without one."""
    x, y = np.asarray(ks, float), np.asarray(costs, float)
    if len(x) < 3 or x.max() == x.min() or y.max() == y.min():
        return None
    unit_x = (x - x.min()) / (x.max() - x.min())
    gap = 1.0 - (y - y.min()) / (y.max() - y.min()) - unit_x
    padded = np.pad(gap, 1, mode="edge")
    top = (gap >= padded[:-2]) & (gap >= padded[2:])
    bottom = (gap <= padded[:-2]) & (gap <= padded[2:])
    step = sensitivity * abs(np.diff(unit_x).mean())
    limit = candidate = None
    for i in range(len(x) - 1):
        if top[i]:
            limit, candidate = gap[i] - step, i
        if candidate is None:
            continue
        if bottom[i]:
            limit = 0.0
        if gap[i + 1] < limit:
            return int(ks[candidate])
    return None


def best_k(scores: DataFrame) -> DataFrame:
    """Best ``k`` per metric: knee of the cost, largest or smallest index.

    Without a knee the choice of Calinski-Harabasz stands in.  ``scores`` has one row per k and
    metric.
    """
    known = scores.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    lowest = F.col("metric") == "davies-bouldin"
    signed = F.when(lowest, -F.col("value")).otherwise(F.col("value"))
    # Equal scores go to the smaller k.
    indices = (
        known.filter(F.col("metric") != "elbow")
        .groupBy("metric")
        .agg(F.max_by("k", F.struct(signed, -F.col("k"))).alias("best_k"))
    )
    curve = known.filter(F.col("metric") == "elbow").orderBy("k").collect()
    elbow = knee([r["k"] for r in curve], [r["value"] for r in curve])
    chosen = scores.sparkSession.createDataFrame([(elbow,)], "knee int")
    fallback = indices.filter(F.col("metric") == "calinski-harabasz").select("best_k")
    spare = fallback.agg(F.max("best_k").alias("spare"))
    row = chosen.crossJoin(F.broadcast(spare)).select(  # one row each
        F.lit("elbow").alias("metric"), F.coalesce("knee", "spare").alias("best_k")
    )
    return indices.unionByName(row) if curve else indices
