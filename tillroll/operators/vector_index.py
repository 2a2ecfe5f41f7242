"""Inverted file of reference vectors: cells around centroids, pruned by exact bounds.

The centroids are fitted on a bounded sample; every reference is filed in the cell of its nearest centroid,
and a cell knows its number of rows and between which distances from the centroid they lie.  A query first
searches the nearest cells that hold enough references, which gives a distance no neighbour can exceed; then
it searches every other cell that can hold something as near.

A reference at distance ``r`` from a centroid, seen from a query at distance ``d`` under an angle of cosine
``s``, is ``d*d + r*r - 2*d*r*s`` away.  With ``s = 1`` this bounds all references of a cell, and the result
is that of a search of everything.  In many dimensions large cosines are rare: a smaller ``spread`` rules out
many more cells and loses the neighbours beyond it.

Cosine uses the same cells over unit vectors: there the squared distance is ``2 - 2 cosine``.

Cells are packed into blocks of a counted size.  Each block is broadcast and searched where the queries are,
so vectors don't move, and data that no bound separates cost what a search of everything costs.  A cell with
more rows than a block is dealt over several.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.neighbours import (
    _PAIR_SCHEMA,
    BLOCKS_AT_ONCE,
    DIGITS,
    MAX_BROADCAST_VALUES,
    _ranked,
    _square_distances,
    _unit,
)
from tillroll.operators.taxonomy import fixed_sample
from tillroll.session import materialize

#: Centroids, at most; their number is the root of the number of references.
MAX_CELLS = 4096
#: Rows per centroid, and in all, that centroids are fitted on.
FIT_PER_CELL, FIT_ROWS = 64, 50_000
FIT_ROUNDS = 5
#: Cells of the first search.
FIRST_CELLS = 2
#: Scores are rounded before ranking, so a bound must leave that much room.
_ROOM = 2 * 10.0**-DIGITS
_STEP = 1_000_000
#: Share of a cell's pairs within their limits above which all of them are ranked.
_MANY = 0.05
#: Numbers up to here are compared with the limits in single precision, with room for its errors.
_SINGLE, _ERROR = 1e15, 1e-5


def _array(column: pa.Array) -> np.ndarray:
    """Vectors of a batch as rows of a matrix."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    return flat.reshape(n, -1) if n else np.empty((0, 0))


def _placed(x: np.ndarray, metric: str) -> np.ndarray:
    return _unit(x) if metric == "cosine" else x


def _lloyd(sample: np.ndarray, cells: int, rounds: int) -> np.ndarray:
    """Centroids of a sample; an empty cell keeps its centroid."""
    centroids = sample[:cells].copy()
    for _ in range(rounds):
        step = max(1, _STEP // len(centroids))
        own = np.concatenate([_square_distances(sample[i : i + step], centroids).argmin(1) for i in range(0, len(sample), step)])
        n = np.bincount(own, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        centroids[n > 0] = sums[n > 0] / n[n > 0, None]
    return centroids


@dataclass
class Cells:
    """What is known of the cells: centroids, ranges of the distances from them, numbers of rows."""

    centroids: np.ndarray
    inner: np.ndarray
    outer: np.ndarray
    count: np.ndarray


@dataclass
class VectorIndex(Cells):
    """References ``(ref_id, vector, cell, block)`` in a written table, with their cells."""

    rows: DataFrame
    n_blocks: int
    metric: str

    def cells(self) -> Cells:
        return Cells(self.centroids, self.inner, self.outer, self.count)


def build_index(
    refs: DataFrame,
    metric: str = "l2",
    cells: int | None = None,
    fit_rows: int = FIT_ROWS,
    max_values: int = MAX_BROADCAST_VALUES,
) -> VectorIndex:
    """File every row of ``refs(ref_id, vector)``; only the centroids come from a sample, chosen by hash.

    ``max_values``: numbers in a block.
    """
    refs = refs.select("ref_id", F.col("vector").cast("array<double>").alias("vector"))
    total = refs.count()
    cells = max(1, min(MAX_CELLS, cells or int(np.ceil(np.sqrt(total))), total))
    sample = fixed_sample(refs, "ref_id", max(cells, min(fit_rows, FIT_PER_CELL * cells))).toArrow()
    centroids = np.zeros((0, 0))
    if sample.num_rows:
        centroids = _lloyd(_placed(_array(sample["vector"].combine_chunks()), metric), cells, FIT_ROUNDS)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _placed(_array(b.column(1)), metric)
            step = max(1, _STEP // len(centroids))
            cell, reach = [], []
            for at in range(0, len(x), step):
                d = _square_distances(x[at : at + step], centroids)
                cell.append(d.argmin(1))
                reach.append(np.sqrt(d.min(1)))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.concatenate(cell).astype(np.int32)), pa.array(np.concatenate(reach))],
                ["ref_id", "vector", "cell", "reach"],
            )

    rows = materialize(refs.mapInArrow(file, "ref_id long, vector array<double>, cell int, reach double"))
    inner, outer, count = np.zeros(len(centroids)), np.zeros(len(centroids)), np.zeros(len(centroids), np.int64)
    cell_sizes = rows.groupBy("cell").agg(F.min("reach"), F.max("reach"), F.count(F.lit(1)))
    for cell, low, high, n in cell_sizes.collect():  # one row per cell
        inner[cell], outer[cell], count[cell] = low, high, n
    dims = centroids.shape[1] if len(centroids) else 1
    fits = max(1, max_values // max(1, dims))
    first, shares = _packed(count, fits)
    places = rows.sparkSession.createDataFrame(
        [(i, int(f), int(n)) for i, (f, n) in enumerate(zip(first, shares))], "cell int, first int, shares int"
    )
    share = F.pmod(F.xxhash64("ref_id"), F.col("shares")).cast("int")
    blocked = rows.join(F.broadcast(places), "cell").select("ref_id", "vector", "cell", (F.col("first") + share).alias("block"))
    n_blocks = int((first + shares).max(initial=0))
    if n_blocks > 1:
        blocked = materialize(blocked, partition_by=["block"])
    return VectorIndex(centroids, inner, outer, count, blocked, n_blocks, metric)


def _packed(count: np.ndarray, fits: int) -> tuple[np.ndarray, np.ndarray]:
    """First block of each cell and the number of blocks it is dealt over; about ``fits`` rows a block."""
    first, shares = np.zeros(len(count), np.int64), np.ones(len(count), np.int64)
    block, held = 0, 0
    for cell, n in enumerate(count.tolist()):
        if held and held + n > fits:
            block, held = block + 1, 0
        first[cell], shares[cell] = block, max(1, -(-n // fits))
        block, held = block + int(shares[cell]) - 1, held + n if shares[cell] == 1 else fits
    return first, shares




def _near(x: np.ndarray, index: Cells, need: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances to all centroids, and which cells the first search of each query covers."""
    d = np.sqrt(_square_distances(x, index.centroids))
    order = d.argsort(1, kind="stable")
    first = (index.count[order].cumsum(1) < need).sum(1) + 1
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(order.shape[1])[None], 1)
    return d, rank < np.maximum(first, probes)[:, None]


def _beyond(d: np.ndarray, limit: np.ndarray, index: Cells, spread: float) -> np.ndarray:
    """Cells that may hold a reference within the limit, a squared distance per query."""
    nearest = np.clip(d * spread, index.inner[None], index.outer[None])
    low = d * d + nearest * nearest - 2 * spread * d * nearest - 1e-6 * (1 + d * d)
    return low <= limit[:, None]


def _cell_top(q_ids, q, r_ids, r, k, metric, skip_same) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of the query, id and cost of the k best references of a cell, whose ids ascend."""
    cost = np.round(-(_unit(q) @ _unit(r).T) if metric == "cosine" else _square_distances(q, r), DIGITS)
    if skip_same:
        cost[q_ids[:, None] == r_ids[None, :]] = np.inf
    best = cost.argsort(1, kind="stable")[:, :k]
    found = np.take_along_axis(cost, best, 1)
    row, col = np.nonzero(np.isfinite(found))
    return row, r_ids[best[row, col]], found[row, col]


def _pair_cost(q: np.ndarray, r: np.ndarray, metric: str) -> np.ndarray:
    """Costs of pairs, row by row."""
    if metric == "cosine":
        return np.round(-np.einsum("ij,ij->i", _unit(q), _unit(r)), DIGITS)
    d = (q * q).sum(1) + (r * r).sum(1) - 2.0 * np.einsum("ij,ij->i", q, r)
    return np.round(np.maximum(d, 0.0), DIGITS)


def _k_best(row, ref, cost, k) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best references of every row, in order."""
    best = np.lexsort((ref, cost, row))
    row, ref, cost = row[best], ref[best], cost[best]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[kept], ref[kept], cost[kept]


class _Block:
    """References of a block, cell by cell, and for a quick look their products with a query in single precision."""

    def __init__(self, starts: np.ndarray, r_ids: np.ndarray, r: np.ndarray, metric: str):
        self.starts, self.r_ids, self.r, self.metric = starts, r_ids, r, metric
        placed = _placed(r, metric)
        self.single = self._in_single(placed)
        if self.single:
            norm = (placed * placed).sum(1)
            self.reach = float(np.sqrt(np.nanmax(norm, initial=0.0)))
            self.lean = np.hstack([placed, -0.5 * norm[:, None]]).astype(np.float32)

    @staticmethod
    def _in_single(x: np.ndarray) -> bool:
        return bool(np.nanmax(np.abs(x), initial=0.0) < _SINGLE)

    def search(self, q_ids, q, visit, k, skip_same, limit=None):
        """Row of the query, id and cost of the k best references in the visited cells, none beyond the limits.

        A pair within its limit has a product of at least ``least``; only such pairs get their exact cost.  A
        query's limit shrinks to its k-th best so far.
        """
        placed = _placed(q, self.metric)
        quick = limit is not None and self.single and self._in_single(placed)
        if quick:
            norm, limit = (placed * placed).sum(1), limit.copy()
            room = _ERROR * (np.sqrt(norm) * self.reach + self.reach**2 + norm)
            least = lambda: ((norm - limit) / 2 - room - _ERROR * np.minimum(limit, 1e30)).astype(np.float32)[:, None]
            lean = np.hstack([placed, np.ones((len(q), 1))]).astype(np.float32)
            bar = least()
        found, n, full = [], 0, 8 * k * len(q)
        for cell in np.flatnonzero(visit.any(0) & (self.starts[1:] > self.starts[:-1])):
            here, of = np.flatnonzero(visit[:, cell]), slice(self.starts[cell], self.starts[cell + 1])
            r_ids, r = self.r_ids[of], self.r[of]
            step = max(1, _STEP // len(r_ids))
            for at in range(0, len(here), step):
                some = here[at : at + step]
                near = None
                if quick:
                    hit = lean[some] @ self.lean[of].T >= bar[some]
                    near = np.flatnonzero(hit) if np.count_nonzero(hit) <= _MANY * hit.size else None
                if near is None:
                    row, ref, cost = _cell_top(q_ids[some], q[some], r_ids, r, k, self.metric, skip_same)
                    row = some[row]
                else:
                    row, col = np.divmod(near, len(r_ids))
                    row, ref = some[row], r_ids[col]
                    other = q_ids[row] != ref if skip_same else np.ones(len(row), bool)
                    row, ref, col = row[other], ref[other], col[other]
                    cost = _pair_cost(q[row], r[col], self.metric)
                    fine = np.isfinite(cost)
                    row, ref, cost = row[fine], ref[fine], cost[fine]
                if len(row):
                    found.append((row, ref, cost))
                    n += len(row)
                if n > full:
                    found = [_k_best(*(np.concatenate(c) for c in zip(*found)), k)]
                    n = len(found[0][0])
                    full = n + 8 * k * len(q)
                    if quick:
                        kth = np.flatnonzero(np.bincount(found[0][0], minlength=len(q)) == k)
                        worst = found[0][2][np.searchsorted(found[0][0], kth, "right") - 1]
                        worst = 2.0 + 2.0 * worst if self.metric == "cosine" else worst
                        limit[kth] = np.minimum(limit[kth], worst + 2 * _ROOM)
                        bar = least()
        return _k_best(*(np.concatenate(c) for c in zip(*found)), k) if found else None


def _search_block(index: VectorIndex, queries: DataFrame, block: int, k: int, skip_same: bool, need: int, probes: int, spread: float | None):
    """The k best references of one block for every query that visits one of its cells."""
    spark, metric, cells = queries.sparkSession, index.metric, index.cells()
    rows = index.rows.filter(F.col("block") == block) if index.n_blocks > 1 else index.rows
    local = rows.select("cell", "ref_id", "vector").toArrow()
    own, ids = local["cell"].to_numpy(), local["ref_id"].to_numpy()
    order = np.lexsort((ids, own))
    held = spark.sparkContext.broadcast((own[order], ids[order], _array(local["vector"].combine_chunks())[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell_of, r_ids, r = held.value
        block = _Block(np.searchsorted(cell_of, np.arange(len(cells.count) + 1)), r_ids, r, metric)
        for b in batches:
            for at in range(0, b.num_rows, step := max(1, _STEP // len(cells.count))):
                part = b.slice(at, step)
                q_ids, q = part.column(0).to_numpy(), _array(part.column(1))
                d, visit = _near(_placed(q, metric), cells, need, probes)
                limit = None
                if spread is not None:
                    limit = part.column(2).to_numpy(zero_copy_only=False)
                    visit = ~visit & _beyond(d, limit, cells, spread)
                best = block.search(q_ids, q, visit, k, skip_same, limit)
                if best:
                    row, ref, cost = best
                    score = -cost if metric == "cosine" else cost
                    yield pa.RecordBatch.from_pydict({"query_id": q_ids[row], "ref_id": ref, "score": score})

    return queries.mapInArrow(run, _PAIR_SCHEMA)


def _search(index: VectorIndex, queries: DataFrame, k: int, skip_same: bool, need: int, probes: int, spread: float | None = None, best: DataFrame | None = None) -> DataFrame:
    """The k best of ``best`` and of what all blocks hold, written."""
    for start in range(0, index.n_blocks, BLOCKS_AT_ONCE):
        blocks = range(start, min(index.n_blocks, start + BLOCKS_AT_ONCE))
        found = [_search_block(index, queries, b, k, skip_same, need, probes, spread) for b in blocks]
        merged = reduce(DataFrame.unionAll, found if best is None else [best, *found])
        best = materialize(_ranked(merged, k, index.metric).drop("rank"))
    return best


def search_index(
    index: VectorIndex,
    queries: DataFrame,
    k: int,
    skip_same_id: bool = False,
    spread: float = 1.0,
    probes: int = FIRST_CELLS,
) -> tuple[DataFrame, DataFrame]:
    """The ``k`` nearest references of every query, and how many references each was compared with.

    Rows ``(query_id, ref_id, score, rank)`` and ``(query_id, candidates)``.  Exact with ``spread`` 1.  The
    first search covers the ``probes`` nearest cells, and as many as hold ``k`` references.
    """
    queries = queries.select("query_id", F.col("vector").cast("array<double>").alias("vector"))
    need = k + skip_same_id
    if not index.n_blocks:
        none = queries.limit(0).select("query_id", F.lit(0).cast("long").alias("ref_id"), F.lit(0.0).alias("score"))
        return none.withColumn("rank", F.lit(1)), queries.select("query_id", F.lit(0).cast("long").alias("candidates"))
    best = _search(index, queries, k, skip_same_id, need, probes)
    # The limit of a query is the squared distance of its k-th neighbour, if it has as many.
    to_square = 2.0 - 2.0 * F.col("worst") if index.metric == "cosine" else F.col("worst")
    worst = F.min("score") if index.metric == "cosine" else F.max("score")
    limits = best.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), worst.alias("worst"))
    limit = F.when(F.col("n") >= k, to_square + 2 * _ROOM).otherwise(F.lit(float("inf")))
    asked = materialize(
        queries.join(limits, "query_id", "left").select(
            "query_id", "vector", F.coalesce(limit, F.lit(float("inf"))).alias("limit")
        )
    )
    best = _search(index, asked, k, skip_same_id, need, probes, spread, best)
    metric, cells = index.metric, index.cells()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, step := max(1, _STEP // len(cells.count))):
                part = b.slice(at, step)
                d, visit = _near(_placed(_array(part.column(1)), metric), cells, need, probes)
                visit |= _beyond(d, part.column(2).to_numpy(zero_copy_only=False), cells, spread)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(visit @ cells.count)], ["query_id", "candidates"])

    return _ranked(best, k, index.metric), asked.mapInArrow(count, "query_id long, candidates long")
