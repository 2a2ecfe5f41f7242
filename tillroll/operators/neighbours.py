"""Nearest reference vectors, label choice and votes.

Scores are rounded to four digits before ranking and ties go to the smaller reference id, so a
result does not depend on the partitioning.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.ranking import dense_index
from tillroll.session import materialize, small

DIGITS = 4
MAX_BROADCAST_VALUES = 4_000_000  # numbers in a broadcast reference matrix: 32 MB
BLOCKS_AT_ONCE = 8  # blocks between two merges
_BLOCK = 1_000_000


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype("float64") if len(column) else np.empty((0, 0))


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm == 0, 1.0, norm)


def _square_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.maximum(d, 0.0)


def _block_top(q_ids, q, r_ids, r, k, metric, skip_same) -> pd.DataFrame:
    """The k best of one block of references (ordered by id) for every query."""
    out_q, out_r, out_s = [], [], []
    step = max(1, _BLOCK // max(1, len(r_ids)))
    for start in range(0, len(q_ids) if len(r_ids) else 0, step):
        part = slice(start, start + step)
        if metric == "cosine":
            cost = -(_unit(q[part]) @ _unit(r).T)
        else:
            cost = _square_distances(q[part], r)
        cost = np.round(cost, DIGITS)
        if skip_same:
            cost[q_ids[part][:, None] == r_ids[None, :]] = np.inf
        kth = np.partition(cost, min(k, cost.shape[1]) - 1, axis=1)[:, min(k, cost.shape[1]) - 1]
        for i, row in enumerate(cost):
            hit = np.flatnonzero(row <= kth[i])
            hit = hit[np.isfinite(row[hit])]
            hit = hit[np.argsort(row[hit], kind="stable")][:k]
            out_q.append(np.repeat(q_ids[start + i], len(hit)))
            out_r.append(r_ids[hit])
            out_s.append(row[hit])
    join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
    score = join(out_s, "float64")
    return pd.DataFrame(
        {
            "query_id": join(out_q, "int64"),
            "ref_id": join(out_r, "int64"),
            "score": -score if metric == "cosine" else score,
        }
    )


_PAIR_SCHEMA = "query_id long, ref_id long, score double"


def _ranked(pairs: DataFrame, k: int, metric: str) -> DataFrame:
    cost = -F.col("score") if metric == "cosine" else F.col("score")
    order = Window.partitionBy("query_id").orderBy(cost, "ref_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(
    queries: DataFrame,
    refs: DataFrame,
    k: int,
    metric: str = "l2",
    skip_same_id: bool = False,
    max_broadcast_values: int = MAX_BROADCAST_VALUES,
    blocks_at_once: int = BLOCKS_AT_ONCE,
) -> DataFrame:
    """The ``k`` nearest references of every query: rows ``(query_id, ref_id, score, rank)``.

    ``queries`` has ``(query_id, vector)``, ``refs`` has ``(ref_id, vector)``.  The score is the
    squared distance (``l2``) or the cosine.  References are cut into blocks of at most about
    ``max_broadcast_values`` numbers.  Each block is broadcast and searched in Arrow batches of the
    queries, which stay where they are; ``k`` pairs per query and block go on.  The search is exact,
    with the same arithmetic whatever the number of blocks.
    """
    size = refs.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("d")).first()
    values = (size["n"] or 0) * (size["d"] or 0)
    n_blocks = max(1, -(-values // max_broadcast_values))
    refs, queries = refs.select("ref_id", "vector"), queries.select("query_id", "vector")
    if n_blocks == 1:
        return _ranked(_search(queries, refs, k, metric, skip_same_id), k, metric)
    block = F.pmod(F.xxhash64("ref_id"), F.lit(n_blocks)).cast("int")
    stored = materialize(refs.withColumn("block", block), partition_by=["block"])
    best = None
    for start in range(0, n_blocks, blocks_at_once):
        found = [
            _search(queries, stored.filter(F.col("block") == b), k, metric, skip_same_id)
            for b in range(start, min(n_blocks, start + blocks_at_once))
        ]
        merged = reduce(DataFrame.unionAll, found if best is None else [best, *found])
        best = materialize(_ranked(merged, k, metric).drop("rank"))
    return _ranked(best, k, metric)


def _search(queries: DataFrame, block: DataFrame, k: int, metric: str, skip_same: bool) -> DataFrame:
    """The ``k`` best references of one block, whose size was checked, for every query."""
    local = block.select("ref_id", "vector").orderBy("ref_id").toPandas()
    held = queries.sparkSession.sparkContext.broadcast(
        (local["ref_id"].to_numpy("int64"), _matrix(local["vector"]))
    )

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r_ids, r = held.value
        for b in batches:
            if len(b):
                yield _block_top(
                    b["query_id"].to_numpy("int64"), _matrix(b["vector"]), r_ids, r, k, metric, skip_same
                )

    return queries.mapInPandas(search, _PAIR_SCHEMA)


def vote(
    queries: DataFrame,
    neighbours: DataFrame,
    categories: DataFrame,
    ks: Iterable[int] = (1, 3, 5, 10),
    threshold: float = 250.0,
) -> DataFrame:
    """Majority category of the first ``k`` neighbours below the threshold, for every ``k``.

    Ties go to the category of the nearest neighbour; no neighbour gives null.
    Columns: ``query_id, pred_1, pred_3, ...``.
    """
    ks = list(ks)
    near = (
        neighbours.filter((F.col("score") < threshold) & (F.col("rank") <= max(ks)))
        .join(categories.select("ref_id", "category"), "ref_id")
        .withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks])))
        .filter(F.col("rank") <= F.col("k"))
    )
    counted = near.groupBy("query_id", "k", "category").agg(
        F.count(F.lit(1)).alias("n"), F.min("rank").alias("first")
    )
    best = counted.groupBy("query_id").agg(
        *[
            F.max_by(
                "category", F.when(F.col("k") == k, F.struct(F.col("n"), -F.col("first")))
            ).alias(f"pred_{k}")
            for k in ks
        ]
    )
    return queries.select("query_id").join(best, "query_id", "left")


def nearest_label(queries: DataFrame, labels: DataFrame, name: str = "label") -> DataFrame:
    """Label with the highest cosine and its score; ``labels`` has ``(ref_id, <name>, vector)``."""
    top = nearest(queries, labels.select("ref_id", "vector"), 1, "cosine")
    return top.join(labels.select("ref_id", name), "ref_id").select(
        "query_id", F.col(name).alias("best"), "score"
    )


def two_stage_label(queries: DataFrame, level_1: DataFrame, level_2: DataFrame) -> DataFrame:
    """Best first-level label, then the best second-level label below it.

    ``level_1`` has ``(label, vector)``; ``level_2`` has ``(parent, label, vector)``.  A rest label
    ("Other") is a row of both like any other.  The labels of one parent are few, so they join as
    candidates of the queries that chose the parent; the choice is an aggregate per query.
    """
    # Numbered in order of the labels, so that a tie goes to the smaller label.
    keyed = level_1.withColumn("all", F.lit(0))
    code = dense_index(keyed, "all", "label").select("label", F.col("code").cast("long").alias("ref_id"))
    numbered = level_1.join(code, "label")
    first = nearest_label(queries, numbered).withColumnsRenamed(
        {"best": "label_1", "score": "score_1"}
    )
    chosen = queries.join(first, "query_id")
    candidates = chosen.join(
        small(
            level_2.select(
                F.col("parent").alias("label_1"),
                F.col("label").alias("label_2"),
                F.col("vector").alias("label_vector"),
            )
        ),
        "label_1",
        "left",
    )
    score = F.round(cosine(F.col("vector"), F.col("label_vector")), DIGITS)
    return (
        candidates.withColumn("score_2", score)
        .groupBy("query_id")
        .agg(
            F.first("label_1").alias("label_1"),
            F.first("score_1").alias("score_1"),
            F.max("score_2").alias("score_2"),
            F.min_by("label_2", F.struct(-F.col("score_2"), F.col("label_2"))).alias("label_2"),
        )
    )


def cosine(a: F.Column, b: F.Column) -> F.Column:
    """Cosine of two arrays of equal length; null for a zero vector."""

    def dot(x, y):
        terms = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)

    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def mean_vectors(df: DataFrame, by: str, vector: str = "vector") -> DataFrame:
    """Mean vector per label."""
    cells = df.select(by, F.posexplode(vector).alias("pos", "x"))
    means = cells.groupBy(by, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy(by).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda c: c["x"]).alias(
            "vector"
        )
    )
