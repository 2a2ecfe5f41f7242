"""Nearest texts by weighted character grams, through a term index.

Weights are whole numbers, so a dot product is the same in any order of addition, on any number of blocks
and in any engine.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.names import char_grams
from tillroll.operators.neighbours import _PAIR_SCHEMA, BLOCKS_AT_ONCE, _ranked
from tillroll.session import materialize

#: Inverse frequencies are counted in thousandths, weights of a unit vector in millionths.
IDF_UNIT, UNIT = 1000, 1_000_000
#: Scores are cut to four digits.
SCORE_UNIT = 10_000
#: Entries ``(term, reference, weight)`` of a block of the index.
MAX_ENTRIES = 4_000_000


def inverse_frequencies(texts: DataFrame, text: str, n: int = 2) -> DataFrame:
    """``(term, idf)`` over the rows of ``texts``: thousandths of ``ln((rows + 1) / (rows with the term + 1))``.

    Terms of all rows weigh nothing and are left out.
    """
    rows = texts.select(F.array_distinct(char_grams(F.col(text), n)).alias("terms"))
    total = rows.agg(F.count(F.lit(1)).alias("rows"))  # one row
    held = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("held"))
    share = (F.col("rows") + 1).cast("double") / (F.col("held") + 1)
    idf = F.floor(F.log(share) * IDF_UNIT).cast("long")
    return held.crossJoin(F.broadcast(total)).select("term", idf.alias("idf")).filter("idf > 0")


def term_vectors(texts: DataFrame, id_column: str, text: str, idf: DataFrame, n: int = 2) -> DataFrame:
    """``(id, terms)``: the weighted terms of every row as a unit vector; rows without known terms are left out."""
    counts = texts.select(id_column, F.explode(char_grams(F.col(text), n)).alias("term")).groupBy(id_column, "term").agg(
        F.count(F.lit(1)).alias("n")
    )
    raw = counts.join(idf, "term").select(id_column, "term", (F.col("n") * F.col("idf")).alias("raw"))
    whole = raw.groupBy(id_column).agg(
        F.sum(F.col("raw") * F.col("raw")).alias("square"), F.sort_array(F.collect_list(F.struct("term", "raw"))).alias("terms")
    )

    def weight(t: Column) -> Column:
        return F.floor(F.lit(float(UNIT)) * t["raw"] / F.sqrt("square")).cast("long")

    weighed = F.transform("terms", lambda t: F.struct(t["term"].alias("term"), weight(t).alias("weight")))
    return whole.select(id_column, weighed.alias("terms"))


def nearest_terms(queries: DataFrame, refs: DataFrame, k: int, max_entries: int = MAX_ENTRIES) -> DataFrame:
    """The ``k`` references with the largest cosine of every query: ``(query_id, ref_id, score, rank)``.

    ``queries`` has ``(query_id, terms)``, ``refs`` has ``(ref_id, terms)`` as made by ``term_vectors``; ids
    are numbers.  References that share no term aren't neighbours.  The references are filed by term, in
    blocks of about ``max_entries`` entries; each block is broadcast, and a query adds up the lists of its own
    terms where it is.  Scores are cut to four digits, ties go to the smaller id.
    """
    refs, queries = materialize(refs.select("ref_id", "terms")), queries.select("query_id", "terms")
    entries = refs.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = max(1, -(-entries // max_entries))
    filed = refs.withColumn("block", F.pmod(F.xxhash64("ref_id"), F.lit(n_blocks)).cast("int"))
    if n_blocks > 1:
        filed = materialize(filed, partition_by=["block"])
        queries = materialize(queries)
    best = None
    for start in range(0, n_blocks, BLOCKS_AT_ONCE):
        found = [
            _search(queries, filed.filter(F.col("block") == b), k) for b in range(start, min(n_blocks, start + BLOCKS_AT_ONCE))
        ]
        merged = reduce(DataFrame.unionAll, found if best is None else [best, *found])
        if n_blocks == 1:
            return _ranked(merged, k, "cosine")
        best = materialize(_ranked(merged, k, "cosine").drop("rank"))
    return _ranked(best, k, "cosine")


def _search(queries: DataFrame, block: DataFrame, k: int) -> DataFrame:
    """The ``k`` best references of one block of counted size."""
    rows = block.select("ref_id", F.explode("terms").alias("t")).select("t.term", "ref_id", "t.weight").toArrow()
    term = np.array(rows["term"].to_pylist(), object)
    ids, place = np.unique(rows["ref_id"].to_numpy(), return_inverse=True)
    order = np.argsort(term, kind="stable") if len(term) else np.empty(0, int)
    names, starts = np.unique(term[order], return_index=True) if len(term) else (np.empty(0, object), np.empty(0, int))
    ends = [*starts[1:].tolist(), len(term)]
    lists = dict(zip(names.tolist(), zip(starts.tolist(), ends)))
    held = queries.sparkSession.sparkContext.broadcast((lists, place[order], rows["weight"].to_numpy()[order], ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, place, weight, ids = held.value
        for b in batches:
            out_q, out_r, out_s = [], [], []
            for q, terms in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                known = [(*lists[t["term"]], t["weight"]) for t in terms if t["term"] in lists]
                if not known:
                    continue
                where = np.concatenate([place[i:j] for i, j, _ in known])
                added = np.concatenate([weight[i:j] * w for i, j, w in known])
                dots = np.bincount(where, added, len(ids)).astype(np.int64)  # whole numbers below 2**53
                scores = dots // (UNIT * UNIT // SCORE_UNIT)
                met = np.flatnonzero(scores > 0)
                if len(met) > k:
                    least = np.partition(scores[met], len(met) - k)[len(met) - k]
                    met = met[scores[met] >= least]
                met = met[np.argsort(-scores[met], kind="stable")][:k]
                out_q.append(np.repeat(q, len(met)))
                out_r.append(ids[met])
                out_s.append(scores[met] / SCORE_UNIT)
            if out_q:
                yield pa.RecordBatch.from_pydict(
                    {"query_id": np.concatenate(out_q).astype(np.int64), "ref_id": np.concatenate(out_r).astype(np.int64), "score": np.concatenate(out_s)}
                )

    return queries.mapInArrow(run, _PAIR_SCHEMA)
