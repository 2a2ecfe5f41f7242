"""Nearest texts by whole-number term weights, against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillroll.operators import terms as tm


def grams(text):
    cleaned = re.sub("[^0-9a-zA-Z一-鿿]+", "", text).lower()
    return [cleaned[i : i + 2] for i in range(len(cleaned) - 1)] if len(cleaned) >= 2 else [cleaned]


def plain(queries, refs, k):
    held = Counter(g for _, t in refs for g in set(grams(t)))
    idf = {g: math.floor(math.log((len(refs) + 1) / (n + 1)) * 1000) for g, n in held.items()}

    def vector(text):
        raw = {g: n * idf[g] for g, n in Counter(grams(text)).items() if idf.get(g, 0) > 0}
        square = sum(x * x for x in raw.values())
        return {g: math.floor(1_000_000.0 * x / math.sqrt(square)) for g, x in raw.items()}

    filed, out = [(i, vector(t)) for i, t in refs], []
    for q, text in queries:
        own = vector(text)
        scored = [(sum(w * v.get(g, 0) for g, w in own.items()) // 100_000_000, i) for i, v in filed]
        best = sorted((-s, i) for s, i in scored if s > 0)[:k]
        out += [(q, i, -s / 10_000, rank + 1) for rank, (s, i) in enumerate(best)]
    return sorted(out)


def texts(n, seed, letters="abcd 茶é"):
    draw = random.Random(seed)
    return [(i, "".join(draw.choice(letters) for _ in range(draw.randrange(9)))) for i in range(n)]


@pytest.mark.parametrize("max_entries", [4_000_000, 60])
def test_same_as_plain_search(spark, max_entries):
    queries, refs = texts(80, 1), texts(120, 2) + [(900, "ab ab"), (901, "abab"), (902, "AB-AB")]
    r = spark.createDataFrame(refs, "ref_id long, text string")
    q = spark.createDataFrame([*queries, (999, None)], "query_id long, text string")
    idf = tm.inverse_frequencies(r, "text")
    near = tm.nearest_terms(
        tm.term_vectors(q, "query_id", "text", idf), tm.term_vectors(r, "ref_id", "text", idf), 4, max_entries
    )
    assert sorted((x.query_id, x.ref_id, x.score, x["rank"]) for x in near.collect()) == plain(queries, refs, 4)


def test_weights_make_unit_vectors(spark):
    rows = spark.createDataFrame(texts(50, 3), "id long, text string")
    vectors = tm.term_vectors(rows, "id", "text", tm.inverse_frequencies(rows, "text"))
    for r in vectors.collect():
        assert abs(math.sqrt(sum(t.weight**2 for t in r.terms)) - tm.UNIT) < 10


def test_empty_sides(spark):
    rows = spark.createDataFrame(texts(9, 4), "id long, text string")
    idf = tm.inverse_frequencies(rows, "text")
    vectors = tm.term_vectors(rows, "id", "text", idf)
    none = vectors.filter(F.lit(False))
    q, r = (vectors.withColumnRenamed("id", c) for c in ("query_id", "ref_id"))
    assert tm.nearest_terms(q, none.withColumnRenamed("id", "ref_id"), 3).count() == 0
    assert tm.nearest_terms(none.withColumnRenamed("id", "query_id"), r, 3).count() == 0
