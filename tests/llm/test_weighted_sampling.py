from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
from brute import SMALL, frame  # noqa: F401
from pyspark.sql import functions as F

from tillroll.llm import neighbours, weighted_sampling
from tillroll.llm.registry import op5_weighted_fingerprint


def jaccard(a, b):
    a, b = weighted_sampling.terms(a), weighted_sampling.terms(b)
    every = {*a, *b}
    return sum(min(a[t], b[t]) for t in every) / max(1, sum(max(a[t], b[t]) for t in every))


def test_agreement_is_the_weighted_jaccard_similarity():
    draw = random.Random(1)
    pairs = []
    for _ in range(60):
        common = [draw.choice("abcdefghij") + str(draw.randrange(9)) for _ in range(draw.randrange(5, 80))]
        pairs.append((" ".join(common + ["x"] * 9), " ".join(common[: draw.randrange(len(common))] + ["x"] * 3 + ["y"])))
    sampler = weighted_sampling.Sampler(512)
    a, b = (sampler.signatures([weighted_sampling.terms(p[k]) for p in pairs]) for k in (0, 1))
    error = (a == b).mean(1) - np.array([jaccard(*p) for p in pairs])
    assert abs(error.mean()) < 0.01 and np.sqrt((error**2).mean()) < 0.03


def test_cache_and_pieces_change_nothing(monkeypatch):
    texts = [" ".join(f"w{i % (k + 7)}" for i in range(400)) for k in range(30)] + ["", "one"]
    bags = [weighted_sampling.terms(t) for t in texts]
    plain = weighted_sampling.Sampler().signatures(bags)
    monkeypatch.setattr(weighted_sampling, "_PIECE", 5)
    small = weighted_sampling.Sampler(cache_rows=3)
    assert (small.signatures(bags) == plain).all() and (small.signatures(bags[::-1])[::-1] == plain).all()
    assert (plain[-2] == 0).all()


def test_fingerprints(frame):
    rows = [(1, "a b b", "c"), (2, "B a\tb", "c"), (3, None, "c"), (4, "", "c"), (5, "z " * 60_000, "c"), (1, "a b b", "c")]
    got = weighted_sampling.fingerprints(frame(rows, "doc_id long, text string, fingerprint string"))
    by_id = {r.doc_id: r.fingerprint for r in got.collect()}
    assert got.count() == 6 and by_id[1] == by_id[2] and by_id[3] == by_id[4] == "0" * 256 and by_id[5] != by_id[1]
    pair = frame([(by_id[1], by_id[2], by_id[5])], "a string, b string, c string")
    like = pair.select(
        weighted_sampling.likeness(F.col("a"), F.col("b")), weighted_sampling.likeness(F.col("a"), F.col("c"))
    ).first()
    assert like[0] == 1.0 and like[1] < 0.2


def test_next_rows(frame):
    def echo():
        return lambda ids, texts, nexts: pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "t": texts, "n": nexts})

    draw = random.Random(5)
    for rows in (
        [(draw.randrange(-50, 200), f"t{k}") for k in range(120)],
        [(i, f"t{i}") for i in range(40)] + [(None, "u"), (None, "v"), (3, "t3")],
        [(None, "a"), (None, "b")],
        [(7, "x")],
        [],
    ):
        table = frame([(*r, "clash") for r in rows], "doc_id long, text string, id string")
        for size in (3, 1000):
            got = neighbours.with_next(table, "doc_id", "text", echo, "id long, t string, n string", bucket_rows=size).collect()
            assert sorted((r.id, r.t) for r in got if r.id is not None) == sorted(r for r in rows if r[0] is not None)
            assert len(got) == len(rows)
            after = {}
            for r in got:
                after.setdefault((r.id, r.t), []).append(r.n)
            ids = sorted({r[0] for r in rows if r[0] is not None}, reverse=True) + [None] * any(r[0] is None for r in rows)
            for (key, text), found in after.items():
                own = {t for i, t in rows if i == key}
                later = {t for i, t in rows if i == ids[(ids.index(key) + 1) % len(ids)]}
                assert all(n in own | later for n in found)
                if len(own) == 1 and sum(i == key for i, _ in rows) == 1:
                    assert all(n in later for n in found)


def test_edited_texts(spark):
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()), reverse=True)
    got = {r.doc_id: r for r in op5_weighted_fingerprint(spark, SMALL).collect()}
    error = []
    for (i, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        k = len(text) // 3
        edited = text[: len(text) - k] + after[:k]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(text)
        error.append(got[i].near_edited - jaccard(text, edited))
    assert abs(np.mean(error)) < 0.02 and np.std(error) < 0.09
