from __future__ import annotations

import random

import brute
import pytest
from brute import frame  # noqa: F401
from pyspark.sql import functions as F

from tillroll.llm import mixing
from tillroll.llm.common import blank_words_count

SCHEMA = "doc_id long, source string, size long"


def run(frame, docs, **options):
    rows = frame(docs, SCHEMA).withColumn("digest", mixing.seeded_hex(F.col("doc_id"), seed=mixing.SEED))
    quotas = mixing.shard_quotas(rows.select("source", "digest", "size"), **options)
    mixed = mixing.mix(rows, quotas, ["doc_id", "size"], **{k: v for k, v in options.items() if k in ("block", "shard_rows")})
    return sorted(map(tuple, mixed.select("doc_id", "size", "source_size", "target", "taken").collect()), key=repr)


def some_docs(n, seed=1):
    draw = random.Random(seed)
    names = ["a", "b", "ä", "c", None]
    return [(i, names[0] if i % 3 == 0 else draw.choice(names), draw.choice([0, 1, 7, 40, 900])) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"block": 8, "shard_rows": 5}])
def test_same_as_brute_force(frame, options):
    docs = some_docs(80)
    assert run(frame, docs, **options) == sorted(brute.mix(docs, **options), key=repr)


def test_targets_are_met_and_reruns_agree(frame):
    docs = some_docs(300, 2)
    got = run(frame, docs, shard_rows=20)
    assert got == run(frame, docs, shard_rows=20)
    assert all(0 <= taken <= 2 * size for _, size, _, _, taken in got)
    by_source = {}
    for _, _, source_size, target, taken in got:
        by_source.setdefault((source_size, target), []).append(taken)
    for (_, target), taken in by_source.items():
        assert abs(sum(taken) - target) <= 32 * 20 + 32


def test_repeated_null_and_empty(frame):
    docs = [(1, "a", 10), (1, "a", 10), (None, None, 5), (2, "b", 0), (3, None, 100_000)]
    got = run(frame, docs)
    assert len(got) == 5 and all(0 <= r[4] <= 2 * r[1] for r in got)
    assert run(frame, []) == []
    assert {r[4] for r in run(frame, [(1, "a", 0), (2, None, 0)])} == {0}


def test_word_count(frame):
    texts = ["", None, "   ", "a", " a  b\tc\n", "\x0bä\x1fü é", "x " * 20_000]
    rows = frame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    got = [r[0] for r in rows.orderBy("i").select(blank_words_count(F.col("text"))).collect()]
    assert got == [brute.size(t) for t in texts]


def test_other_columns_stay(frame):
    rows = [(i, "ab"[i % 2], 10, 1, 2, 3, 4, "x") for i in range(9)]
    table = frame(rows, SCHEMA + ", quota long, blocks long, shard long, taken long, of string")
    table = table.withColumn("digest", mixing.seeded_hex(F.col("doc_id"), seed=mixing.SEED))
    mixed = mixing.mix(table, mixing.shard_quotas(table.select("source", "digest", "size")), ["doc_id"])
    assert set(mixed.columns) == {*table.columns, "source_size", "target"}
    assert {(r.quota, r.blocks, r.shard, r.of) for r in mixed.collect()} == {(1, 2, 3, "x")}
    assert {r.doc_id: r.taken for r in mixed.collect()} == {r[0]: r[4] for r in brute.mix([r[:3] for r in rows])}


def test_texts_hold_what_is_taken(frame):
    draw = random.Random(5)
    blank = [" ", "  ", "\n", "\t ", "\x0b"]
    docs = []
    for i in range(60):
        n = draw.choice([0, 1, 5, 40, 300])
        text = draw.choice(["", " "]) + "".join(f"w{i}é{j}{draw.choice(blank)}" for j in range(n))
        docs.append((i, draw.choice(["a", "a", "b", None]), None if n == 0 and i % 2 else text))
    rows = frame([(d, s, brute.size(t), t, len(t or "")) for d, s, t in docs], SCHEMA + ", text string, n int")
    rows = rows.withColumn("digest", mixing.seeded_hex(F.col("doc_id"), seed=mixing.SEED))
    for options in ({}, {"block": 8, "shard_rows": 5}):
        times = {}
        brute.mix([(d, s, brute.size(t)) for d, s, t in docs], times_of=times, **options)
        quotas = mixing.shard_quotas(rows.select("source", "digest", "size"), **options)
        got = mixing.mix(rows, quotas, ["doc_id", "size"], text="text", length="n", **options).collect()
        assert len(got) == len(docs)
        text = {d: t for d, _, t in docs}
        for r in got:
            assert r.text == brute.taken_text(text[r.doc_id], times[r.doc_id])
            assert brute.size(r.text) == r.taken and r.n == len(r.text)
            if times[r.doc_id] and set(times[r.doc_id]) == {1}:
                assert r.text == text[r.doc_id]
