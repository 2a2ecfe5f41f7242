from __future__ import annotations

import brute
import numpy as np
import pytest
import xxhash
from brute import frame  # noqa: F401
from pyspark.sql import functions as F

from tillroll.llm import simhash

SCHEMA = "doc_id long, text string, fp string, component_id int"


def plain_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split(" ")
    words = [w for part in words for w in __import__("re").split("[\x09-\x0d]+", part) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def flipped(base, draw, most):
    for b in draw.choice(64, draw.integers(0, most + 1), replace=False):
        base ^= 1 << int(b)
    return base


def signed(fp):
    return fp - (1 << 64) if fp >> 63 else fp


def points(draw, n=150, centres=8, most=4):
    own = [int(x) for x in draw.integers(0, 1 << 63, centres)]
    return sorted({flipped(own[draw.integers(centres)], draw, most) for _ in range(n)} | {0})


@pytest.mark.parametrize(("bucket_rows", "distance"), [(4096, 3), (4, 3), (4096, 2), (4, 1), (4096, 0)])
def test_links_connect_what_is_near(spark, frame, bucket_rows, distance):
    fps = points(np.random.default_rng(7))
    table = frame([(signed(x),) for x in fps], "fp long")
    got = simhash.links(table, distance, bucket_rows).collect()
    place = {signed(x): i for i, x in enumerate(fps)}
    want = brute.components(fps, lambda a, b: (a ^ b).bit_count() <= distance)
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in got:
        a, b = sorted((find(place[r.a]), find(place[r.b])))
        root[b] = a
    assert [find(i) for i in range(len(fps))] == want
    if distance == 3:
        assert len(set(want)) < len(fps)


@pytest.mark.parametrize("parts", [2, 3, 4])
def test_thresholds_are_least_and_fulfil_the_pigeonhole(parts):
    draw = np.random.default_rng(1)
    layout = [list(range(p * 64 // parts, (p + 1) * 64 // parts)) for p in range(parts)]
    counts = draw.integers(0, 300, (parts, simhash.CELLS)).astype(float)
    fp = draw.integers(0, 1 << 63, 20).astype(np.uint64)
    limit = simhash.thresholds(fp, layout, counts, 3)
    assert (limit.sum(1) == 3 - parts + 1).all() and limit.min() >= -1


def test_fingerprints_and_components(frame):
    base = "one two three four five six seven eight nine ten " * 30
    texts = [None, "", " \t", "A b", "a B", base, base.upper(), base + "eleven", "É é", "é é", "x " * 50_000, "a b c", "a b c d"]
    rows = [(i + 5, t, "clash", 1) for i, t in enumerate(texts)]
    rows += [rows[3], (None, "a b", "c", 1), (1, base, "c", 1), (1, "a b c d", "c", 1)]
    got = simhash.near_copies(frame(rows, SCHEMA)).collect()
    fps = [plain_fingerprint(t) for _, t, *_ in rows]
    root = brute.components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    first = {}
    for r, (i, *_) in zip(root, rows):
        first[r] = min(x for x in (i, first.get(r)) if x is not None)
    want = [(i, signed(f), first[r]) for (i, *_), f, r in zip(rows, fps, root)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_one_row_of_each_component_stays(frame):
    rows = [(4, "a b", "x", 1), (2, "A B", "x", 1), (2, "A B", "y", 1), (9, "c d e f", "x", 1), (None, "q", "x", 1), (2, "other", "x", 1)]
    left = simhash.drop_near_copies(frame(rows, SCHEMA))
    assert left.columns == ["doc_id", "text", "fp", "component_id"]
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=repr)
    assert got == sorted([(2, "A B"), (9, "c d e f"), (None, "q"), (2, "other")], key=repr)


def test_empty_table(frame):
    assert simhash.near_copies(frame([], SCHEMA)).count() == 0
    assert simhash.drop_near_copies(frame([], SCHEMA)).count() == 0


def test_many_copies_are_one_point(frame):
    rows = [(i, "same text here" if i % 3 else f"text number {i}", "", 0) for i in range(600)]
    got = simhash.near_copies(frame(rows, SCHEMA)).filter(F.col("doc_id") % 3 != 0)
    assert {r.component_id for r in got.collect()} == {1}
