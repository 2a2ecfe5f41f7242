from __future__ import annotations

import hashlib
import random
import re

import pytest
from brute import frame  # noqa: F401
from pyspark.sql import functions as F

from tillroll.llm import copies

SCHEMA = "doc_id long, text string, keep_id string, digest long, name int"


def normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def plain(rows):
    """``(doc_id, keep_id, group_size, sha256)`` of each row, sorted."""
    groups = {}
    for i, text, *_ in rows:
        groups.setdefault(normal(text), []).append(i)
    out = []
    for i, text, *_ in rows:
        ids = groups[normal(text)]
        named = [x for x in ids if x is not None]
        sha = hashlib.sha256(normal(text).encode()).hexdigest()
        out.append((i, min(named) if named else None, len(ids), sha))
    return sorted(out, key=repr)


def odd_rows():
    draw = random.Random(5)
    texts = [None, "", " ", "\t\n", " ", "a", "a ", " a", "a  b", "a\tb", "a b", "A b", "ab" * 20, "ab" * 20 + "c"]
    texts += ["".join(draw.choice("ab \né😀") for _ in range(draw.randrange(60))) for _ in range(60)]
    texts += [t + t[:1] for t in texts[-20:]] + texts[-30:] + ["x y " * 30_000, "x  y " * 30_000, "x y " * 29_999 + "z"]
    rows = [(i + 3, t, "clash", 1, 2) for i, t in enumerate(texts)]
    return rows + [rows[12], rows[12], (None, "a", "c", 1, 2), (None, "lone", "c", 1, 2), (3, "other", "c", 1, 2)]


def clashing(block):
    """A hash of three values."""
    return F.pmod(F.xxhash64(block), F.lit(3))


@pytest.mark.parametrize(("block", "key"), [(4, F.xxhash64), (4, clashing), (1024, clashing), (7, lambda b: F.lit(1))])
def test_same_as_brute_force(frame, block, key):
    rows = odd_rows() if block > 4 else [r for r in odd_rows() if len(r[1] or "") < 1000]
    got = copies.exact_copies(frame(rows, SCHEMA), block=block, key=key).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == plain(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({normal(t) for _, t, *_ in rows}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_kept_rows_keep_all_columns(frame):
    rows = odd_rows()
    left = copies.drop_exact_copies(frame(rows, SCHEMA), block=16).collect()
    assert [c for c in left[0].asDict()] == ["doc_id", "text", "keep_id", "digest", "name"]
    want = {(keep, sha) for _, keep, _, sha in plain(rows)}
    assert len(left) == len(want)
    assert {(r.doc_id, hashlib.sha256(normal(r.text).encode()).hexdigest()) for r in left} == want


def test_empty_table(frame):
    assert copies.exact_copies(frame([], SCHEMA)).count() == 0
    assert copies.drop_exact_copies(frame([], SCHEMA)).count() == 0


def test_names_are_ranks_whatever_the_ranges(frame):
    draw = random.Random(2)
    rows = list({(draw.randrange(50), draw.randrange(1000)) for _ in range(500)})
    for range_rows in (1_000_000, 60):
        got = copies.numbered(frame(rows, "a long, b long"), "at", range_rows).collect()
        assert sorted((r["at"], r.a, r.b) for r in got) == [(i, a, b) for i, (a, b) in enumerate(sorted(rows))]


def test_many_copies(frame):
    rows = [(i, "the same text " * 40 if i % 3 else f"text {i}", "", 0, 0) for i in range(900)]
    got = copies.exact_copies(frame(rows, SCHEMA), block=32).filter(F.col("doc_id") % 3 != 0).collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(1, 600)} and sum(r.kept for r in got) == 1
