"""Plans that depend on sizes give the same rows on either side of the bound."""

from __future__ import annotations

import brute
import numpy as np
import pytest
from brute import frame  # noqa: F401

from tillroll.llm import common, decontaminate, personal, simhash


def both_sides(monkeypatch, run):
    small = sorted(map(tuple, run().collect()), key=repr)
    monkeypatch.setattr(common, "KEY_ROWS", 0)
    assert sorted(map(tuple, run().collect()), key=repr) == small
    return small


def docs(frame):
    passage = " ".join(f"w{i}" for i in range(13))
    texts = [passage, "a clean text", "mail me@here.org", "A clean text", None, "card 4111111111111111 and me@here.org", ""]
    return frame(list(enumerate(texts)) + [(None, "a clean text"), (3, "A clean text")], "doc_id long, text string")


def test_decontamination(frame, monkeypatch):
    items = frame([(1, " ".join(f"w{i}" for i in range(13)))], "item_id long, text string")
    assert len(both_sides(monkeypatch, lambda: decontaminate.remove_documents(docs(frame), items))) == 8


def test_spans(frame, monkeypatch):
    items = frame([(1, " ".join(f"w{i}" for i in range(13)))], "item_id long, text string")
    assert (0, "") in both_sides(monkeypatch, lambda: decontaminate.remove_spans(docs(frame), items))


def test_near_copies(frame, monkeypatch):
    left = both_sides(monkeypatch, lambda: simhash.drop_near_copies(docs(frame)))
    assert (1, "a clean text") in left and (3, "A clean text") not in left


def test_personal_data(frame, monkeypatch):
    assert (5, "card <CARD> and <EMAIL>") in both_sides(monkeypatch, lambda: personal.redact(docs(frame)))


@pytest.mark.parametrize("cost", [64, 5e-4, 1e-6])
def test_parts_of_fingerprints(frame, monkeypatch, cost):
    """Fewer, wider parts for more points: 4, 3 and 2 parts here."""
    monkeypatch.setattr(simhash, "PROBE_COST", cost)
    draw = np.random.default_rng(2)
    centres = [int(x) for x in draw.integers(0, 1 << 63, 30)]
    fps = set(centres)
    for c in centres:
        for _ in range(5):
            x = c
            for b in draw.choice(64, draw.integers(1, 5), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    signed = {x - (1 << 64) if x >> 63 else x: i for i, x in enumerate(fps)}
    want = brute.components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in simhash.links(frame([(x,) for x in signed], "fp long")).collect():
        a, b = sorted((find(signed[r.a]), find(signed[r.b])))
        root[b] = a
    assert [find(i) for i in range(len(fps))] == want
