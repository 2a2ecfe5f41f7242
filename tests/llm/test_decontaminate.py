from __future__ import annotations

import random

import brute
import pytest
from brute import frame  # noqa: F401

from tillroll.llm import decontaminate

SCHEMA = "doc_id long, text string, w string, n_words int, spans string"
ITEMS = [
    (1, " ".join(f"w{i}" for i in range(20))),
    (2, "Short one, ÄÖ!"),
    (3, None),
    (4, "..."),
    (None, "null id words here"),
    (2, "short ONE ÄÖ"),
    (10, "the the the the the the the the the the the the the the the"),
]


def docs():
    draw = random.Random(3)
    passage = " ".join(f"w{i}" for i in range(13))
    texts = [
        None,
        "",
        "!!!",
        passage,
        passage.upper() + " tail",
        "x " * 300 + passage,
        "y " * 30_000 + passage + " w13 w14",
        "a short one äö",
        "a short one ÄÖ",
        "say null id words here twice null id words here",
        "the " * 40,
        " ".join(f"w{i}" for i in range(12)),
    ]
    texts += [" ".join(draw.choice(["the", "w1", "w2", "short", "one", "ÄÖ"]) for _ in range(60)) for _ in range(30)]
    rows = [(i, t, "clash", 7, "clash") for i, t in enumerate(texts)]
    return rows + [rows[3], (3, "other text, same id", "c", 1, "c"), (None, passage, "c", 1, "c")]


@pytest.mark.parametrize("options", [{}, {"broadcast_windows": 3}])
def test_same_as_brute_force(frame, monkeypatch, options):
    plain = decontaminate.hits
    monkeypatch.setattr(decontaminate, "hits", lambda *a: plain(*a, **options))
    got = decontaminate.contamination(frame(docs(), SCHEMA), frame(ITEMS, "item_id long, text string")).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in got), key=repr)
    want = []
    for doc_id, text, *_ in docs():
        n_words, n_hit, items = brute.contamination(text, ITEMS)
        want.append((doc_id, n_words, n_hit, [i for i in items if i != "None"], n_hit > 0 and 20 * n_hit >= n_words))
    assert got == sorted(want, key=repr)


def test_documents_go_and_clean_ones_stay(frame):
    table, items = frame(docs(), SCHEMA), frame(ITEMS, "item_id long, text string")
    left = decontaminate.remove_documents(table, items)
    assert left.columns == table.columns
    bad = {(i, t) for i, t, *_ in docs() for n, h, _ in [brute.contamination(t, ITEMS)] if h and 20 * h >= n}
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(
        ((i, t) for i, t, *_ in docs() if (i, t) not in bad), key=repr
    )


def test_spans_go(frame):
    passage = " ".join(f"w{i}" for i in range(13))
    rows = [(1, f"Keep this. {passage}! And that.\n"), (2, "clean"), (3, None), (4, passage)]
    left = decontaminate.remove_spans(frame(rows, "doc_id long, text string"), frame(ITEMS[:1], "item_id long, text string"))
    assert {r.doc_id: r.text for r in left.collect()} == {1: "Keep this! And that.\n", 2: "clean", 3: None, 4: ""}


def test_empty_tables(frame):
    no_items = frame([], "item_id long, text string")
    assert {r.n_hit for r in decontaminate.contamination(frame(docs(), SCHEMA), no_items).collect()} == {0}
    assert decontaminate.remove_documents(frame([], SCHEMA), frame(ITEMS, "item_id long, text string")).count() == 0
