from __future__ import annotations

import brute
import pytest
from brute import SMALL, frame  # noqa: F401

from tillroll.llm import licenses

SCHEMA = "doc_id long, text string, labels string, score string"


def base(text):
    own = brute.words(text)
    hits = [
        (k, label)
        for phrase, label in licenses.PHRASES.items()
        for k in range(len(own))
        if own[k : k + len(phrase.split())] == phrase.split()
    ]
    at = [k for k, _ in hits]
    return len(own), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def test_base_is_exact(spark, frame):
    texts = [
        None,
        "",
        "...",
        "Under the MIT-License; under the mit license",
        "cc-by-nc cc by nc",
        "xunder the mit license",
        "Apache License, Version 2.0",
        "apache license version 20",
        "é under\x00the mit license ü",
        "under the mit license " * 9000,
        "cc by nc by nc",
    ]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(3, texts[3], "x", "y"), (None, texts[4], "x", "y")]
    for table in (frame(rows, SCHEMA), spark.read.parquet(f"{SMALL}/documents.parquet")):
        text = [(r.doc_id, r.text) for r in table.collect()]
        got = licenses.scan(table).collect()
        assert sorted(((r.doc_id, *r[1:6]) for r in got), key=repr) == sorted(((i, *base(t)) for i, t in text), key=repr)
        assert all({*filter(None, r.base_labels.split(","))} <= {*r.labels.split(",")} for r in got)


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
        ("licenced under teh gnu general public license version 3", "gpl-3"),
        ("Released undr the MTI License", "mit"),
        ("Permission is hereby grantd, free of charge, to any persn obtaining a copy", "mit"),
        ("All rights reservd.", "all-rights-reserved"),
        ("Licensed under CC BY 4.0", "cc-by"),
        ("redistribution and use is source and binary form", "bsd"),
        ("Released under the bus", ""),
        ("the general public likes it", ""),
    ],
)
def test_notices_with_edits(text, label):
    known = [licenses.Notice(w, x) for w, x in licenses.NOTICES.items()]
    found = licenses.scan_text(f"Some words. {text} And more words.", licenses.PHRASES, known)
    assert found["labels"] == label
    assert (found["score"] > 0.8) == bool(label)
    if label:
        (span,) = found["spans"]
        own = brute.words(f"Some words. {text} And more words.")
        assert 2 <= span["first"] < span["last"] <= len(own) - 3


def test_edits_are_bounded():
    for words, label in licenses.NOTICES.items():
        notice = licenses.Notice(words, label)
        broken = list(words)
        step = len(words) // (notice.edits + 2)
        for k in range(notice.edits + 1):
            broken[1 + k * step] = "#"
        line = licenses.word_line("a " + "".join(broken).replace("#", "ß") + " b")
        assert not licenses.find_notices(line, [notice])
        broken[1] = words[1]
        line = licenses.word_line("a " + "".join(broken).replace("#", "ß") + " b")
        (hit,) = licenses.find_notices(line, [notice])
        assert hit[3] == notice.edits


def test_many_notices_in_a_long_text():
    known = [licenses.Notice(w, x) for w, x in licenses.NOTICES.items()]
    line = licenses.word_line("all rights reserved. " * 3000 + "x " * 50_000)
    assert len(licenses.find_notices(line, known)) == 3000


def test_empty_table(frame):
    assert licenses.scan(frame([], SCHEMA)).count() == 0
