from __future__ import annotations

import random
import re
import zlib

import pytest
from brute import LOWER, frame  # noqa: F401

from tillroll.llm import registry, spelling


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def plain(words, ratio=5):
    """``(word, form, root, n, n_near, form_n)`` of a dict of words."""
    out, form = [], {}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def vocabulary(draw, size=300, letters="abcé", most=9):
    words = {}
    while len(words) < size:
        words["".join(draw.choice(letters) for _ in range(draw.randrange(1, most)))] = int(5 ** draw.uniform(0, 6))
    return words


@pytest.mark.parametrize(("groups", "residents", "visitors"), [(5, 2048, 1 << 16), (1, 2048, 1 << 16), (3, 2, 3), (1, 7, 5)])
def test_same_as_brute_force(frame, groups, residents, visitors):
    words = vocabulary(random.Random(groups), 250 if residents < 9 else 400)
    words |= {"x" * 3000: 9, "x" * 3001: 60, "x" * 2999 + "y": 3, "": 4, "ab😀": 7, "a😀": 40}
    rows = [(w, n, "clash", 1) for w, n in words.items()]
    got = spelling.variants(frame(rows, "word string, n long, form string, best int"), 5, groups, residents, visitors)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect())) == plain(words)


def test_ties_and_chains(frame):
    words = {"abcdef": 5, "abcdeg": 25, "abcdxg": 125, "abyyxg": 900, "abydxg": 625, "abcdeh": 25, "abcde": 25, "zzzzzz": 10**9}
    got = {r.word: r for r in spelling.variants(frame(list(words.items()), "word string, n int")).collect()}
    assert got["abcdef"].form == "abcde" and got["abcdef"].root == "abcde"
    assert (got["abcdeg"].form, got["abcdeg"].root) == ("abcdxg", "abydxg") and got["abydxg"].form is None
    assert sorted(map(tuple, got.values())) == plain(words)


def test_odd_tables(frame):
    schema = "word string, n long"
    assert spelling.variants(frame([], schema)).count() == 0
    rows = [(None, 3), ("word", None), ("ward", 2), ("ward", 3), ("wards", 30)]
    got = sorted(map(tuple, spelling.variants(frame(rows, schema)).collect()))
    assert got == [("ward", "wards", "wards", 5, 1, 30), ("wards", None, "wards", 30, 1, None)]
    with pytest.raises(ValueError):
        spelling.variants(frame([], schema), ratio=1)


def damaged_words(docs):
    """Words and numbers by the contract of the query, in plain Python."""
    counts = {}
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def test_query(spark, frame, tmp_path):
    draw = random.Random(3)
    base = ["".join(draw.choice("aeinrstÉé×") for _ in range(draw.randrange(4, 9))) for _ in range(40)]
    base += [w[:i] + draw.choice("aeinrst") + w[i + 1 :] for w in base for i in (1, 3)] + ["Aeinrst", "LONGWORD" * 9]
    docs = [(i, " ".join(draw.choices(base, range(len(base), 0, -1), k=80)) + "1x2") for i in range(60)]
    docs += [(99, None), (98, ""), (None, "strange " * 6), docs[0], (97, "a" * 50_000)]
    frame([(*d, "clash") for d in docs], "doc_id long, text string, word string").write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.QUERIES["op12_spelling_groups"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == plain(damaged_words(docs)) and any(r.form for r in got)
