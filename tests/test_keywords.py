"""Keyword search through the index of rarest grams, against a plain search."""

from __future__ import annotations

import random

import pytest

from tillroll.operators import keywords as kw


def plain(products, keywords, n):
    out = {}
    for name, category in set(products):
        held = sorted({(-num, k) for c, k, num in keywords if c == category and c is not None and k in (name or "")})
        out[name, category] = [k for _, k in held[:n]] if name is not None else []
    return out


def sample(letters, n_names, n_keywords, seed):
    draw = random.Random(seed)
    word = lambda most: "".join(draw.choice(letters) for _ in range(draw.randrange(1, most)))
    keywords = {(draw.choice("AAAB"), word(6)): draw.randrange(1, 50) for _ in range(n_keywords)}
    products = [(word(25), draw.choice("AAABC")) for _ in range(n_names)]
    return products, [(c, k, n) for (c, k), n in keywords.items()]


@pytest.mark.parametrize(("letters", "size", "rows"), [("ab 茶", 3, 10**6), ("abcd咖啡😀", 2, 10**6), ("aab", 4, 0), ("abc", 1, 0)])
def test_same_as_plain_search(spark, monkeypatch, letters, size, rows):
    monkeypatch.setattr(kw, "INDEX_ROWS", rows)
    products, keywords = sample(letters, 300, 120, size)
    products += [("", "A"), ("a", None), (None, "A"), products[0], products[0]]
    keywords += [keywords[0], ("A", "", 7), (None, "a", 9), ("A", "not in any name", 1)]
    got = kw.match_keywords(
        spark.createDataFrame(products, "product string, category string"),
        spark.createDataFrame([*keywords, ("A", None, 3)], "category string, name string, num long"),
        4,
        size=size,
    ).collect()
    found = {(r["product"], r["category"]): r["keywords"] for r in got}
    assert len(found) == len(got) and found == plain(products, keywords, 4)


def test_empty_tables(spark):
    names = spark.createDataFrame([("x", "A")], "product string, category string")
    none = spark.createDataFrame([], "category string, name string, num long")
    assert [r["keywords"] for r in kw.match_keywords(names, none).collect()] == [[]]
    assert kw.match_keywords(names.limit(0), none).count() == 0


def test_a_keyword_is_filed_once_under_its_rarest_gram(spark):
    rows = [("A", "abcx", 5), ("A", "abcy", 5), ("A", "qabc", 5), ("A", "ab", 90), ("B", "abcx", 1)]
    index = kw.keyword_index(spark.createDataFrame(rows, "category string, name string, num long")).collect()
    assert len(index) == len(rows)
    by = {(r["category"], r["name"]): r["gram"] for r in index}
    assert by["A", "abcx"] == "bcx" and by["A", "qabc"] == "qab" and by["A", "ab"] == "ab" and by["B", "abcx"] == "abc"


def test_names_meet_few_keywords(spark):
    """In one hot class, pairs to verify follow the hits and not names x keywords."""
    draw = random.Random(1)
    word = lambda: "".join(draw.choice("abcdefghijklmnopqrst") for _ in range(7))
    keywords = list({word() for _ in range(400)})
    products = [(f"{word()} {draw.choice(keywords)} {word()}", "A") for _ in range(400)]
    index = kw.keyword_index(spark.createDataFrame([("A", k, 1) for k in keywords], "category string, name string, num long"))
    grams = [r["gram"] for r in index.collect()]
    met = sum(g in name for name, _ in products for g in grams)
    assert len(products) <= met < 5 * len(products)
