"""Segmentation against a search of all ways to cut a text."""

from __future__ import annotations

import math
import random
import re
from functools import cache

import pytest

from tillroll.operators import segmenter as sg


def clean(text):
    return re.sub("[^0-9a-zA-Z一-鿿]+", " ", text)


def plain(text, dictionary):
    """Tokens of the best path: largest sum of weights, then the longest words from the left."""
    total = sum(dictionary.values())
    weight = {w: math.floor(math.log(n / total) * 1000) for w, n in dictionary.items() if w}
    unknown = min(weight.values(), default=0) - 1000
    text = clean(text)

    @cache
    def best(at):
        if at == len(text):
            return 0, ()
        run = re.match("[0-9a-zA-Z]+", text[at:])
        choices = [(n, weight[text[at : at + n]]) for n in range(1, len(text) - at + 1) if text[at : at + n] in weight]
        choices.append((1, 0) if text[at] == " " else (run.end() if run else 1, unknown))
        ways = [(w + best(at + n)[0], (n, *best(at + n)[1])) for n, w in choices]
        return max(ways)

    out, at = [], 0
    for n in best(0)[1]:
        if text[at : at + n] != " ":
            out.append(text[at : at + n])
        at += n
    return out


def leftmost_longest(text, dictionary):
    words = sorted((w for w in dictionary if w), key=lambda w: (-len(w), w))
    return re.findall("|".join([*map(re.escape, words), "[0-9a-zA-Z]+", "[一-鿿]"]), clean(text))


def sample(seed):
    draw = random.Random(seed)
    word = lambda most: "".join(draw.choice("ab熱咖啡1") for _ in range(draw.randrange(1, most)))
    return {word(5): draw.randrange(1, 50) for _ in range(40)}, [word(14) + draw.choice(["", "-", " "]) + word(9) for _ in range(80)]


@pytest.mark.parametrize("trie_bytes", [1 << 20, 0])
@pytest.mark.parametrize("longest", [False, True])
def test_same_as_all_ways(spark, trie_bytes, longest):
    dictionary, texts = sample(1)
    dictionary |= {"a b": 90, "咖啡": 90}
    rows = [(i, t, "clash") for i, t in enumerate([*texts, texts[0], "", "--", "a-b", "咖 啡", "長" * 500])]
    df = spark.createDataFrame([*rows, (999, None, "x")], "id long, name string, word string")
    words = spark.createDataFrame([*dictionary.items(), ("", 5), (None, 4), ("b", None)], "word string, n long")
    got = {r.id: r.tokens for r in sg.segment(df, "name", words, longest=longest, trie_bytes=trie_bytes).collect()}
    want = leftmost_longest if longest else plain
    assert got == {i: want(t, dictionary) for i, t, _ in rows} | {999: None}


@pytest.mark.parametrize("trie_bytes", [1 << 20, -1])
def test_without_words_runs_and_characters_are_left(spark, trie_bytes):
    df = spark.createDataFrame([("AB12熱茶 x",)], "name string")
    none = spark.createDataFrame([], "word string, n long")
    assert sg.segment(df, "name", none, trie_bytes=trie_bytes).first().tokens == ["AB12", "熱", "茶", "x"]
    assert sg.segment(df.limit(0), "name", none).count() == 0


def test_a_dictionary_beyond_twenty_thousand_words(spark):
    words = spark.range(30_000).selectExpr("concat('詞', id) as word", "id + 1 as n")
    df = spark.createDataFrame([("詞29999詞7",)], "name string")
    assert sg.segment(df, "name", words).first().tokens == ["詞29999", "詞7"]


def test_frequent_words_win_over_long_ones(spark):
    words = spark.createDataFrame([("研究", 50), ("研究生", 2), ("生命", 40), ("命", 3)], "word string, n long")
    df = spark.createDataFrame([("研究生命",)], "name string")
    assert sg.segment(df, "name", words).first().tokens == ["研究", "生命"]
    assert sg.segment(df, "name", words, longest=True).first().tokens == ["研究生", "命"]
