from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillroll.functions import links as lk
from tillroll.functions import numbers, places, replies, rfm, text
from tillroll.operators import keywords as kw
from tillroll.operators import names as nm
from tillroll.operators import taxonomy as tx


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(F.col("x"))).first()[0]


def test_clean_keeps_digits_latin_and_cjk(spark):
    raw = "【特大杯】Latte☕ 480ml！é"
    assert one(spark, raw, text.clean) == "特大杯Latte480ml"
    assert one(spark, raw, lambda c: text.clean(c, " ")) == " 特大杯 Latte 480ml "


def test_tokens_and_bigrams(spark):
    assert one(spark, "特大ABC 12", text.name_tokens) == ["特", "大abc12"]
    assert one(spark, "Hot, 冰 tea", text.spaced_tokens) == ["hot", "冰", "tea"]
    assert one(spark, "a b c", lambda c: text.with_bigrams(F.split(c, " "))) == ["a", "b", "c", "a b", "b c"]
    assert one(spark, "a", lambda c: text.with_bigrams(F.split(c, " "))) == ["a"]
    assert one(spark, "", lambda c: text.with_bigrams(text.words(c))) == []


def test_words_set_punctuation_apart(spark):
    assert one(spark, "He's \"in\"; ok.", text.words) == ["he", "'", "s", "in", "ok", "."]


def test_dictionary_takes_the_longest_word(spark):
    cut = lambda c: text.dictionary_tokens(c, ["咖啡", "熱咖啡", "大杯"])
    assert one(spark, "特大杯熱咖啡XL2", cut) == ["特", "大杯", "熱咖啡", "XL2"]


def test_char_grams(spark):
    assert one(spark, "AbC", nm.char_grams) == ["ab", "bc"]
    assert one(spark, "a", nm.char_grams) == ["a"]


def test_prices(spark):
    assert one(spark, " $1,280\n", numbers.price) == 1280
    assert one(spark, " ", numbers.price) is None
    assert one(spark, 2.675, lambda c: numbers.half_up(c, 2), "double") == 2.68


def test_json_in_free_text(spark):
    reply = 'Sure!\n{"note": 1,\n "product_name": ["a", "b"]} bye'
    assert one(spark, reply, lambda c: replies.json_list(c, "product_name")) == ["a", "b"]
    assert one(spark, reply, lambda c: replies.json_list(c, "tags")) is None
    assert one(spark, "no braces", lambda c: replies.json_list(c, "tags")) is None
    assert one(spark, '{"tags": "x"}', lambda c: replies.json_list(c, "tags")) is None
    assert one(spark, ["a", "b", "c"], lambda c: replies.without_given(c, F.lit(1)), "array<string>") == ["b", "c"]
    assert one(spark, ["a"], lambda c: replies.without_given(c, F.lit(3)), "array<string>") == []


def test_numbered_list_and_fallback(spark):
    assert one(spark, '{"1": "a", "2": "b"}', replies.numbered_list) == ["a", "b"]
    assert one(spark, 'Here: {"1": "a", "2": "b"} and {"3": "c"}', replies.numbered_list) == ["a", "b"]
    assert one(spark, "nothing", replies.numbered_list) is None


def test_prompt_quotes_samples(spark):
    make = lambda c: replies.prompt("{n} of {c}: {{x}} {s}", n=F.lit(3), c=F.lit("tea"), s=replies.quoted_list(c))
    assert one(spark, ['a"b', "c"], make, "array<string>") == '3 of tea: {x} "ab", "c",'


def test_rfm_names():
    assert rfm.kept_letters(["f", "m"]) == ["f", "m"] and rfm.kept_letters(None) == ["r", "f", "m"]
    assert len(rfm.LEVEL_NAMES) == 8


def test_links(spark):
    host = "https://www.shop.example"
    absolute = lambda c: lk.absolute_link(c, host)
    assert one(spark, "/category/x", absolute) == host + "/category/x"
    assert one(spark, "../x", absolute) == host + "/x"
    assert one(spark, "x", absolute) == host + "/x"
    assert one(spark, "https://m.shop.example/x", absolute) == "https://m.shop.example/x"
    assert one(spark, "javascript:void(0)", absolute) == ""
    assert one(spark, "https://a//b///c", lk.single_slashes) == "https://a/b/c"
    assert one(spark, "/category/DgrpCategory.jsp", lk.link_tier) == "tier4"
    assert one(spark, "/x", lk.link_tier) is None
    assert one(spark, "img/star_5.png", lk.image_rating) == 5
    assert one(spark, ["Home", "a b", "\n ", "c"], lk.breadcrumb, "array<string>") == ["ab", "c"]
    assert one(spark, ["Home"], lk.breadcrumb, "array<string>") == []
    assert one(spark, ["/a/", "", "b"], lk.tier_path, "array<string>") == "content/a/b"


def test_deepest_tier(spark):
    df = spark.createDataFrame([("a", "b", None), ("a", "", ""), (None, None, None)], "tier1 string, tier2 string, tier3 string")
    got = [r[0] for r in df.select(lk.deepest_tier(["tier1", "tier2", "tier3"])).collect()]
    assert got == ["tier2", "tier1", None]


def test_coordinates(spark):
    page = "x ;window.APP_INITIALIZATION_STATE=[[[2500.5,121.51,25.03],[0,0]]] 1,2,3"
    got = one(spark, page, places.coordinates)
    assert (got["longitude"], got["latitude"]) == (121.51, 25.03)
    assert one(spark, "none", places.coordinates)["longitude"] is None


def test_keywords_of_the_class_only_and_ties_by_name(spark):
    products = spark.createDataFrame([("熱咖啡大杯", "咖啡"), ("熱咖啡大杯", "茶"), ("綠茶", "茶")], "product string, category string")
    words = [("咖啡", "咖啡", 9), ("咖啡", "大", 3), ("咖啡", "杯", 3), ("咖啡", "冰", 99), ("茶", "茶", 1)]
    words += [("咖啡", f"w{i}", 500 + i) for i in range(1200)]  # several lists per class
    keywords = spark.createDataFrame(words, "category string, name string, num long")
    got = {(r["product"], r["category"]): r["keywords"] for r in kw.match_keywords(products, keywords, 2).collect()}
    assert got == {("熱咖啡大杯", "咖啡"): ["咖啡", "大"], ("熱咖啡大杯", "茶"): [], ("綠茶", "茶"): ["茶"]}
    wide = kw.fan_out(spark.createDataFrame([(["a"],)], "keywords array<string>"), 2)
    assert rows(wide) == [("a", None)]


def test_wide_lists_are_padded(spark):
    top = spark.createDataFrame([("c", 0, "a", 5, 1), ("c", 1, "b", 2, 1), ("c", 1, "d", 1, 2)], "category string, cluster int, token string, num long, rank int")
    wide = kw.clusters_wide(top, ["category"], 2, 3)
    assert rows(wide) == [("c", 1, "a", 5, "b", 2), ("c", 2, None, None, "d", 1), ("c", 3, None, None, None, None)]
    merged = kw.merge_ranks(wide, "category", 2)
    assert rows(merged) == [("c", "a", 5), ("c", "b", 2), ("c", "d", 1)]
    dictionary = kw.dictionary_wide(merged, "category", ["c"], 2)
    assert rows(kw.dictionary_long(dictionary, ["c"])) == [("c", "a", 5), ("c", "b", 2)]


def test_weighted_count_skips_rows_without_units(spark):
    df = spark.createDataFrame([("c", ["a", "a"], 3), ("c", ["a"], 0)], "category string, tokens array<string>, item int")
    assert rows(kw.token_count_weighted(df, "tokens", "item", ["category"])) == [("c", "a", 6)]
    assert rows(kw.token_count(df, "tokens", ["category"])) == [("c", "a", 3)]


def test_noise_and_samples(spark):
    df = spark.createDataFrame([("外送費A", "x"), ("茶", "其他"), ("茶外送費", "x"), ("茶", "x")], "item_name string, category string")
    assert rows(tx.without_noise(df)) == [("茶", "x")]
    assert len(rows(tx.without_noise(df, prefix_only=True))) == 2
    c = spark.createDataFrame([("a", " p ", None), ("其他", "q", "r")], "category string, item1 string, item2 string")
    assert rows(tx.sample_lists(c, "category", ["item1", "item2"])) == [("a", ["p"])]


def test_similar_names_equal_all_pairs(spark):
    names = ["a1 x1 common", "a1 x1 common rare", "b1 common", "c1 common", "common", "x1 a1 common"]
    df = spark.createDataFrame([("k", n) for n in names], "category string, item_name string")
    df = df.withColumn("tokens", F.split("item_name", " "))
    got = {(r["name_a"], r["name_b"]): round(r["cosine"], 4) for r in tx.similar_names(df, "category", "item_name", "tokens", 0.7).collect()}
    assert got == {
        ("a1 x1 common", "a1 x1 common rare"): 0.866,
        ("b1 common", "common"): 0.7071,
        ("c1 common", "common"): 0.7071,
    }


@pytest.mark.parametrize("fraction", [0.2, 0.6])
def test_hash_split_is_near_its_fraction(spark, fraction):
    df = tx.hash_split(spark.range(2000), "id", fraction)
    assert abs(df.filter("is_test").count() / 2000 - fraction) < 0.05
    assert rows(df) == rows(tx.hash_split(spark.range(2000).repartition(7), "id", fraction))
