from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tillroll.functions import html as h
from tillroll.operators import pages as pg
from tillroll.plans.crawl import store_products
from tillroll.registry import crawl, views
from tillroll.streaming import queue as qu



def day():
    return F.lit(dt.date(2023, 8, 25))


HOST = "https://www.shop.example"


def page(spark, html, url="u1"):
    return spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")


def test_unclosed_and_void_elements(spark):
    html = "<ul><li>a<li>b<br>c</ul><p>one<p>two &amp; <b>three</p><script>var t='</p>';</script><img src=x>"
    paths = {"li": ("ul", "li"), "p": ("p",), "img": ("img",), "b": ("p", "b")}
    got = pg.parsed(page(spark, html), paths).select("el.*").first()
    assert [e["texts"] for e in got["li"]] == [["a"], ["b", "c"]]
    assert [e["texts"] for e in got["p"]] == [["one"], ["two & ", "three"]]
    assert got["img"][0]["attrs"] == {"src": "x"} and len(got["b"]) == 1


def test_nested_matches_count_texts_once(spark):
    html = '<div class="d"><ul><li>x<ul><li>y</li></ul></li></ul></div>'
    paths = {"li": (".d", "li"), "deep": (".d", "ul", "li", "ul", "li")}
    df = pg.parsed(page(spark, html), paths)
    row = df.select(h.all_texts(F.col("el.li")).alias("t"), h.all_texts(F.col("el.deep")).alias("u")).first()
    assert row["t"] == ["x", "y"] and row["u"] == ["y"]


def test_null_and_empty_pages(spark):
    df = spark.createDataFrame([(1, "u", None), (2, "v", "")], "page_id long, url string, html string")
    assert pg.links_in(df, "nav").count() == 0
    records = pg.with_tiers(pg.product_records_a(df, day())).collect()
    assert len(records) == 2 and records[0]["item_brand"] is None and records[0]["tier1"] is None


RECORD_A = """
<div id="bt_2_layout_NAV"><ul><li class="first"><a>Home</a></li><li><a>家電</a></li><li> 飲水 </li></ul></div>
<a id="webBrand">B</a><p id="osmGoodsName"><a>B</a> tea </p>
<ul class="prdPrice"><li>市售價<b class="seoPrice">1,290</b></li><li>折扣後價格<b class="seoPrice">9</b></li>
<li>促銷 價<b class="seoPrice">5</b></li></ul>
<table id="attributesTable"><tr><th>香味</th><td>果 香</td></tr><tr><th>香味</th><td>花</td></tr></table>
<li class="goodsCommendLi"><span goodscount="1,234"></span></li><i class="indicatorAvgVal">4.8</i>
<div class="indicator"><i class="indicatorTitle">商品符合</i><i class="indicatorNumber">4.7</i></div>
<div class="indicator"><i class="indicatorTitle">出貨速度</i><i class="indicatorNumber">4.9</i></div>
<div class="reviewCard"><i class="RatingStarGroup" score="5"></i><i class="SpecValue">L</i><i class="Info">d</i></div>
"""


def test_record_a(spark):
    r = pg.with_tiers(pg.product_records_a(page(spark, RECORD_A), day()), least=3).first()
    assert (r["item_brand"], r["item_name"]) == ("B", "B tea")
    assert (r["market_price"], r["promotional_price"], r["discounted_price"]) == (1290, None, 9)
    assert r["item_spec"] == {"香味": "花"} and r["data_date"] == "20230825"
    # Every indicator is read inside its own block.
    assert r["goods_commend_indicator_accurate"] == 4.7 and r["goods_commend_indicator_shipping"] == 4.9
    assert r["goods_commend_indicator_quality"] is None and r["goods_commend_count"] == 1234
    assert r["goods_commend_review_card_list"][0]["review_card_comment"] is None
    assert r["tiers"] == ["家電", "飲水"] and (r["tier2"], r["tier3"]) == ("飲水", None)


def test_store_products_keeps_one_page_per_link(spark, tmp_path):
    rows = [(i, f"https://s/{i % 2}", RECORD_A) for i in range(4)] + [(9, "x", "<p>no tiers</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    kept = store_products(df, str(tmp_path), day())
    assert sorted(r["page_id"] for r in kept.collect()) == [0, 1]
    back = spark.read.json(f"{tmp_path}/content")
    assert back.count() == 2 and {r["tier1"] for r in back.collect()} == {"家電"}


MENU = """
<div id="bt_2_layout_NAV"><ul><li><a>Home</a></li><li>T1</li></ul></div>
<div id="bt_category_Content"><ul>
<li><a href="/DgrpCategory?0">early</a></li><li><a href="/MgrpCategory?1">three</a></li>
<li><a href="/DgrpCategory?2">four</a></li><li><a href="https://ecm.shop.example/DgrpCategory?3">five</a></li>
<li><a href="/other">other</a></li></ul></div>"""


def test_category_rows_inherit_headings(spark):
    df = pg.category_rows(page(spark, MENU), HOST, old_host="ecm.shop.example")
    got = df.orderBy("pos").collect()
    assert [(r["tier3_category_name"], r["tier4_category_name"], r["category_type"]) for r in got] == [
        ("", "early", "tier4"), ("three", "early", "tier3"), ("three", "four", "tier4"),
        ("three", "five", "tier4"), ("three", "five", None),
    ]
    assert got[3]["category_link"] == HOST + "/DgrpCategory?3"
    assert pg.category_rows(page(spark, "<div id='bt_category_Content'><ul><li><a href='/x'>y</a></ul></div>"), HOST).count() == 0


def test_page_count(spark):
    paths = {"bar": (".pageArea", "span")}
    df = pg.parsed(page(spark, '<div class="pageArea"><span>1</span><span>/3</span></div>'), paths)
    assert pg.fan_out_pages(df, pg.page_count(F.col("el.bar"))).count() == 3
    none = pg.parsed(page(spark, "<p>x</p>"), paths)
    assert pg.fan_out_pages(none, pg.page_count(F.col("el.bar"))).count() == 1


def test_retry_routing(spark):
    data = [("a", None, "ok"), ("b", 3, "timeout"), ("c", 4, "ok"), ("d", 1, "error"), ("e", None, "timeout")]
    df = spark.createDataFrame(data, "link string, times int, outcome string")
    got = {r["link"]: (r["status_code"], r["times_now"], r["retry"]) for r in qu.route(df).collect()}
    assert got == {
        "a": (200, 1, False), "b": (408, 4, True), "c": (429, 4, False), "d": (500, None, False), "e": (408, 1, True),
    }


def test_drain_continues_where_it_stopped(spark, tmp_path):
    source, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    schema = "hash_id string, ts timestamp"
    day = dt.datetime(2024, 1, 1)

    def push(keys, minute):
        rows = [(k, day + dt.timedelta(minutes=minute)) for k in keys]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(source)
        qu.drain(qu.dedup(qu.messages(spark, source, schema)), out, mark)

    push(["a", "a", "b"], 0)
    push(["b", "c"], 2)
    push(["d"], 60)
    push(["a", "d"], 62)  # the first "a" is older than the interval
    push(["e", "e", "d"], -600)  # far behind all others: a new key and a repeat after the interval
    push(["a"], 59)  # late, but less than the interval before one that was let through
    got = sorted(r["hash_id"] for r in spark.read.parquet(out).collect())
    assert got == ["a", "a", "b", "c", "d", "d", "e"]


def test_stream_routing_and_fan_out(spark, tmp_path):
    source, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    schema = "link string, times int, outcome string, links array<string>"
    spark.createDataFrame([("a", 4, "ok", ["x", "y"]), ("b", None, "ok", [])], schema).write.json(source)
    routed = qu.route(qu.messages(spark, source, schema))
    qu.drain(qu.fan_out(routed, "links", "child"), out, mark)
    assert sorted((r["child"], r["status_code"]) for r in spark.read.parquet(out).collect()) == [("x", 429), ("y", 429)]


def test_product_pages_are_dealt_out_by_their_number(spark, tmp_path, monkeypatch):
    rows = [(i, f"name {i}", "b", "t", i, 9.0) for i in range(90)]
    part = spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    part.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(views, "is_local", lambda _: False)
    monkeypatch.setattr(views, "DEALT_ROWS", 10, raising=False)
    dealt = crawl.pages_a(spark, str(tmp_path))
    assert dealt.rdd.getNumPartitions() == 9
    assert sorted(r["page_id"] for r in dealt.collect()) == list(range(90))


def test_review_rows_parse_a_page_once(spark):
    records = pg.product_records_a(page(spark, '<div class="reviewCard"></div>'), day())
    plan = pg.review_rows(records)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
