"""Page extraction and queue queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.functions import html as h
from tillroll.functions import links as lk
from tillroll.operators import pages as pg
from tillroll.registry import views as v
from tillroll.registry.base import query
from tillroll.session import run_folder
from tillroll.streaming import queue as qu

HOST = "https://shop.example.com"
MARKS = {"tier4": ".html", "tier3": "page=", "tier2": "#top"}


def pages(spark, sf):
    return v.table(spark, sf, "pages")


# Links of the menu by pattern: the menu is the only place with plain anchors.
MENU = """menu AS (
  SELECT page_id, url, i AS nth, m[i] AS link FROM (
    SELECT page_id, url, regexp_extract_all(regexp_extract(html, '(?s)<nav>.*?</nav>', 0), '<a href="([^"]*)"', 1) AS m
    FROM pages) p, (SELECT unnest(range(1, 200)) AS i) r WHERE i <= len(m))"""


@query(
    "page_links",
    f"""WITH {MENU} SELECT page_id, url, link, CAST(nth AS INTEGER) AS nth,
  sha256('{HOST}' || link) AS hash_id FROM menu""",
)
def q_page_links(spark, sf):
    found = pg.links_in(pages(spark, sf), "nav")
    nth = F.row_number().over(Window.partitionBy("page_id").orderBy("pos"))
    key = lk.link_key(lk.absolute_link(F.col("link"), HOST))
    return found.withColumn("nth", nth).select("page_id", "url", "link", "nth", key.alias("hash_id"))


@query("link_key", "SELECT page_id, sha256(url) AS hash_id FROM pages")
def q_link_key(spark, sf):
    return pages(spark, sf).select("page_id", lk.link_key(F.col("url")).alias("hash_id"))


@query(
    "link_tier",
    """SELECT page_id, CASE WHEN contains(url, '.html') THEN 'tier4'
  WHEN contains(url, 'page=') THEN 'tier3' WHEN contains(url, '#top') THEN 'tier2' END AS tier
FROM pages""",
)
def q_link_tier(spark, sf):
    return pages(spark, sf).select("page_id", lk.link_tier(F.col("url"), MARKS).alias("tier"))


@query(
    "link_filter",
    "SELECT page_id, url FROM pages WHERE contains(url, 'https') AND contains(url, 'example')",
)
def q_link_filter(spark, sf):
    keep = lk.is_category_link(F.col("url"), ("https", "example"))
    return pages(spark, sf).filter(keep).select("page_id", "url")


@query(
    "link_clean",
    r"""SELECT page_id, regexp_replace(replace(url, 'http://m.', 'http://www.') || '//x', '([^:/])/{2,}', '\1/', 'g') AS link
FROM pages""",
)
def q_link_clean(spark, sf):
    renamed = lk.rename_host(F.col("url"), "http://m.", "http://www.")
    return pages(spark, sf).select(
        "page_id", lk.single_slashes(F.concat(renamed, F.lit("//x"))).alias("link")
    )


# Every tenth page has four more entries in its menu.
DEEPER = '<li><a href="/x6">x 6</a></li><li><a href="/x7">x7</a></li><li><a href="/x8">x8</a></li><li><a href="/x9">x9</a></li>'
DEPTH = 9


@query(
    "breadcrumb",
    f"""SELECT page_id, {", ".join(f"list_extract(t, {i}) AS tier{i}" for i in range(1, DEPTH + 1))},
  'content/' || array_to_string(t, '/') AS path FROM (
  SELECT page_id, list_transform(m, lambda x: replace(x, ' ', ''))[2:] AS t FROM (
    SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<nav>.*?</nav>', 0), '<a href="[^"]*">([^<]*)</a>', 1)
      || CASE page_id % 10 WHEN 0 THEN ['x 6', 'x7', 'x8', 'x9'] ELSE [] END AS m
    FROM pages) p) q""",
)
def q_breadcrumb(spark, sf):
    longer = F.replace("html", F.lit("</ul></nav>"), F.lit(DEEPER + "</ul></nav>"))
    deep = pages(spark, sf).withColumn("html", F.when(F.col("page_id") % 10 == 0, longer).otherwise(F.col("html")))
    tiers = pg.with_tiers(pg.page_tiers(deep, "nav", "ul", "li"), least=DEPTH)
    return tiers.withColumn("path", lk.tier_path(F.col("tiers"))).drop("url", "tiers")


@query(
    "carry_heading",
    f"""WITH {MENU},
typed AS (
  SELECT *, CASE WHEN contains(link, 'e') THEN 'tier4' WHEN contains(link, 't') THEN 'tier3' END AS category_type
  FROM menu)
SELECT page_id, CAST(nth AS INTEGER) AS nth, link, category_type,
  coalesce(substring(last_value(CASE WHEN category_type = 'tier3' THEN link END IGNORE NULLS)
    OVER (PARTITION BY page_id ORDER BY nth), 2), '') AS tier3_category_name
FROM typed""",
)
def q_carry_heading(spark, sf):
    items = pg.links_in(pages(spark, sf), "nav").withColumn("text", F.substring("link", 2, 1000))
    carried = pg.carry_headings(items, {"tier4": "e", "tier3": "t"})
    nth = F.row_number().over(Window.partitionBy("page_id").orderBy("pos"))
    return carried.withColumn("nth", nth).select(
        "page_id", "nth", "link", "category_type", "tier3_category_name"
    )


@query(
    "page_fanout",
    r"""SELECT page_id, CAST(unnest(range(1, n + 1)) AS INTEGER) AS page_no FROM (
  SELECT page_id, coalesce(TRY_CAST(nullif(regexp_extract(url, 'page=(\d+)', 1), '') AS INTEGER), 1) AS n
  FROM pages) p""",
)
def q_page_fanout(spark, sf):
    rows = pages(spark, sf).select("page_id", "url")
    return pg.fan_out_pages(rows, lk.page_number(F.col("url"))).select("page_id", "page_no")


@query(
    "category_rows",
    f"""WITH {MENU},
crumb AS (SELECT page_id, max(CASE WHEN nth = 2 THEN replace(link, ' ', '') END) AS t1 FROM menu GROUP BY page_id)
SELECT m.page_id, substring(t1, 2) AS tier1_category_name, '{HOST}' || link AS category_link,
  CASE WHEN contains(link, 'e') THEN 'tier4' WHEN contains(link, 't') THEN 'tier3' END AS category_type,
  sha256('{HOST}' || link) AS hash_id
FROM menu m JOIN crumb c ON m.page_id = c.page_id WHERE t1 IS NOT NULL""",
)
def q_category_rows(spark, sf):
    rows = pg.category_rows(
        pages(spark, sf), HOST, ("nav", "ul", "li"), ("nav", "ul", "li"), {"tier4": "e", "tier3": "t"}
    )
    return rows.select("page_id", "tier1_category_name", "category_link", "category_type", "hash_id")


MENU_SQL = f"""SELECT r_name AS tier1, 'all' AS tier2, 'nations' AS tier3, n_name AS tier4, s_name AS tier5,
  '{HOST}/' || coalesce(s_name, n_name) AS category_link,
  CASE WHEN s_name IS NULL THEN 'tier4' ELSE 'tier5' END AS category_type,
  sha256('{HOST}/' || coalesce(s_name, n_name)) AS hash_id
FROM region JOIN nation ON r_regionkey = n_regionkey LEFT JOIN supplier ON n_nationkey = s_nationkey"""


@query(
    "menu_leaves",
    MENU_SQL,
)
def q_menu_leaves(spark, sf):
    """The nations of a region with their suppliers, one menu per nation and supplier."""
    supplier = v.table(spark, sf, "supplier")
    nation = v.table(spark, sf, "nation")
    region = v.table(spark, sf, "region")
    below = F.when(F.col("s_name").isNull(), F.array().cast("array<struct<text string, link string>>")).otherwise(
        F.array(F.struct(F.col("s_name").alias("text"), F.concat(F.lit("/"), "s_name").alias("link")))
    )
    entry = F.struct(F.col("n_name").alias("text"), F.concat(F.lit("/"), "n_name").alias("link"), below.alias("below"))
    menus = (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(supplier, F.col("n_nationkey") == F.col("s_nationkey"), "left")
        .select(
            F.col("r_name").alias("tier1"), F.lit("all").alias("tier2"), F.lit("nations").alias("tier3"),
            F.array(entry).alias("entries"),
        )
    )
    return pg.menu_leaves(menus, HOST)


@query("menu_tree", MENU_SQL)
def q_menu_tree(spark, sf):
    """The same menus as pages with nested lists."""
    supplier, nation = v.table(spark, sf, "supplier"), v.table(spark, sf, "nation")
    region = v.table(spark, sf, "region")
    below = F.concat(F.lit('<ul><li><a href="/'), "s_name", F.lit('"> '), "s_name", F.lit("</a></li></ul>"))
    body = F.concat(
        F.lit('<html><body><div id="menu"><b class="t1"> '), "r_name", F.lit('</b><i class="t2">all</i><i class="t3">nations</i>'),
        F.lit('<ul class="t4"><li><a href="/'), "n_name", F.lit('">'), "n_name", F.lit("</a>"), F.coalesce(below, F.lit("")),
        F.lit('</li></ul></div><ul><li><a href="/x">elsewhere</a></li></ul></body></html>'),
    )
    rows = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).join(
        supplier, F.col("n_nationkey") == F.col("s_nationkey"), "left"
    )
    menus = rows.select(F.xxhash64("n_name", "s_name").alias("page_id"), body.alias("html"))
    heads = [("#menu", f".t{i}") for i in (1, 2, 3)]
    return pg.menu_leaves(pg.menu_entries(menus, heads, ("#menu", "ul.t4", "li")), HOST)


# Every page three times, as a queue would repeat it.
COPIES = """copies AS (
  SELECT page_id * 3 + c AS seq, split_part(split_part(url, '#', 1), '?', 1) AS link, page_id % 5 AS times
  FROM pages, (SELECT unnest([0, 1, 2]) AS c) n)"""


def copies(spark, sf):
    link = F.split_part(F.split_part("url", F.lit("#"), F.lit(1)), F.lit("?"), F.lit(1))
    rows = pages(spark, sf).select("page_id", "url", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("c"))
    return rows.select(
        (F.col("page_id") * 3 + F.col("c")).alias("seq"),
        link.alias("link"),
        (F.col("page_id") % 5).cast("int").alias("times"),
    )


@query(
    "link_dedup",
    f"""WITH {COPIES} SELECT sha256(link) AS hash_id, link, min(seq) AS seq FROM copies GROUP BY link""",
)
def q_link_dedup(spark, sf):
    keyed = copies(spark, sf).select(lk.link_key(F.col("link")).alias("hash_id"), "link", "seq")
    return pg.first_by_key(keyed, "hash_id", "seq")


OUTCOME = "CASE seq % 4 WHEN 0 THEN 'error' WHEN 1 THEN 'timeout' ELSE 'ok' END"


@query(
    "retry_route",
    f"""WITH {COPIES},
tried AS (SELECT seq, link, times, {OUTCOME} AS outcome FROM copies)
SELECT seq, link, status_code, retry,
  CASE WHEN status_code = 429 THEN times WHEN status_code <> 500 THEN times + 1 END AS times_now
FROM (SELECT *, status_code = 408 AS retry FROM (
  SELECT *, CASE WHEN times >= 4 THEN 429 WHEN outcome = 'error' THEN 500
                 WHEN outcome = 'timeout' THEN 408 ELSE 200 END AS status_code FROM tried) a) b""",
)
def q_retry_route(spark, sf):
    turn = F.col("seq") % 4
    outcome = F.when(turn == 0, "error").when(turn == 1, "timeout").otherwise("ok")
    routed = qu.route(copies(spark, sf).withColumn("outcome", outcome))
    return routed.select("seq", "link", "status_code", "retry", F.col("times_now").cast("long").alias("times_now"))


@query(
    "last_attempt",
    """SELECT sha256(split_part(url, '/', 3)) AS hash_id, max(page_id % 5) AS times FROM pages
GROUP BY split_part(url, '/', 3)""",
)
def q_last_attempt(spark, sf):
    host = F.split_part("url", F.lit("/"), F.lit(3))
    tried = pages(spark, sf).select(host.alias("link"), (F.col("page_id") % 5).alias("times"))
    return qu.last_attempts(tried).select(lk.link_key(F.col("link")).alias("hash_id"), "times")


# --- streams -----------------------------------------------------------------------------------


def folder(spark, name):
    return run_folder(spark, name)


# Each copy of a link comes as a file of its own: one on time, one a minute later, one a day before or
# after.  The day is longer than the interval, so every link comes out twice, whatever the order.
DEDUP_DAYS = 1


@query(
    "stream_dedup",
    f"""WITH {COPIES}, links AS (SELECT DISTINCT link FROM copies)
SELECT sha256(link) AS hash_id, link, DATE '2024-01-01' + CAST(d AS INTEGER) AS day
FROM links, (VALUES (0), ({DEDUP_DAYS})) days(d) WHERE len(link) % 2 = 0
UNION ALL
SELECT sha256(link), link, DATE '2024-01-01' - CAST(d AS INTEGER)
FROM links, (VALUES (0), ({DEDUP_DAYS})) days(d) WHERE len(link) % 2 = 1""",
)
def q_stream_dedup(spark, sf):
    source, out, mark = (folder(spark, f"dedup-{x}") for x in ("in", "out", "mark"))
    length = F.length("link")
    noon = F.lit(dt.datetime(2024, 1, 1, 12)) + F.make_dt_interval(mins=length)
    day = F.when(length % 2 == 0, DEDUP_DAYS).otherwise(-DEDUP_DAYS)
    shift = {1: F.make_dt_interval(mins=F.lit(1)), 2: F.make_dt_interval(days=day), 0: F.make_dt_interval()}
    rows = copies(spark, sf).withColumn("copy", F.col("seq") % 3)
    for copy, later in shift.items():
        stamped = rows.filter(F.col("copy") == copy).select(
            lk.link_key(F.col("link")).alias("hash_id"), "link", (noon + later).alias("ts")
        )
        stamped.write.mode("append").json(source)
    stream = qu.messages(spark, source, "hash_id string, link string, ts timestamp", files_per_batch=2)
    qu.drain(qu.dedup(stream), out, mark)
    return spark.read.parquet(out).select("hash_id", "link", F.col("ts").cast("date").alias("day"))


@query(
    "stream_fanout",
    f"WITH {MENU} SELECT page_id, link AS content_link, sha256(link) AS hash_id FROM menu",
)
def q_stream_fanout(spark, sf):
    source, out, mark = (folder(spark, f"fan-{x}") for x in ("in", "out", "mark"))
    found = F.transform("el.link", lambda a: h.attribute(a, "href"))
    pg.parsed(pages(spark, sf), {"link": ("nav", "a")}).select("page_id", found.alias("links")).write.json(source)
    stream = qu.messages(spark, source, "page_id long, links array<string>")
    qu.drain(qu.fan_out(stream, "links", "content_link"), out, mark)
    return spark.read.parquet(out)


@query(
    "stream_tier_sink",
    "SELECT page_id, split_part(url, '/', 4) AS tier1, sha256(url) AS hash_id FROM pages",
)
def q_stream_tier_sink(spark, sf):
    source, out, mark = (folder(spark, f"tier-{x}") for x in ("in", "out", "mark"))
    pages(spark, sf).select("page_id", "url").write.json(source)
    stream = qu.messages(spark, source, "page_id long, url string")
    record = stream.select(
        "page_id",
        F.split_part("url", F.lit("/"), F.lit(4)).alias("tier1"),
        lk.link_key(F.col("url")).alias("hash_id"),
    )
    qu.drain(record, out, mark, "json", ["tier1"])
    return spark.read.schema("page_id long, hash_id string, tier1 string").json(out)


# --- product records over pages written from the part table ------------------------------------


def pages_a(spark, sf):
    """A shop-A product page for every part."""
    c = F.col
    whole = F.format_number(F.floor(c("p_retailprice")), 0)
    pieces = [
        F.lit('<html><body><div id="bt_2_layout_NAV"><ul><li class="first"><a href="/">Home</a></li><li><a href="/t">'),
        c("p_type"),
        F.lit("</a></li>\n <li>"),
        c("p_brand"),
        F.lit('</li></ul></div><a id="webBrand">'),
        c("p_brand"),
        F.lit('</a><p id="osmGoodsName"> <b>'),
        c("p_brand"),
        F.lit("</b> "),
        c("p_name"),
        F.lit(' </p><ul class="prdPrice"><li>市售價<span class="seoPrice">'),
        whole,
        F.lit('</span></li><li>促銷價<span class="seoPrice">'),
        c("p_size").cast("string"),
        F.lit('</span></li></ul><div class="ineventArea"><ul><li>滿 '),
        c("p_size").cast("string"),
        F.lit(' 折\n</li><li>說明</li></ul></div><table id="attributesTable"><tr><th>尺寸<td> '),
        c("p_size").cast("string"),
        F.lit(" cm<tr><th>類型<td>"),
        c("p_type"),
        F.lit('</table><div class="related_category"><dl class="brandTxt"><dd>x</dd></dl><dl><dd><a>'),
        c("p_type"),
        F.lit("</a></dd><dd><a>"),
        c("p_name"),
        F.lit('</a></dd></dl></div><ul><li class="goodsCommendLi selected"><span goodscount="'),
        F.format_number(c("p_size") * 700, 0),
        F.lit('">x</span></li></ul><i class="indicatorAvgVal">4.5</i><div class="indicator"><b class="indicatorTitle">商品品質</b><b class="indicatorNumber">4.'),
        (c("p_size") % 10).cast("string"),
        F.lit('</b></div><div class="indicator"><b class="indicatorTitle">出貨速度</b><b class="indicatorNumber">3.5</b></div><div class="SelectorOption">全部 <i>(9)</i></div><div class="reviewCard"><i class="RatingStarGroup" score="5"></i><i class="SpecValue">'),
        c("p_brand"),
        F.lit('</i><i class="Info">2024/01/02</i><i class="CommentContainer">'),
        c("p_name"),
        F.lit(' &amp; more</i></div><div class="reviewCard"><i class="RatingStarGroup" score="3"></i><i class="CommentContainer">ok</i></div></body></html>'),
    ]
    url = F.concat(F.lit(f"{HOST}/goods/"), c("p_partkey").cast("string"))
    return v.dealt(spark, sf, "part").select(
        c("p_partkey").alias("page_id"), url.alias("url"), F.concat(*pieces).alias("html")
    )


@query(
    "product_record_a",
    f"""SELECT p_partkey AS page_id, p_brand AS item_brand, p_brand || ' ' || p_name AS item_name,
  CAST(floor(p_retailprice) AS INTEGER) AS market_price, p_size AS promotional_price,
  CAST(NULL AS INTEGER) AS discounted_price, '滿' || p_size || '折說明' AS activity, '20240201' AS data_date,
  '{HOST}/goods/' || p_partkey AS item_url, p_size || 'cm' AS spec_size, p_type AS spec_type,
  p_type || '|' || p_name AS related, p_size * 700 AS goods_commend_count,
  4.5 AS average, CAST('4.' || p_size % 10 AS DOUBLE) AS quality,
  CAST(NULL AS DOUBLE) AS accurate, 3.5 AS shipping, 2 AS reviews, p_type AS tier1, p_brand AS tier2,
  CAST(NULL AS VARCHAR) AS tier3, sha256('{HOST}/goods/' || p_partkey) AS hash_id
FROM part""",
)
def q_product_record_a(spark, sf):
    records = pg.with_tiers(pg.product_records_a(pages_a(spark, sf), F.lit(v.TODAY)), least=3)
    prefix = "goods_commend_indicator_"
    return records.select(
        "page_id", "item_brand", "item_name", "market_price", "promotional_price", "discounted_price",
        "activity", "data_date", "item_url",
        F.col("item_spec")["尺寸"].alias("spec_size"), F.col("item_spec")["類型"].alias("spec_type"),
        F.get("related_category_list", 0).alias("related"), "goods_commend_count",
        F.col(f"{prefix}average_value").alias("average"), F.col(f"{prefix}quality").alias("quality"),
        F.col(f"{prefix}accurate").alias("accurate"), F.col(f"{prefix}shipping").alias("shipping"),
        F.size("goods_commend_review_card_list").alias("reviews"), "tier1", "tier2", "tier3", "hash_id",
    )


@query(
    "review_explode",
    f"""SELECT sha256('{HOST}/goods/' || p_partkey) AS hash_id, card_no,
  CASE card_no WHEN 0 THEN '5' ELSE '3' END AS review_card_score,
  CASE card_no WHEN 0 THEN p_brand ELSE '' END AS review_card_spec,
  CASE card_no WHEN 0 THEN '2024/01/02' END AS review_card_date,
  CASE card_no WHEN 0 THEN p_name || ' & more' ELSE 'ok' END AS review_card_comment
FROM part, (VALUES (0), (1)) c(card_no)""",
)
def q_review_explode(spark, sf):
    return pg.review_rows(pg.product_records_a(pages_a(spark, sf), F.lit(v.TODAY))).withColumn(
        "review_card_spec", F.coalesce("review_card_spec", F.lit(""))
    )


def pages_b(spark, sf):
    """A shop-B product page for every supplier."""
    c = F.col
    pieces = [
        F.lit('<html><body><div class="header_logo" title="'),
        c("s_name"),
        F.lit('"></div><div class="Product_price"><span class="now_price">$</span><span class="now_price"> '),
        F.format_number(c("s_suppkey") + 1000, 0),
        F.lit(' </span><span class="was_price">&nbsp;</span></div><div class="Item_number"><span>No</span><span>P'),
        c("s_suppkey").cast("string"),
        F.lit('</span></div><h1 class="Product_name">\n '),
        c("s_name"),
        F.lit(', new</h1><div class="Product_notes"><p>first</p><p>'),
        c("s_name"),
        F.lit('</p></div><p id="pay_method"> card </p><p id="delivery_method">\tvan</p><div class="discountbox"><ul><li><ul><li>折價券</li><li>-$40</li><li>折價券</li></ul></li></ul></div><div id="content1"><p>粗跟★皮鞋</p><p>#'),
        c("s_suppkey").cast("string"),
        F.lit('</p></div><i class="comment_total_amount_num">'),
        (c("s_nationkey") % 2).cast("string"),
        F.lit('</i><i class="comment_total_grade_num">4.0</i><div class="comment_data"><div class="comment_grade_star"><img src="/img/star_'),
        (c("s_nationkey") % 5).cast("string"),
        F.lit('.png"></div><div class="customer_comment_reply"><p>very, good</p></div></div><div class="iopen-footer-spec"><ul class="header_spec_v2"><li>商品: <span>'),
        c("s_suppkey").cast("string"),
        F.lit(" </span></li><li>評價:<span>5.0/5.0</span></li></ul></div></body></html>"),
    ]
    url = F.concat(F.lit(f"{HOST}/item/"), c("s_suppkey").cast("string"))
    return v.dealt(spark, sf, "supplier").select(
        c("s_suppkey").alias("page_id"), url.alias("url"), F.concat(*pieces).alias("html")
    )


@query(
    "product_record_b",
    f"""SELECT s_suppkey AS page_id, s_name AS item_brand, 'P' || s_suppkey AS item_no,
  replace(s_name, ' ', '') || 'new' AS item_name, 'first//' || s_name AS item_note,
  CAST(s_suppkey + 1000 AS INTEGER) AS now_price, CAST(NULL AS INTEGER) AS past_price, '-$40' AS activity,
  'card' AS payway, 'van' AS deliveryway, '粗跟 皮鞋 ' || s_suppkey AS item_feature,
  CAST(s_suppkey AS VARCHAR) AS seller_items, '5.0/5.0' AS seller_rating,
  s_nationkey % 2 AS comments, CASE WHEN s_nationkey % 2 > 0 THEN 4.0 END AS average,
  CASE WHEN s_nationkey % 2 > 0 THEN s_nationkey % 5 END AS card_score,
  CASE WHEN s_nationkey % 2 > 0 THEN 'verygood' END AS card_comment
FROM supplier""",
)
def q_product_record_b(spark, sf):
    records = pg.product_records_b(pages_b(spark, sf), F.lit(v.TODAY))
    card = F.get("goods_commend_review_card_list", 0)
    return records.select(
        "page_id", "item_brand", "item_no", "item_name", "item_note", "now_price", "past_price",
        F.array_join("activity", "|").alias("activity"), "payway", "deliveryway", "item_feature",
        F.col("store_seller")["商品"].alias("seller_items"), F.col("store_seller")["評價"].alias("seller_rating"),
        F.col("goods_commend.count").alias("comments"),
        F.col("goods_commend.indicator_average_value").alias("average"),
        card["review_card_score"].alias("card_score"), card["review_card_comment"].alias("card_comment"),
    )
