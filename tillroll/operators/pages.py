"""Typed records from saved pages.  Input: ``pages(page_id, url, html)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import html as h
from tillroll.functions import links as lk
from tillroll.functions.numbers import price, strip_noise
from tillroll.functions.text import clean
from tillroll.session import materialize

# Price and rating labels of shop A, the constant removed from shop B's activities.
PRICE_LABELS = {
    "market_price": "市售價",
    "promotional_price": "促銷價",
    "discounted_price": "折扣後價格",
}
INDICATORS = {
    "goods_commend_indicator_quality": "商品品質",
    "goods_commend_indicator_accurate": "商品符合",
    "goods_commend_indicator_shipping": "出貨速度",
}
COUPON = "折價券"
# End of fixed values.


def parsed(pages: DataFrame, selectors: dict[str, tuple[str, ...]]) -> DataFrame:
    """Add ``el`` with the selected elements; the page text itself is no longer needed."""
    return pages.withColumn("el", h.find(F.col("html"), selectors)).drop("html")


def _link_rows(elements: Column) -> Column:
    return F.transform(
        F.filter(elements, lambda a: a["attrs"]["href"].isNotNull()),
        lambda a: F.struct(
            a["pos"].alias("pos"),
            h.joined(a).alias("text"),
            h.attribute(a, "href").alias("link"),
        ),
    )


def _link_rows_of(tiers: Column, elements: Column) -> Column:
    """Link rows that carry the first two tiers of their page."""

    def row(a: Column) -> Column:
        first = F.get(tiers, 0).alias("tier1_category_name")
        second = F.coalesce(F.get(tiers, 1), F.lit("")).alias("tier2_category_name")
        return F.struct(first, second, *[a[c].alias(c) for c in ("pos", "text", "link")])

    return F.transform(_link_rows(elements), row)


def links_in(pages: DataFrame, *path: str) -> DataFrame:
    """Links below the selected elements: ``(page_id, url, pos, text, link)`` in document order."""
    return (
        parsed(pages, {"link": (*path, "a")})
        .select("page_id", "url", F.explode(_link_rows(F.col("el.link"))).alias("a"))
        .select("page_id", "url", "a.*")
    )


def page_tiers(pages: DataFrame, *path: str) -> DataFrame:
    """Breadcrumb tiers of every page."""
    tiers = lk.breadcrumb(h.all_texts(F.col("el.crumb")))
    return parsed(pages, {"crumb": path}).select("page_id", "url", tiers.alias("tiers"))


def carry_headings(items: DataFrame, marks: dict[str, str] | None = None) -> DataFrame:
    """Give every link the last headings before it on its page.

    ``items`` has ``(page_id, pos, text, link)``.  A tier-3 link is a heading for the tier-4 links
    behind it; links before the first heading get an empty one.
    """
    before = (
        Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    )
    tier = lk.link_tier(F.col("link"), marks)

    def carried(name: str) -> Column:
        text = F.when(F.col("category_type") == name, F.col("text"))
        return F.coalesce(F.last(text, ignorenulls=True).over(before), F.lit(""))

    tiered = items.withColumn("category_type", tier)
    return tiered.withColumns(
        {"tier3_category_name": carried("tier3"), "tier4_category_name": carried("tier4")}
    )


def category_rows(
    pages: DataFrame,
    host: str,
    menu: tuple[str, ...] = ("#bt_category_Content", "ul", "li"),
    crumbs: tuple[str, ...] = ("#bt_2_layout_NAV", "ul", "li"),
    marks: dict[str, str] | None = None,
    old_host: str | None = None,
) -> DataFrame:
    """Category list pages to category rows with inherited tiers and the key of the link.

    Pages without a first tier give no rows.
    """
    tiers = lk.breadcrumb(h.all_texts(F.col("el.crumb")))
    # The rows are filtered behind the explode: a filter on the parsed page itself would be moved below
    # it and parse every page a second time.
    listed = (
        parsed(pages, {"link": (*menu, "a"), "crumb": crumbs})
        .select("page_id", F.explode(_link_rows_of(tiers, F.col("el.link"))).alias("a"))
        .filter(F.coalesce("a.tier1_category_name", F.lit("")) != "")
        .select("page_id", "a.*")
    )
    link = lk.absolute_link(F.col("link"), host)
    if old_host:
        link = lk.rename_host(link, old_host, host.split("//")[-1])
    return (
        carry_headings(listed, marks)
        .withColumn("category_link", link)
        .select(
            "page_id",
            "pos",
            "tier1_category_name",
            "tier2_category_name",
            "tier3_category_name",
            "tier4_category_name",
            "category_link",
            "category_type",
            lk.link_key(F.col("category_link")).alias("hash_id"),
        )
    )


def menu_entries(pages: DataFrame, heads: list[tuple[str, ...]], entry: tuple[str, ...]) -> DataFrame:
    """Menus out of pages, as ``menu_leaves`` takes them.

    ``heads`` selects the names of the first three levels, ``entry`` the list items of the fourth; the
    first link of an item is its own, links of lists inside it are the fifth level.
    """
    paths = {f"head{i}": path for i, path in enumerate(heads)}
    paths |= {"entry": entry, "name": (*entry, "a"), "below": (*entry, "ul", "li", "a")}

    def link(a: Column) -> Column:
        return F.struct(F.trim(h.joined(a)).alias("text"), h.attribute(a, "href").alias("link"))

    def item(e: Column) -> Column:
        own = link(F.get(h.inside(F.col("el.name"), e), 0))
        below = F.transform(h.inside(F.col("el.below"), e), link)
        return F.struct(own["text"].alias("text"), own["link"].alias("link"), below.alias("below"))

    outer = F.filter("el.entry", lambda e: e["top"])
    tiers = [F.trim(h.first_text(F.col(f"el.head{i}"))).alias(f"tier{i + 1}") for i in range(len(heads))]
    return parsed(pages, paths).select("page_id", *tiers, F.transform(outer, item).alias("entries"))


def menu_leaves(menus: DataFrame, host: str) -> DataFrame:
    """Nested menu to rows: one per fifth-level entry, or the fourth level where there is none.

    ``menus`` has ``tier1, tier2, tier3`` and ``entries`` (array of text, link and an array
    ``below`` of text and link).
    """
    entry = menus.select("tier1", "tier2", "tier3", F.explode("entries").alias("e"))
    leaf = entry.select(
        "tier1", "tier2", "tier3", "e.text", "e.link", F.explode_outer("e.below").alias("b")
    )
    rows = leaf.select(
        "tier1",
        "tier2",
        "tier3",
        F.col("text").alias("tier4"),
        F.col("b.text").alias("tier5"),
        F.concat(F.lit(host), F.coalesce("b.link", "link")).alias("category_link"),
    )
    kind = lk.deepest_tier(["tier1", "tier2", "tier3", "tier4", "tier5"])
    return rows.withColumn("category_type", kind).withColumn(
        "hash_id", lk.link_key(F.col("category_link"))
    )


def page_count(elements: Column) -> Column:
    """Page count in the last text of the page bar (``/12``), else 1."""
    number = F.replace(h.last_text(elements), F.lit("/"), F.lit("")).try_cast("int")
    return F.coalesce(number, F.lit(1))


def fan_out_pages(df: DataFrame, pages: Column) -> DataFrame:
    """One row per page number 1..n."""
    return df.withColumn("page_no", F.explode(F.sequence(F.lit(1), F.greatest(pages, F.lit(1)))))


def first_by_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the first by ``order``; copies are reduced before the exchange."""
    rest = [c for c in df.columns if c != key]
    return (
        df.groupBy(key)
        .agg(F.min_by(F.struct(*rest), F.col(order)).alias("first"))
        .select(key, *[F.col(f"first.{c}").alias(c) for c in rest])
    )


def _last_of_key(pairs: Column) -> Column:
    """Map of key-value pairs; a later pair replaces an earlier one, pairs without key are dropped."""
    known = F.filter(pairs, lambda e: e["key"].isNotNull())
    return F.map_from_entries(
        F.filter(
            known,
            lambda e, i: ~F.exists(
                F.slice(known, i + 2, F.greatest(F.size(known), F.lit(1))), lambda x: x["key"] == e["key"]
            ),
        )
    )


def _last_match(rows: Column, label: Callable[[Column], Column], text: str, value) -> Column:
    """Value of the last row whose label is ``text``."""
    hits = F.filter(rows, lambda r: label(r) == text)
    return F.try_element_at(F.transform(hits, value), F.lit(-1))


# Selectors of the product pages of both shops.
SELECTORS_A = {
    "crumb": ("#bt_2_layout_NAV", "ul", "li"),
    "brand": ("#webBrand",),
    "name": ("#osmGoodsName",),
    "price_row": (".prdPrice", "li"),
    "price": (".prdPrice", "li", ".seoPrice"),
    "activity": (".ineventArea", "li"),
    "spec_row": ("#attributesTable", "tr"),
    "spec_key": ("#attributesTable", "tr", "th"),
    "spec_value": ("#attributesTable", "tr", "td"),
    "related": (".related_category", "dl"),
    "related_item": (".related_category", "dl", "dd"),
    "count": (".goodsCommendLi", "span"),
    "average": (".indicatorAvgVal",),
    "indicator": (".indicator",),
    "indicator_title": (".indicator", ".indicatorTitle"),
    "indicator_number": (".indicator", ".indicatorNumber"),
    "option": (".SelectorOption",),
    "card": (".reviewCard",),
    "card_score": (".reviewCard", ".RatingStarGroup"),
    "card_spec": (".reviewCard", ".SpecValue"),
    "card_date": (".reviewCard", ".Info"),
    "card_comment": (".reviewCard", ".CommentContainer"),
}
SELECTORS_B = {
    "brand": ("div.header_logo",),
    "now_price": (".Product_price", ".now_price"),
    "past_price": (".Product_price", "span.was_price"),
    "number": ("div.Item_number", "span"),
    "name": ("h1.Product_name",),
    "note": ("div.Product_notes", "p"),
    "payment": ("#pay_method",),
    "delivery": ("#delivery_method",),
    "activity": (".discountbox", "ul", "li", "ul", "li"),
    "feature": ("#content1", "p"),
    "count": (".comment_total_amount_num",),
    "average": (".comment_total_grade_num",),
    "card": (".comment_data",),
    "card_star": (".comment_data", ".comment_grade_star", "img"),
    "card_comment": (".comment_data", ".customer_comment_reply", "p"),
    "seller_row": ("div.iopen-footer-spec", "ul.header_spec_v2", "li"),
    "seller_value": ("div.iopen-footer-spec", "ul.header_spec_v2", "li", "span"),
}
# End of fixed values.


def _cards_a() -> Column:
    return F.transform(
        "el.card",
        lambda card: F.struct(
            h.attribute(F.get(h.inside(F.col("el.card_score"), card), 0), "score").alias(
                "review_card_score"
            ),
            F.array_join(
                F.flatten(
                    F.transform(h.inside(F.col("el.card_spec"), card), lambda e: e["texts"])
                ),
                "",
            ).alias("review_card_spec"),
            h.text_inside(F.col("el.card_date"), card).alias("review_card_date"),
            h.text_inside(F.col("el.card_comment"), card).alias("review_card_comment"),
        ),
    )


def product_records_a(pages: DataFrame, data_date: Column) -> DataFrame:
    """Product pages of shop A: prices, specification, categories, rating, reviews, tiers."""

    def el(name: str) -> Column:
        return F.col(f"el.{name}")

    prices = {
        name: price(
            _last_match(
                el("price_row"),
                lambda r: F.get(r["texts"], 0),
                label,
                lambda r: h.text_inside(el("price"), r),
            )
        )
        for name, label in PRICE_LABELS.items()
    }
    spec = F.transform(
        el("spec_row"),
        lambda r: F.struct(
            h.text_inside(el("spec_key"), r).alias("key"),
            F.replace(h.text_inside(el("spec_value"), r), F.lit(" "), F.lit("")).alias("value"),
        ),
    )
    related = F.transform(
        F.filter(el("related"), lambda d: ~F.array_contains(d["classes"], "brandTxt")),
        lambda d: F.array_join(
            F.flatten(F.transform(h.inside(el("related_item"), d), lambda e: e["texts"])), "|"
        ),
    )
    tabs = F.filter(el("count"), lambda e: e["attrs"]["goodscount"].isNotNull())
    count = F.coalesce(price(h.attribute(F.get(tabs, 0), "goodscount")), F.lit(0))
    shown = count > 0
    ratings = {
        name: F.when(
            shown,
            _last_match(
                el("indicator"),
                lambda b: h.text_inside(el("indicator_title"), b),
                label,
                lambda b: h.text_inside(el("indicator_number"), b),
            ).try_cast("double"),
        )
        for name, label in INDICATORS.items()
    }
    activity = F.regexp_replace(F.array_join(h.all_texts(el("activity")), ""), "[ \\n]", "")
    return parsed(pages, SELECTORS_A).select(
        "page_id",
        h.first_text(el("brand")).alias("item_brand"),
        F.trim(F.array_join(h.all_texts(el("name")), "")).alias("item_name"),
        *[c.alias(name) for name, c in prices.items()],
        activity.alias("activity"),
        lk.date_stamp(data_date).alias("data_date"),
        F.col("url").alias("item_url"),
        _last_of_key(spec).alias("item_spec"),
        related.alias("related_category_list"),
        count.alias("goods_commend_count"),
        F.when(shown, h.first_text(el("average")).try_cast("double")).alias(
            "goods_commend_indicator_average_value"
        ),
        F.when(shown, F.transform(el("option"), lambda e: h.joined(e))).alias(
            "goods_commend_goods_commend_info"
        ),
        *[c.alias(name) for name, c in ratings.items()],
        F.when(shown, _cards_a())
        .otherwise(F.slice(_cards_a(), 1, 0))
        .alias("goods_commend_review_card_list"),
        lk.breadcrumb(h.all_texts(el("crumb"))).alias("tiers"),
        lk.link_key(F.col("url")).alias("hash_id"),
    )


def with_tiers(records: DataFrame, tiers: str = "tiers", least: int = 1) -> DataFrame:
    """Add ``tier1, tier2, ...`` as deep as the deepest tier list, ``least`` of them at least.

    The records are written once, so that finding the depth does not parse the pages again.
    """
    stored = materialize(records)
    depth = stored.agg(F.max(F.size(tiers))).first()[0] or 0
    return stored.withColumns(lk.tier_columns(F.col(tiers), max(depth, least)))


def _cards_b() -> Column:
    return F.transform(
        "el.card",
        lambda card: F.struct(
            lk.image_rating(
                h.attribute(F.get(h.inside(F.col("el.card_star"), card), 0), "src")
            ).alias("review_card_score"),
            strip_noise(h.text_inside(F.col("el.card_comment"), card)).alias("review_card_comment"),
        ),
    )


def seller_map(rows: Column, values: Column) -> Column:
    """Key and value of every line of the seller card."""
    return _last_of_key(
        F.transform(
            rows,
            lambda e: F.struct(
                F.split_part(F.get(e["texts"], 0), F.lit(":"), F.lit(1)).alias("key"),
                F.replace(h.text_inside(values, e), F.lit("\u00a0"), F.lit("")).alias("value"),
            ),
        )
    )


def product_records_b(pages: DataFrame, data_date: Column) -> DataFrame:
    """Product pages of shop B: number, notes, prices, payment, delivery, seller, reviews."""

    def el(name: str) -> Column:
        return F.col(f"el.{name}")

    count = F.coalesce(h.first_text(el("count")).try_cast("int"), F.lit(0))
    average = F.when(count > 0, h.first_text(el("average")).try_cast("double"))
    return parsed(pages, SELECTORS_B).select(
        "page_id",
        h.attribute(F.get(el("brand"), 0), "title").alias("item_brand"),
        F.get(h.all_texts(el("number")), 1).alias("item_no"),
        strip_noise(h.first_text(el("name"))).alias("item_name"),
        F.array_join(h.all_texts(el("note")), "//").alias("item_note"),
        price(h.last_text(el("now_price"))).alias("now_price"),
        price(h.last_text(el("past_price"))).alias("past_price"),
        lk.without_constant(h.all_texts(el("activity")), COUPON).alias("activity"),
        strip_noise(h.first_text(el("payment"))).alias("payway"),
        strip_noise(h.first_text(el("delivery"))).alias("deliveryway"),
        clean(F.array_join(h.all_texts(el("feature")), "//"), " ").alias("item_feature"),
        seller_map(el("seller_row"), el("seller_value")).alias("store_seller"),
        F.struct(count.alias("count"), average.alias("indicator_average_value")).alias(
            "goods_commend"
        ),
        F.when(count > 0, _cards_b())
        .otherwise(F.slice(_cards_b(), 1, 0))
        .alias("goods_commend_review_card_list"),
        lk.date_stamp(data_date).alias("data_date"),
        lk.link_key(F.col("url")).alias("hash_id"),
    )


def review_rows(records: DataFrame) -> DataFrame:
    """One row per review card."""
    # Exploding the bare column adds a filter on its size, which would be moved below the records and parse
    # every page a second time, before the pages are dealt out.
    cards = F.transform("goods_commend_review_card_list", lambda c: c)
    return records.select("hash_id", F.posexplode(cards).alias("card_no", "card")).select(
        "hash_id", "card_no", "card.*"
    )


def cards_of_products(records: DataFrame) -> DataFrame:
    """Review cards of all pages of a product in one list, in the order of the pages: ``(hash_id, cards)``."""
    cards = F.struct("page_id", F.col("goods_commend_review_card_list").alias("cards"))
    in_order = F.sort_array(F.collect_list(cards))
    return records.groupBy("hash_id").agg(F.flatten(F.transform(in_order, lambda p: p["cards"])).alias("cards"))
