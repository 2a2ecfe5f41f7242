"""The member x category feature table in two scans of the lines.

The receipt branch gives value, recency/frequency and purchase time; the store branch gives area
counts and the active city.  Both end with one aggregate on ``(mid, pma_no_fin)``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import places
from tillroll.functions.numbers import cents, half_up
from tillroll.operators import features as ft
from tillroll.session import small

KEYS = ft.KEYS
NO_REGION = "\uffff"  # sorts behind every region
#: Parts of the receipts of one key, so that those of an active member don't meet in one task.
RECEIPT_PARTS = 64
#: Parts of the rows of one store, where stores are too many for a broadcast.
STORE_PARTS = 8

COLUMNS = [
    "mid", "pma_no_fin", "qty", "avg_qty", "aov", "cv_ratio", "cv",
    "rfm_recency", "rfm_frequency", "rfm_monetary_sum", "rfm_monetary",
    "weekday", "weekend", *places.DAY_PARTS,
    *[f"area_{c}" for c in ft.AREA_CODES],
    "active_city", "active_region", "age", "home_city", "sex",
]


def _receipt_totals(timed: DataFrame, tasks: int | None) -> DataFrame:
    """Sums, receipts and times of every key from its receipts."""
    sums = [F.sum("qty").alias("qty"), F.sum("cents").alias("cents")]
    counts, last = ft._time_counts(), F.max("data_date").alias("last_date")
    n_receipts = F.count_distinct("rec_no").alias("rfm_frequency")
    if not tasks:
        return timed.groupBy(*KEYS).agg(*sums, n_receipts, last, *counts)
    # Lines of a receipt lie in one part, so its number counts once in all parts of its key.
    part = F.pmod(F.xxhash64("rec_no"), F.lit(RECEIPT_PARTS)).alias("part")
    parts = timed.select("*", part).repartition(tasks, *KEYS, "part").groupBy(*KEYS, "part").agg(
        *sums, n_receipts, last, *counts
    )
    added = ["rfm_frequency", "weekday_cnt", "weekend_cnt", *places.DAY_PARTS]
    return parts.repartition(tasks, *KEYS).groupBy(*KEYS).agg(
        *sums, F.max("last_date").alias("last_date"), *[F.sum(c).alias(c) for c in added]
    )


def _receipt_features(
    lines: DataFrame, festivals: DataFrame, start: dt.date, end: dt.date, compat: bool, tasks: int | None = None
) -> DataFrame:
    days = festivals.select(F.col("start_date").alias("data_date")).distinct()
    receipts = lines.groupBy(*KEYS, "rec_no", "data_date", "sale_time").agg(
        F.sum("item_cont").alias("qty"), F.sum(cents(F.col("mm_sales"))).alias("cents")
    )
    totals = _receipt_totals(ft.with_time(receipts, days), tasks).withColumn("sales", F.col("cents") / 100).drop("cents")
    window_days = ft.COMPAT_WINDOW_DAYS if compat else (end - start).days + 1
    flagged = ft._preference_flags(totals, ft.festival_count(festivals, start, end), window_days)
    if tasks:
        flagged = flagged.repartition(tasks, "mid")
    valued = flagged.withColumn(
        "all_cnt", F.sum("qty").over(Window.partitionBy("mid"))
    ).withColumns(ft._value_columns(F.col("qty"), F.col("all_cnt"), F.col("sales")))
    return ft._rfm_columns(valued, end).withColumn(
        "avg_qty",
        half_up(F.try_divide(F.col("qty").cast("double"), F.col("rfm_frequency").cast("double")), 2),
    )


def _store_features(lines: DataFrame, stores: DataFrame, tasks: int | None = None) -> DataFrame:
    """Area counts and the leading city of every key."""
    if tasks:  # one row per receipt and store, so that no raw lines of an active member meet
        counts = lines.groupBy(*KEYS, "store_no", "rec_no").agg(F.count(F.lit(1)).alias("n"))
        counts = counts.drop("rec_no").repartition(tasks, *KEYS, "store_no")
        per_store = counts.groupBy(*KEYS, "store_no").agg(F.sum("n").alias("n"))
    else:
        per_store = lines.groupBy(*KEYS, "store_no").agg(F.count(F.lit(1)).alias("n"))
    by_old = ft.store_cities(stores, "old_store_no").select(
        F.col("old_store_no").alias("store_no"), F.col("city").alias("city_old")
    )
    # One row per store: how many open versions it has in each area.  Several open versions count a
    # line in several areas, but never twice for the city.
    open_in = ft.current_stores(stores).groupBy("store_no").agg(
        *[F.count(F.when(F.col("master_area_no") == c, 1)).alias(f"in_{c}") for c in ft.AREA_CODES]
    )
    now = ft.store_cities(stores)
    if tasks:
        known = open_in.join(now, "store_no", "full").join(by_old, "store_no", "full")
        located = _with_store(per_store, known, tasks).repartition(tasks, *KEYS)
    else:
        located = per_store.join(open_in, "store_no", "left").join(now, "store_no", "left").join(by_old, "store_no", "left")
    located = located.withColumn("city", F.coalesce("city", "city_old"))
    per_city = located.groupBy(*KEYS, "city").agg(
        F.sum("n").alias("n"),
        *[F.coalesce(F.sum(F.col("n") * F.col(f"in_{c}")), F.lit(0)).alias(f"area_{c}") for c in ft.AREA_CODES],
    )
    n = F.when(F.col("city").isNull(), 0).otherwise(F.col("n"))
    region = places.city_region(F.col("city"))
    # Largest and smallest of the cities (regions) with the highest count; equal means only one.
    folded = per_city.withColumn("region", region).groupBy(*KEYS).agg(
        *[F.sum(f"area_{c}").alias(f"area_{c}") for c in ft.AREA_CODES],
        F.max(F.struct(n, "city")).alias("last_city"),
        F.min(F.struct(-n, "city")).alias("first_city"),
        F.max(F.struct(n, "region")).alias("last_region"),
        F.min(F.struct(-n, F.coalesce("region", F.lit(NO_REGION)).alias("region"))).alias("first_region"),
    )
    city, region = F.col("last_city.city"), F.col("last_region.region")
    in_city_scope = ~F.col("pma_no_fin").isin(ft.EXCLUDED_FOR_CITY)
    active_city = F.when(city.eqNullSafe(F.col("first_city.city")), city).otherwise(places.CROSS_CITY)
    active_region = F.when(region == F.col("first_region.region"), region).otherwise(
        places.CROSS_REGION
    )
    return folded.select(
        *KEYS,
        *[f"area_{c}" for c in ft.AREA_CODES],
        F.when(in_city_scope, active_city).alias("active_city"),
        F.when(in_city_scope, active_region).alias("active_region"),
    )


def _with_store(per_store: DataFrame, known: DataFrame, tasks: int) -> DataFrame:
    """Add what is known of a store, one row each: counted and broadcast, or met in ``tasks`` tasks."""
    few = small(known)
    if few is not known:
        return per_store.join(F.broadcast(few), "store_no", "left")
    part = F.pmod(F.xxhash64(*KEYS), F.lit(STORE_PARTS)).alias("part")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(STORE_PARTS - 1).cast("long"))).alias("part")
    dealt = per_store.select("*", part).repartition(tasks, "store_no", "part")
    return dealt.join(known.select("*", every).repartition(tasks, "store_no", "part"), ["store_no", "part"], "left").drop("part")


def _store_features_compat(
    lines: DataFrame, city_lines: DataFrame, stores: DataFrame
) -> DataFrame:
    areas = ft.area_pivot(lines, stores)
    cities = ft.active_city_region(ft.store_city_fallback(city_lines, stores, True), True)
    return areas.join(cities, KEYS, "left")


def member_features(
    members: DataFrame,
    lines: DataFrame,
    festivals: DataFrame,
    stores: DataFrame,
    start: dt.date,
    window_days: int,
    today: dt.date,
    compat: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """One row per member and category with value, RFM, time, area, city and profile columns.

    ``tasks`` fixes the number of tasks; without it Spark merges them by bytes.
    """
    end = ft.window_end(start, window_days)
    festivals, stores = small(festivals.select("start_date")), small(stores)
    if tasks:
        members = members.repartition(tasks, "mid")
    profile = ft.member_profile(members, today)
    scope = ft.lines_in_scope(lines, start, end)
    receipts = _receipt_features(scope, festivals, start, end, compat, tasks)
    if compat:
        city_scope = ft.lines_in_scope(lines, start, end, excluded=ft.EXCLUDED_FOR_CITY)
        located = _store_features_compat(scope, city_scope, stores)
    else:
        located = _store_features(scope, stores, tasks)
    # Lines of unknown members leave here, as aggregated rows, together with the profile join.
    return receipts.join(profile, "mid").join(located, KEYS, "left").select(*COLUMNS)
