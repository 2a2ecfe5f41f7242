"""Member x category features from point-of-sale lines.

Input columns follow the warehouse tables: lines carry ``mid, pma_no_fin, rec_no, data_date,
sale_time, store_no, job_id, item_cont, mm_sales``.  All aggregates are two-phase on
``(mid, pma_no_fin, ...)``; windows only run over aggregated rows, where a member has at most one
row per category, so one very active member never lands in one task as raw lines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import places
from tillroll.functions.numbers import cents, half_up
from tillroll.session import small

KEYS = ["mid", "pma_no_fin"]

# They must equal the reference's for right results.
JOB_ID = "23"
EXCLUDED = ["22", "62", "69", "70", "80", "81", "88", "96", "97", "98", "99", "100", "400"]
EXCLUDED_FOR_CITY = [
    "22", "54", "55", "58", "62", "69", "70", "80", "81", "82", "88",
    "96", "97", "98", "99", "100", "200", "400",
]
AREA_CODES = ["01", "02", "03", "04", "05", "06", "07", "09", "10", "11"]
OPEN_END = "9999-12-31"
BIRTHDAY_FLOOR = dt.date(1900, 1, 1)
BIRTHDAY_SENTINELS = [dt.date(1980, 10, 10), dt.date(2019, 1, 1)]
MAX_AGE = 100
COMPAT_WINDOW_DAYS = 7
# End of fixed values.


def window_end(start: dt.date, window_days: int) -> dt.date:
    """Last day of a window that starts at ``start`` and covers ``window_days`` days."""
    return start + dt.timedelta(days=window_days - 1)


def of_known_members(features: DataFrame, members: DataFrame, min_mid_length: int = 2) -> DataFrame:
    """Keep the features of known members.

    The member is a key of every feature, so this filters aggregated rows: the raw lines of a very
    active member are never brought together for a join.
    """
    known = members.filter(F.length("mid") > min_mid_length).select("mid")
    return features.join(known, "mid", "left_semi")


def member_profile(
    members: DataFrame,
    today: dt.date,
    sentinels: Iterable[dt.date] = tuple(BIRTHDAY_SENTINELS),
    min_mid_length: int = 2,
) -> DataFrame:
    """Age, home city and sex, one row per member.

    Age counts calendar years; placeholder birthdays and ages of 100 or more become null.
    """
    birthday = F.col("birthday")
    age = F.lit(today.year) - F.year(birthday)
    unknown = (birthday <= F.lit(BIRTHDAY_FLOOR)) | birthday.isin(list(sentinels))
    return (
        members.filter(F.length("mid") > min_mid_length)
        .select(
            "mid",
            F.when(unknown | (age >= MAX_AGE), None).otherwise(age).alias("age"),
            places.formal_tai(F.col("home_city")).alias("home_city"),
            F.col("gender").alias("sex"),
        )
        .dropDuplicates(["mid"])
    )


def lines_in_scope(
    lines: DataFrame,
    start: dt.date,
    end: dt.date,
    job_id: str | None = JOB_ID,
    excluded: Iterable[str] = tuple(EXCLUDED),
) -> DataFrame:
    """Lines of the window and the job, without excluded categories."""
    kept = lines.filter(
        F.col("data_date").between(F.lit(start), F.lit(end))
        & ~F.col("pma_no_fin").isin(list(excluded))
    )
    if job_id is not None:
        kept = kept.filter(F.col("job_id") == job_id)
    return kept


def festival_count(festivals: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """One row: number of festival days inside the window, as double."""
    return festivals.filter(F.col("start_date").between(F.lit(start), F.lit(end))).agg(
        F.count(F.lit(1)).cast("double").alias("cnt_festival")
    )


def _value_columns(qty: Column, all_cnt: Column, sales: Column) -> dict[str, Column]:
    share = half_up(F.try_divide(qty.cast("double"), all_cnt.cast("double")), 3)
    aov = half_up(F.try_divide(sales.cast("double"), qty.cast("double")), 2)
    return {"cv_ratio": share, "aov": aov, "cv": share * aov}


def category_value(lines: DataFrame) -> DataFrame:
    """Units, share of the member's units, average unit value and their product per category."""
    per_category = lines.groupBy(*KEYS).agg(
        F.sum("item_cont").alias("qty"), (F.sum(cents(F.col("mm_sales"))) / 100).alias("sales")
    )
    member = Window.partitionBy("mid")
    return (
        per_category.withColumn("all_cnt", F.sum("qty").over(member))
        .withColumns(_value_columns(F.col("qty"), F.col("all_cnt"), F.col("sales")))
        .drop("sales")
    )


def _receipts(lines: DataFrame, festivals: DataFrame) -> DataFrame:
    """Distinct receipts with a flag for purchases on a festival day."""
    days = festivals.select(F.col("start_date").alias("data_date")).distinct()
    receipts = lines.select(*KEYS, "rec_no", "data_date", "sale_time").distinct()
    return with_time(receipts, days)


def with_time(receipts: DataFrame, days: DataFrame) -> DataFrame:
    """Add the part of the day, and ``is_weekend`` for the given days (null for others)."""
    part = places.day_part(F.col("sale_time"))
    return receipts.withColumn("day_part", part).join(days.withColumn("is_weekend", F.lit(True)), "data_date", "left")


def _time_counts() -> list[Column]:
    weekend = F.col("is_weekend").isNotNull()
    parts = [
        F.count(F.when(F.col("day_part") == part, 1)).alias(part) for part in places.DAY_PARTS
    ]
    return [
        F.count(F.when(~weekend, 1)).alias("weekday_cnt"),
        F.count(F.when(weekend, 1)).alias("weekend_cnt"),
        *parts,
    ]


def _preference_flags(counts: DataFrame, n_festival: DataFrame, window_days: int) -> DataFrame:
    """Turn counts into visits per available day and compare; ties set both flags."""
    rated = (
        counts.crossJoin(F.broadcast(n_festival))  # one row by construction (global aggregate)
        .withColumn(
            "weekday_freq",
            F.try_divide(
                F.col("weekday_cnt").cast("double"), F.lit(float(window_days)) - F.col("cnt_festival")
            ),
        )
        .withColumn(
            "weekend_freq", F.try_divide(F.col("weekend_cnt").cast("double"), F.col("cnt_festival"))
        )
    )
    return rated.withColumns(
        {
            "weekday": F.when(F.col("weekday_freq") >= F.col("weekend_freq"), "1").otherwise("0"),
            "weekend": F.when(F.col("weekday_freq") <= F.col("weekend_freq"), "1").otherwise("0"),
        }
    ).drop("weekday_cnt", "weekend_cnt", "weekday_freq", "weekend_freq", "cnt_festival")


def purchase_time(
    lines: DataFrame,
    festivals: DataFrame,
    start: dt.date,
    end: dt.date,
    compat: bool = False,
) -> DataFrame:
    """Weekday/weekend preference and receipts per part of the day.

    ``compat`` keeps the fixed window length of seven days in the weekday rate.
    """
    window_days = COMPAT_WINDOW_DAYS if compat else (end - start).days + 1
    festivals = small(festivals.select("start_date"))
    counts = _receipts(lines, festivals).groupBy(*KEYS).agg(*_time_counts())
    return _preference_flags(counts, festival_count(festivals, start, end), window_days)


def rfm_base(lines: DataFrame, end: dt.date) -> DataFrame:
    """Recency in days, number of receipts, value and value per receipt."""
    agg = lines.groupBy(*KEYS).agg(
        F.count_distinct("rec_no").alias("rfm_frequency"),
        F.max("data_date").alias("last_date"),
        F.sum("item_cont").alias("qty"),
        (F.sum(cents(F.col("mm_sales"))) / 100).alias("sales"),
    )
    return _rfm_columns(
        agg.withColumn(
            "aov", half_up(F.try_divide(F.col("sales").cast("double"), F.col("qty").cast("double")), 2)
        ),
        end,
    ).select(*KEYS, "rfm_recency", "rfm_frequency", "aov", "rfm_monetary_sum", "rfm_monetary")


def _rfm_columns(agg: DataFrame, end: dt.date) -> DataFrame:
    return (
        agg.withColumn("rfm_recency", F.datediff(F.lit(end), F.col("last_date")))
        .withColumn("rfm_monetary_sum", F.col("aov") * F.col("qty").cast("double"))
        .withColumn(
            "rfm_monetary",
            F.try_divide(F.col("rfm_monetary_sum"), F.col("rfm_frequency").cast("double")),
        )
    )


def current_stores(stores: DataFrame) -> DataFrame:
    """Area of every store version without an end date."""
    return stores.filter(F.col("eff_date_to") == OPEN_END).select("store_no", "master_area_no")


def _area_counts(codes: Iterable[str]) -> list[Column]:
    return [F.count(F.when(F.col("master_area_no") == c, 1)).alias(f"area_{c}") for c in codes]


def area_pivot(
    lines: DataFrame, stores: DataFrame, codes: Iterable[str] = tuple(AREA_CODES)
) -> DataFrame:
    """Lines per store area, one column per area code."""
    per_store = lines.groupBy(*KEYS, "store_no").agg(F.count(F.lit(1)).alias("n"))
    joined = per_store.join(small(current_stores(stores)), "store_no", "left")
    sums = [
        F.coalesce(F.sum(F.when(F.col("master_area_no") == c, F.col("n"))), F.lit(0)).alias(
            f"area_{c}"
        )
        for c in codes
    ]
    return joined.groupBy(*KEYS).agg(*sums)


def latest_stores(stores: DataFrame, key: str = "store_no") -> DataFrame:
    """Newest version of every store that is not a test store."""
    fields = [c for c in stores.columns if c != key]
    newest = F.max_by(F.struct(*fields), F.col("eff_date_from")).alias("v")
    return (
        stores.filter((F.col("store_test_flag") == "0") & F.col(key).isNotNull())
        .groupBy(key)
        .agg(newest)
        .select(key, *[F.col(f"v.{f}").alias(f) for f in fields])
    )


def store_cities(stores: DataFrame, key: str = "store_no", rank_by: str | None = None) -> DataFrame:
    """City of the newest version of every store, keyed by ``key``.

    ``rank_by`` picks the version by another column than the key; the key may then repeat.
    """
    newest = latest_stores(stores, rank_by or key)
    return newest.select(key, places.address_city(F.col("address")).alias("city"))


def store_city_fallback(lines: DataFrame, stores: DataFrame, compat: bool = False) -> DataFrame:
    """Count lines per member, category, store and city.

    The city comes from the store number, and from the old store number where that is unknown.
    Lines are counted per store before the joins.
    """
    per_store = lines.groupBy(*KEYS, "store_no").agg(F.count(F.lit(1)).alias("n_lines"))
    stores = small(stores)
    by_number = store_cities(stores).withColumnRenamed("city", "city_now")
    by_old_number = store_cities(
        stores, "old_store_no", rank_by="store_no" if compat else "old_store_no"
    ).select(F.col("old_store_no").alias("store_no"), F.col("city").alias("city_old"))
    return (
        per_store.join(by_number, "store_no", "left")
        .join(by_old_number, "store_no", "left")
        .select(
            *KEYS, "store_no", F.coalesce("city_now", "city_old").alias("city"), "n_lines"
        )
    )


def active_city_region(store_lines: DataFrame, compat: bool = False) -> DataFrame:
    """City and region where a member buys a category most often.

    Several leading cities (regions) give the cross-city (cross-region) mark.  ``compat`` returns
    what the original statement returned: the region must lead too, keys whose leading city has
    no region disappear, a key may get several rows, and the region mark is decided per city.
    """
    key = Window.partitionBy(*KEYS)
    counts = (
        store_lines.withColumn("region", places.city_region(F.col("city")))
        .groupBy(*KEYS, "city", "region")
        .agg(
            F.sum(F.when(F.col("city").isNotNull(), F.col("n_lines")).otherwise(0)).alias("cnt_city"),
            F.sum(F.when(F.col("region").isNotNull(), F.col("n_lines")).otherwise(0)).alias(
                "cnt_region"
            ),
        )
    )
    leading = counts.withColumns(
        {"max_city": F.max("cnt_city").over(key), "max_region": F.max("cnt_region").over(key)}
    ).filter(F.col("cnt_city") == F.col("max_city"))
    if compat:
        return (
            leading.filter(F.col("cnt_region") == F.col("max_region"))
            .withColumn("n", F.count(F.lit(1)).over(key))
            .select(
                *KEYS,
                F.when(F.col("n") == 1, F.col("city")).otherwise(places.CROSS_CITY).alias("active_city"),
                F.coalesce("region", F.lit(places.CROSS_REGION)).alias("active_region"),
            )
            .distinct()
        )
    one = leading.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("city").alias("city"),
        F.count_distinct("region").alias("n_region"),
        F.min("region").alias("region"),
    )
    return one.select(
        *KEYS,
        F.when(F.col("n") == 1, F.col("city")).otherwise(places.CROSS_CITY).alias("active_city"),
        F.when(F.col("n_region") == 1, F.col("region"))
        .otherwise(places.CROSS_REGION)
        .alias("active_region"),
    )


def area_store_count(areas: DataFrame, stores: DataFrame) -> DataFrame:
    """Open stores per area, with the first part of the area name."""
    names = (
        areas.filter(F.col("eff_date_to") == OPEN_END)
        .select(
            "master_area_no",
            F.split_part(F.col("area_name"), F.lit("---"), F.lit(1)).alias("master_area_name"),
        )
        .distinct()
    )
    counts = (
        stores.filter(F.col("eff_date_to") == OPEN_END)
        .groupBy("master_area_no")
        .agg(F.count("master_area_no").alias("cnt"))
    )
    return names.join(counts, "master_area_no", "left")
