"""Addresses, cities, regions and hours of the day."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must equal the reference's for right results.
COUNTY_MARKS = ["縣", "市"]
UNKNOWN_CITY = "X"
CROSS_CITY = "跨縣市"
CROSS_REGION = "跨區域"
REGION_CITIES = {
    "北部": ["臺北市", "新北市", "基隆市", "新竹市", "桃園市", "新竹縣", "宜蘭縣"],
    "中部": ["臺中市", "苗栗縣", "彰化縣", "南投縣", "雲林縣"],
    "南部": ["高雄市", "臺南市", "嘉義市", "嘉義縣", "屏東縣"],
    "東部": ["花蓮縣", "臺東縣"],
    "外島": ["金門縣", "連江縣", "澎湖縣"],
}
# Fixed values: (column, list of first/last two-digit hour), compared as text.
DAY_PARTS = {
    "midnight": [("21", "24"), ("00", "04")],
    "morning": [("05", "10")],
    "noon": [("11", "14")],
    "afternoon": [("15", "16")],
    "night": [("17", "20")],
}
# End of fixed values.


def formal_tai(col: Column) -> Column:
    """Write the character for Tai in its formal form."""
    return F.translate(col, "台", "臺")


def address_city(address: Column) -> Column:
    """City of an address: its first three characters, or ``X`` where no county is named."""
    named = F.substring(address, 3, 1).isin(COUNTY_MARKS)
    city = F.when(named, F.substring(address, 1, 3)).otherwise(UNKNOWN_CITY)
    return formal_tai(city)


def city_region(city: Column) -> Column:
    """Region of a city; null for cities outside the five regions."""
    pairs = [(c, region) for region, cities in REGION_CITIES.items() for c in cities]
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs)])
    return lookup[city]


def in_day_part(sale_time: Column, part: str) -> Column:
    """Whether the first two characters of a time text fall into the named part of the day."""
    hour = F.substring(sale_time, 1, 2)
    first, *rest = [hour.between(lo, hi) for lo, hi in DAY_PARTS[part]]
    for condition in rest:
        first = first | condition
    return first


def day_part(sale_time: Column) -> Column:
    """Name of the part of the day, null for other texts."""
    names = [F.when(in_day_part(sale_time, part), part) for part in DAY_PARTS]
    return F.coalesce(*names)


def coordinates(page: Column, marker: str = ";window.APP_INITIALIZATION_STATE") -> Column:
    """Longitude and latitude behind the marker of a stored map page.

    The state is a nested list whose first row is ``[zoom, longitude, latitude]``.
    """
    state = F.substring_index(page, marker, -1)
    pattern = r"\[\[\[\s*-?[\d.]+\s*,\s*(-?[\d.]+)\s*,\s*(-?[\d.]+)"
    found = page.contains(marker)
    return F.struct(
        F.when(found, F.regexp_extract(state, pattern, 1)).try_cast("double").alias("longitude"),
        F.when(found, F.regexp_extract(state, pattern, 2)).try_cast("double").alias("latitude"),
    )
