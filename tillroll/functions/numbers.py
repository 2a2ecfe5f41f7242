"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(col: Column, digits: int) -> Column:
    """Round half away from zero on the decimal value, free of binary noise; returns double."""
    return F.round(col.cast("decimal(28,10)"), digits).cast("double")


def cents(col: Column) -> Column:
    """An amount in hundredths as a whole number: sums are exact, in any order, and stay fast."""
    return F.rint(col * 100).cast("long")


def strip_noise(col: Column) -> Column:
    """Drop line breaks, tabs, commas, blanks, the currency sign and no-break spaces."""
    return F.regexp_replace(col, "[\\n\\t,\\r $\\u00a0]", "")


def price(col: Column) -> Column:
    """Integer price of a scraped text; text without a number gives null."""
    return strip_noise(col).try_cast("int")
