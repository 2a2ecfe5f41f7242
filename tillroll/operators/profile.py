"""Profiles of groups: sizes, statistics, shares.

Groups are few (segments); their rows may be many, so everything is a two-phase aggregate.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.numbers import half_up
from tillroll.operators.quantiles import exact_quantiles
from tillroll.session import materialize, small

STATISTICS = {0.25: "p25", 0.5: "p50", 0.75: "p75"}


def _long(df: DataFrame, label: str, columns: list[str], type_: str = "double") -> DataFrame:
    cast = df.select(label, *[F.col(c).cast(type_).alias(c) for c in columns])
    return cast.unpivot([label], columns, "column", "value")


def group_size(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per group and their share in percent (two digits)."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("cnt"))
    total = sizes.agg(F.sum("cnt").alias("total"))
    return sizes.crossJoin(F.broadcast(total)).select(
        label, "cnt", half_up(F.lit(100.0) * F.col("cnt") / F.col("total"), 2).alias("pct")
    )


def group_describe(df: DataFrame, columns: list[str], label: str = "label") -> DataFrame:
    """Mean, sample deviation, minimum, quartiles and maximum per group and column."""
    cast = df.select(label, *[F.col(c).cast("double").alias(c) for c in columns])
    measures = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = cast.groupBy(label).agg(
        *[
            F.struct(F.lit(c).alias("column"), *[f(c).alias(m) for m, f in measures.items()]).alias(c)
            for c in columns
        ]
    )
    basic = wide.select(label, F.explode(F.array(*columns)).alias("s")).select(label, "s.*")
    quantiles = (
        exact_quantiles(df, [label], columns, list(STATISTICS))
        .groupBy(label, "column")
        .agg(
            *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in STATISTICS.items()]
        )
    )
    return basic.join(quantiles, [label, "column"], "left")


def group_mean_std(df: DataFrame, columns: list[str], label: str = "label") -> DataFrame:
    """Mean and population deviation per group and column."""
    return (
        _long(df, label, columns)
        .groupBy(label, "column")
        .agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    )


def value_share(
    df: DataFrame, columns: list[str], label: str = "label", blank: str = " "
) -> DataFrame:
    """Share of every value per group and text column, with the share of blanks beside it."""
    counts = (
        _long(df, label, columns, "string")
        .groupBy(label, "column", F.coalesce("value", F.lit(blank)).alias("value"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    is_blank = F.col("value") == blank
    totals = counts.groupBy(label, "column").agg(
        F.sum("cnt").alias("rows"),
        F.coalesce(F.sum(F.when(is_blank, F.col("cnt"))), F.lit(0)).alias("null_cnt"),
    )
    return (
        counts.filter(~is_blank)
        .join(totals, [label, "column"])
        .select(
            label,
            "column",
            "value",
            "cnt",
            half_up(100.0 * F.col("cnt") / (F.col("rows") - F.col("null_cnt")), 2).alias("pct"),
            "null_cnt",
            half_up(100.0 * F.col("null_cnt") / F.col("rows"), 0).alias("null_pct"),
        )
    )


def area_ratio(
    df: DataFrame, store_counts: DataFrame, columns: list[str], label: str = "label"
) -> DataFrame:
    """Visits per group and area, as percent of the stores of that area."""
    sums = df.groupBy(label).agg(*[F.sum(c).alias(c) for c in columns])
    visits = sums.unpivot([label], columns, "area", "visits").withColumn(
        "master_area_no", F.regexp_extract("area", r"_(\d+)$", 1)
    )
    return visits.join(store_counts, "master_area_no").select(
        label,
        "master_area_no",
        "master_area_name",
        "visits",
        half_up(F.try_divide(F.col("visits"), F.col("cnt")) * 100, 4).alias("ratio"),
    )


def preference_share(
    df: DataFrame, columns: Iterable[str] = ("weekday", "weekend"), label: str = "label"
) -> DataFrame:
    """Members per group that prefer each kind of day, and the share of the preferences."""
    columns = list(columns)
    sums = df.groupBy(label).agg(*[F.sum(F.col(c).cast("long")).alias(c) for c in columns])
    total: Column = reduce(lambda a, b: a + b, [F.col(c) for c in columns])
    long = sums.withColumn("total", total).unpivot([label, "total"], columns, "preference", "cnt")
    return long.select(
        label,
        "preference",
        "cnt",
        half_up(F.try_divide(100.0 * F.col("cnt"), F.col("total")), 2).alias("pct"),
    )


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: missing values per column."""
    return df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in columns])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))


def histogram(
    df: DataFrame, column: str, bins: int, by: str | None = None, density: bool = True
) -> DataFrame:
    """Equal-width bins between minimum and maximum (per group), the maximum in the last bin.

    ``density`` divides each count by rows x width.
    """
    keys = [by] if by else []
    value = F.col(column).cast("double")
    values = df.select(*keys, value.alias("v")).filter(F.col("v").isNotNull())
    # Distinct values are fewer than rows and carry their counts through the join; written once, as
    # bounds and bins both read them.
    counts = materialize(values.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n")))
    bounds = counts.groupBy(*keys).agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("n").alias("total")
    )
    joined = counts.join(small(bounds), keys) if keys else counts.crossJoin(F.broadcast(bounds))
    width = (F.col("hi") - F.col("lo")) / bins
    bucket = F.when(F.col("hi") == F.col("lo"), 0).otherwise(
        F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("lo")) / width).cast("int"))
    )
    out = joined.groupBy(*keys, "lo", "hi", "total", bucket.alias("bin")).agg(F.sum("n").alias("cnt"))
    columns = [*keys, "bin", "cnt", half_up(F.col("lo") + F.col("bin") * width, 4).alias("bin_lo")]
    if density:
        columns.append(
            half_up(F.try_divide(F.col("cnt"), F.col("total") * width), 4).alias("density")
        )
    return out.select(*columns)


def run_summary(df: DataFrame, parameters: dict[str, str], label: str = "label") -> DataFrame:
    """Group sizes and shares, with the parameters of the run on every row."""
    sizes = group_size(df, label)
    total = sizes.agg(F.sum("cnt").alias("data_length"))
    return sizes.crossJoin(F.broadcast(total)).select(  # one row by construction (global aggregate)
        *[F.lit(value).alias(name) for name, value in parameters.items()], "data_length", label, "cnt", "pct"
    )
