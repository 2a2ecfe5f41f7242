"""Exact quantiles per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import materialize

#: Relative error of the sketch is one in so many; brackets reach further to either side, in shares of the rows.
ACCURACY = 10_000
MARGIN = 0.001
#: Below so many rows a rank's place in the sketch and in the group may differ by more than the margin.
SMALL_GROUP = 4096
#: Wanted ranks that are broadcast; more join their rows by a shuffle.
TARGET_ROWS = 100_000


def exact_quantiles(
    df: DataFrame,
    groups: list[str],
    columns: list[str],
    probs: list[float],
    exact_limit: int = 100_000,
    small_group: int = SMALL_GROUP,
) -> DataFrame:
    """Linearly interpolated quantiles as rows ``(groups, column, prob, value)``.

    If no group is above ``exact_limit`` rows, the built-in exact aggregate does it.  Otherwise a mergeable
    sketch per group and column brackets each wanted rank, and a second aggregate counts the distinct values
    inside the brackets and picks the rank; groups of up to ``small_group`` rows are counted whole.  Nothing
    is collected, whatever the number of groups.  NaN counts as missing, and null is a group.
    """
    known = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in columns]
    numeric = df.select(*groups, *known)
    largest = numeric.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    if (largest or 0) <= exact_limit:
        per_column = F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(f"q{i}").alias("q"))
                for i, c in enumerate(columns)
            ]
        )
        return (
            numeric.groupBy(*groups)
            .agg(*[F.percentile(c, wanted).alias(f"q{i}") for i, c in enumerate(columns)])
            .select(*groups, F.explode(per_column).alias("c"))
            .filter(F.col("c.q").isNotNull())
            .select(
                *groups, "c.column", F.explode(F.arrays_zip(wanted.alias("prob"), F.col("c.q").alias("q"))).alias("z")
            )
            .select(*groups, "column", F.col("z.prob").alias("prob"), F.col("z.q").alias("value"))
        )
    long = numeric.unpivot(groups, columns, "column", "value").filter(F.col("value").isNotNull())
    return _by_sketch(long, [*groups, "column"], probs, small_group)


def _by_sketch(long: DataFrame, keys: list[str], probs: list[float], small_group: int) -> DataFrame:
    """Two aggregates: a sketch per key brackets the ranks, and counts of the values inside select them."""
    fractions = [max(0.0, p - MARGIN) for p in probs] + [min(1.0, p + MARGIN) for p in probs]
    sketch = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
        F.percentile_approx("value", fractions, ACCURACY).alias("cut"),
    )
    few = F.col("n") <= small_group

    def target(i: int, p: float):
        low = F.col("least") if p <= MARGIN else F.when(few, F.col("least")).otherwise(F.col("cut")[i])
        high = F.col("most") if p >= 1 - MARGIN else F.when(few, F.col("most")).otherwise(F.col("cut")[len(probs) + i])
        return F.struct(F.lit(float(p)).alias("prob"), low.alias("lo"), high.alias("hi"))

    every = F.explode(F.array(*[target(i, p) for i, p in enumerate(probs)])).alias("t")
    position = F.col("t.prob") * (F.col("n") - 1)
    targets = materialize(
        sketch.select(*keys, "n", "least", "most", every).select(
            *keys, "least", "most", "t.*", position.alias("position"), F.floor(position).alias("first"), F.ceil(position).alias("second")
        )
    )
    found = materialize(_selected(long, targets, keys))
    here = [F.col(f"_t_{k}").eqNullSafe(F.col(k)) for k in [*keys, "prob"]]
    # The sketch keeps its promise or these ranks are sought among all rows of their key.
    missed = targets.join(found.select(*[F.col(k).alias(f"_t_{k}") for k in [*keys, "prob"]]), here, "left_anti")
    if missed.limit(1).count():
        again = materialize(missed.withColumn("lo", F.col("least")).withColumn("hi", F.col("most")))
        found = found.unionByName(_selected(long, again, keys))
    part = F.col("position") - F.floor("position")
    between = F.col("low") + (F.col("high") - F.col("low")) * part
    exact = (part == 0) | (F.col("low") == F.col("high"))
    return found.select(*keys, "prob", F.when(exact, F.col("low")).otherwise(between).alias("value"))


def _selected(long: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, prob, position, low, high)``: the values at the two ranks of each target whose bracket holds them.

    Only distinct values inside a bracket are sorted, with what lies below as one number.
    """
    named = targets.select(*[F.col(k).alias(f"_t_{k}") for k in keys], "prob", "lo", "hi", "position", "first", "second")
    if targets.limit(TARGET_ROWS + 1).count() <= TARGET_ROWS:
        named = F.broadcast(named)
    hit = long.join(named, [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys]).filter(F.col("value") <= F.col("hi"))
    inside = F.when(F.col("value") >= F.col("lo"), F.col("value")).alias("inside")
    rank = [*keys, "prob", "position", "first", "second"]
    counts = hit.groupBy(*rank, inside).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(*rank).orderBy(F.col("inside").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    upto = counts.withColumn("upto", F.sum("n").over(order)).filter("inside is not null")
    at = lambda r: F.min(F.when((F.col("upto") > F.col(r)) & (F.col("upto") - F.col("n") <= F.col(r)), F.col("inside")))
    both = upto.groupBy(*rank).agg(at("first").alias("low"), at("second").alias("high"))
    return both.filter("low is not null and high is not null").select(*keys, "prob", "position", "low", "high")
