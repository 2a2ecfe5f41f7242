"""Checks and reports on names, categories and tags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.text import contains_any, starts_with_any
from tillroll.operators.ranking import dense_index
from tillroll.session import materialize

# Words that mark delivery fees, platform fees, tips and rest categories.
FEE_WORDS = ["外送費", "外送員小費", "平台費"]
REST_WORD = "其他"
# End of fixed values.


def two_way_difference(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Values found on one side only, per column: rows ``(side, column, value)``.

    One aggregate over both sides; repeats of a value are reduced before the exchange.
    """
    sides = [
        d.select(F.lit(i).alias("is_right"), *[F.col(c).cast("string").alias(c) for c in columns])
        for i, d in enumerate((left, right))
    ]
    return (
        sides[0]
        .unionAll(sides[1])
        .unpivot(["is_right"], columns, "column", "value")
        .groupBy("column", "value")
        .agg(F.min("is_right").alias("first"), F.max("is_right").alias("last"))
        .filter(F.col("first") == F.col("last"))
        .select(F.when(F.col("first") == 0, "left").otherwise("right").alias("side"), "column", "value")
    )


def without_noise(
    df: DataFrame,
    name: str = "item_name",
    category: str | None = "category",
    prefix_only: bool = False,
) -> DataFrame:
    """Drop fee rows and rest categories."""
    test = starts_with_any if prefix_only else contains_any
    kept = df.filter(~test(F.col(name), FEE_WORDS))
    return kept.filter(~F.col(category).contains(REST_WORD)) if category else kept


def count_dedup(
    df: DataFrame, by: list[str], name: str = "item_name", global_first: bool = False
) -> DataFrame:
    """Rows and distinct names per group.

    With ``global_first`` a name that occurs in several groups counts only in the smallest one.
    """
    counts = df.groupBy(*by).agg(
        F.count(name).alias("item_name"), F.count_distinct(name).alias("item_name_dedupe")
    )
    if not global_first:
        return counts
    owners = (
        df.groupBy(name)
        .agg(F.min(F.struct(*by)).alias("owner"))
        .groupBy("owner")
        .agg(F.count(F.lit(1)).alias("item_name_dedupe"))
        .select("owner.*", "item_name_dedupe")
    )
    return counts.drop("item_name_dedupe").join(owners, by, "left")


def rows_of_rare_groups(df: DataFrame, by: list[str], column: str, below: int = 10) -> DataFrame:
    """Rows whose ``column`` occurs in a group with fewer than ``below`` rows."""
    rare = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < below)
    return df.join(rare.select(column).distinct(), column, "left_semi")


def cardinalities(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """One row: distinct values per column."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(c).alias(c) for c in columns])


def hash_order(key: str) -> Column:
    """A fixed pseudo-random order of the rows."""
    return F.md5(F.col(key).cast("string"))


def fixed_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows, the same ones in every run."""
    return df.orderBy(hash_order(key), key).limit(n)


def fraction_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """About ``fraction`` of the keys, the same ones in every run; null keys are never drawn."""
    return hash_split(df, key, fraction).filter("is_test").drop("is_test")


def draws(df: DataFrame, key: str, n: int, seed: str = "draw") -> DataFrame:
    """``n`` single draws with replacement: rows ``(draw, *columns)``, the same ones in every run.

    Distinct keys are numbered, and the hash of a draw's number picks a position.  Null keys are never
    drawn; of several rows with one key, one stands for all.
    """
    known = df.filter(F.col(key).isNotNull()).dropDuplicates([key])
    numbered = dense_index(known.withColumn("all", F.lit(0)), "all", key, "place").select(
        F.col(key).alias("drawn_key"), "place"
    )
    total = numbered.agg(F.count(F.lit(1)).alias("total"))
    digest = F.md5(F.concat(F.lit(f"{seed}-"), F.col("draw").cast("string")))
    place = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.col("total"))
    wanted = (
        df.sparkSession.range(n)
        .withColumnRenamed("id", "draw")
        .crossJoin(F.broadcast(total))  # one row by construction (global aggregate)
        .filter("total > 0")
        .select("draw", place.cast("int").alias("place"))
    )
    found = wanted.join(numbered, "place").select("draw", "drawn_key")
    return found.join(known, F.col("drawn_key") == F.col(key)).drop("drawn_key")


def all_of(*lists: DataFrame) -> DataFrame:
    """Values of several one-column lists, each once."""
    return reduce(DataFrame.unionAll, lists).distinct()


def stratified_sample(df: DataFrame, by: str, name: str, n: int = 4) -> DataFrame:
    """``n`` distinct names per category, the same ones in every run."""
    names = df.select(by, name).distinct()
    order = Window.partitionBy(by).orderBy(hash_order(name), name)
    return (
        names.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n).drop("rank")
    )


def hash_split(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """Add ``is_test``: true for about ``fraction`` of the keys, the same ones in every run."""
    position = F.conv(F.substring(hash_order(key), 1, 8), 16, 10).cast("double") / float(2**32)
    return df.withColumn("is_test", position < fraction)


def sample_lists(df: DataFrame, category: str, items: list[str]) -> DataFrame:
    """Trimmed, non-null samples of every category as a list; rest categories are skipped."""
    samples = F.array_compact(F.array(*[F.trim(F.col(i)) for i in items]))
    return df.filter(~F.col(category).contains(REST_WORD)).select(
        category, samples.alias("samples")
    )


def reference_samples(given: DataFrame, generated: DataFrame) -> DataFrame:
    """Given and generated samples as rows, with the text that combines category and sample."""
    rows = [
        d.select("category", F.explode("samples").alias("sample"), F.lit(i).alias("generated"))
        for i, d in enumerate((given, generated))
    ]
    both = rows[0].unionByName(rows[1])
    return both.withColumn("cs", F.concat_ws("-", "category", "sample"))


def tag_counter(df: DataFrame, tags: str, above: int = 1) -> DataFrame:
    """Tags that occur more than ``above`` times."""
    return (
        df.select(F.explode(tags).alias("tag"))
        .groupBy("tag")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .filter(F.col("cnt") > above)
    )


def allowed_tags(df: DataFrame, key: str, tags: str, allowed: DataFrame) -> DataFrame:
    """Tags of every row that are in ``allowed(tag)``, in their order; others are dropped."""
    kept = (
        df.select(key, F.posexplode(tags).alias("pos", "tag"))
        .join(allowed.select("tag").distinct(), "tag", "left_semi")
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct("pos", "tag"))).alias("kept"))
        .select(key, F.transform("kept", lambda x: x["tag"]).alias("kept_tags"))
    )
    return df.join(kept, key, "left").withColumn(
        "kept_tags", F.coalesce("kept_tags", F.array().cast("array<string>"))
    )


def similar_names(df: DataFrame, by: str, name: str, tokens: str, threshold: float) -> DataFrame:
    """Pairs of different names of a category whose token counts have cosine >= ``threshold``.

    Names with equal token counts are one row, the smallest name with the number of names it stands
    for.  Tokens are ordered from rare to frequent, and
    two names can only reach the threshold if they share a token of both prefixes, a prefix ending
    where the norm of the rest falls below the threshold; frequent tokens stay outside it.
    """
    distinct = df.select(by, name, F.col(tokens).alias("t")).dropDuplicates([by, name])
    names = distinct.select(by, name, F.explode("t").alias("token")).filter(F.length("token") > 1)
    counts = names.groupBy(by, name, "token").agg(F.count(F.lit(1)).alias("c"))
    frequency = counts.groupBy(by, "token").agg(F.count(F.lit(1)).alias("df"))
    vector = (
        counts.join(frequency, [by, "token"])
        .groupBy(by, name)
        .agg(F.sort_array(F.collect_list(F.struct("df", "token", "c"))).alias("v"))
        .groupBy(by, "v")
        .agg(F.min(name).alias(name), F.count(F.lit(1)).alias("names"))
    )
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x["c"] * x["c"])
    unit = vector.withColumn("norm", F.sqrt(square)).withColumn(
        "weights",
        F.map_from_entries(
            F.transform("v", lambda x: F.struct(x["token"], (x["c"] / F.col("norm")).alias("w")))
        ),
    )
    # Square norm of the tokens from a position on; a token is in the prefix while it is enough.
    rest = F.transform(
        "v",
        lambda x, i: F.struct(
            x["token"].alias("token"),
            F.aggregate(
                F.slice("v", i + 1, F.size("v")), F.lit(0.0), lambda a, y: a + y["c"] * y["c"]
            ).alias("rest"),
        ),
    )
    limit = (threshold * threshold - 1e-9) * F.col("norm") * F.col("norm")
    prefix = F.transform(F.filter(rest, lambda x: x["rest"] >= limit), lambda x: x["token"])
    # Only names and their short prefixes meet; a pair counts at the first token that both prefixes share.
    vectors = materialize(unit.withColumn("prefix", prefix).select(by, name, "names", "weights", "prefix"))
    side = vectors.select(by, F.explode("prefix").alias("token"), name, "prefix")
    left = side.withColumnsRenamed({name: "name_a", "prefix": "prefix_a"})
    right = side.withColumnsRenamed({name: "name_b", "prefix": "prefix_b"})
    first_shared = F.get(F.array_intersect("prefix_a", "prefix_b"), 0)
    pairs = (
        left.join(right, [by, "token"])
        .filter((F.col("name_a") < F.col("name_b")) & (first_shared == F.col("token")))
        .select(by, "name_a", "name_b")
    )
    dot = F.aggregate(
        F.map_entries("wa"),
        F.lit(0.0),
        lambda a, e: a + e["value"] * F.coalesce(F.col("wb")[e["key"]], F.lit(0.0)),
    )

    def known(letter: str) -> DataFrame:
        return vectors.select(
            by, F.col(name).alias(f"name_{letter}"), F.col("names").alias(f"names_{letter}"), F.col("weights").alias(f"w{letter}")
        )

    return (
        pairs.join(known("a"), [by, "name_a"])
        .join(known("b"), [by, "name_b"])
        .withColumn("cosine", dot)
        .filter(F.col("cosine") >= threshold - 1e-9)
        .select(by, "name_a", "name_b", "names_a", "names_b", "cosine")
    )
