"""Keyword mining: token counts, top lists, keyword dictionaries and their use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import materialize

#: Characters of a gram by which keywords are looked up.
GRAM = 3
#: An index of keywords below these bounds is broadcast; names then stay where they are.
INDEX_ROWS, INDEX_BYTES = 500_000, 1 << 25


def token_count(df: DataFrame, tokens: str, by: list[str]) -> DataFrame:
    """Occurrences of every token per group, every row counted once."""
    return (
        df.select(*by, F.explode(tokens).alias("token"))
        .groupBy(*by, "token")
        .agg(F.count(F.lit(1)).alias("num"))
    )


def token_count_weighted(df: DataFrame, tokens: str, units: str, by: list[str]) -> DataFrame:
    """Occurrences of every token per group, every row counted ``units`` times."""
    return (
        df.filter(F.col(units) > 0)
        .select(*by, units, F.explode(tokens).alias("token"))
        .groupBy(*by, "token")
        .agg(F.sum(F.col(units).cast("long")).alias("num"))
    )


def top_n(df: DataFrame, by: list[str], n: int, num: str = "num", name: str = "token") -> DataFrame:
    """The ``n`` most frequent names per group with their rank; ties go by name.

    The rank limit is applied before the exchange too, so a hot group ships ``n`` rows per task.
    """
    order = Window.partitionBy(*by).orderBy(F.desc(num), F.asc(name))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def clusters_wide(
    top: DataFrame, by: list[str], clusters: int, n: int, cluster: str = "cluster"
) -> DataFrame:
    """Top lists side by side: ``clusterName_j, clusterNum_j`` per cluster, one row per rank.

    Short lists are padded with nulls up to ``n`` rows.
    """
    ranks = top.select(*by).distinct().withColumn(
        "rank", F.explode(F.sequence(F.lit(1), F.lit(n)))
    )
    columns: list[Column] = []
    for j in range(clusters):
        here = F.col(cluster) == j
        columns.append(F.max(F.when(here, F.col("token"))).alias(f"clusterName_{j}"))
        columns.append(F.max(F.when(here, F.col("num"))).alias(f"clusterNum_{j}"))
    wide = top.groupBy(*by, "rank").agg(*columns)
    return ranks.join(wide, [*by, "rank"], "left")


def merge_ranks(wide: DataFrame, by: str, clusters: int) -> DataFrame:
    """Sum the counts of every keyword over the clusters of its category."""
    pairs = F.array(
        *[
            F.struct(F.col(f"clusterName_{j}").alias("name"), F.col(f"clusterNum_{j}").alias("num"))
            for j in range(clusters)
        ]
    )
    return (
        wide.select(by, F.explode(pairs).alias("p"))
        .filter(F.col("p.name").isNotNull())
        .groupBy(by, F.col("p.name").alias("name"))
        .agg(F.sum("p.num").alias("num"))
    )


def dictionary_wide(ranked: DataFrame, by: str, categories: list[str], n: int) -> DataFrame:
    """Wide keyword dictionary: ``<category>_key, <category>_no`` per category, one row per rank."""
    top = top_n(ranked, [by], n, name="name")
    columns = []
    for category in categories:
        here = F.col(by) == category
        safe = category.replace("/", "_")
        columns.append(F.max(F.when(here, F.col("name"))).alias(f"{safe}_key"))
        columns.append(F.max(F.when(here, F.col("num"))).alias(f"{safe}_no"))
    return top.groupBy("rank").agg(*columns)


def dictionary_long(wide: DataFrame, categories: list[str]) -> DataFrame:
    """Rows ``(category, name, num)`` of a wide keyword dictionary."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("category"),
                F.col(f"{c.replace('/', '_')}_key").alias("name"),
                F.col(f"{c.replace('/', '_')}_no").cast("long").alias("num"),
            )
            for c in categories
        ]
    )
    return wide.select(F.explode(pairs).alias("p")).select("p.*").filter(F.col("name").isNotNull())


def _pieces(col: Column, size: int) -> Column:
    """Distinct substrings of ``size`` characters; the empty one for 0."""
    return F.array_distinct(F.regexp_extract_all(col, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)))


def keyword_index(keywords: DataFrame, by: str = "category", size: int = GRAM) -> DataFrame:
    """Every keyword under its rarest gram: rows ``(by, gram, name, num)``, written once.

    A gram has ``size`` characters, or all of a shorter keyword.  A text that holds a keyword holds all its
    grams, so one of them is enough to look the keyword up; the rarest one meets the fewest names.  How
    often a gram occurs is told by the counts of the keywords that hold it.
    """
    own = keywords.filter(F.col("name").isNotNull()).select(by, "name", "num").distinct()
    grams = F.when(F.length("name") < size, F.array("name")).otherwise(_pieces(F.col("name"), size))
    held = F.sum("num").over(Window.partitionBy(by, "gram"))
    entries = own.withColumn("gram", F.explode(grams)).withColumn("held", held)
    rarest = F.min_by("gram", F.struct("held", "gram")).alias("gram")
    return materialize(entries.groupBy(by, "name", "num").agg(rarest))


def match_keywords(
    products: DataFrame,
    keywords: DataFrame,
    n: int = 5,
    key: str = "product",
    by: str = "category",
    size: int = GRAM,
) -> DataFrame:
    """The ``n`` most frequent keywords of the class that occur in each product name.

    ``products`` has ``(key, by)``, ``keywords`` has ``(by, name, num)``; repeated rows count once, and
    products without a match keep an empty list.  Names are cut into grams and meet, through an index of the
    keywords by class and rarest gram, only keywords that share that gram; what they meet is verified.  The
    join key is ``(class, gram)``, so a hot class is many keys.
    """
    names = products.select(key, by).distinct()
    index = keyword_index(keywords, by, size)
    # One row: how large the index is, and which of the size + 1 lengths its grams have.
    entry_bytes = F.octet_length("name") + F.octet_length(F.col(by).cast("string"))
    n_entries, n_bytes, sizes = index.agg(
        F.count(F.lit(1)), F.sum(entry_bytes), F.sort_array(F.collect_set(F.length("gram")))
    ).first()
    if n_entries <= INDEX_ROWS and (n_bytes or 0) <= INDEX_BYTES:
        index = F.broadcast(index)
    pieces = F.concat(*[_pieces(F.col(key), s) for s in sizes]) if sizes else F.array().cast("array<string>")
    met = names.withColumn("gram", F.explode(pieces)).join(index, [by, "gram"])
    entry = F.struct((-F.col("num")).alias("minus_num"), F.col("name"))
    hits = met.filter(F.col(key).contains(F.col("name"))).groupBy(key, by).agg(
        F.slice(F.sort_array(F.collect_list(entry)), 1, n).alias("hits")
    )
    found = names.join(hits, [key, by], "left")
    listed = F.transform("hits", lambda e: e["name"])
    return found.select(key, by, F.coalesce(listed, F.array().cast("array<string>")).alias("keywords"))


def fan_out(df: DataFrame, n: int = 5, column: str = "keywords") -> DataFrame:
    """``keyword_1 .. keyword_n`` from a list, null where the list is shorter."""
    return df.withColumns(
        {f"keyword_{i + 1}": F.get(F.col(column), i) for i in range(n)}
    ).drop(column)
