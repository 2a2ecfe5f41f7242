"""Clusters, embeddings and classes of product names."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    HashingTF,
    Normalizer,
    StringIndexer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import text
from tillroll.session import materialize

MAX_WEIGHT_VALUES = 8_000_000  # numbers in a broadcast weight matrix: 64 MB


def name_clusters(
    df: DataFrame,
    k: int,
    category: str = "category",
    name: str = "item_name",
    tokens: str = "tokens",
    max_iter: int = 100,
) -> DataFrame:
    """Cluster the names of every category by their similarity profile: ``(category, name, cluster)``.

    The profile of a name is its row of cosines with all names of the category, and the clusters are
    those of K-means on the profiles, from the first ``k`` names in order.  No profile is ever built:
    with unit rows ``X`` the distance of ``x`` to a centre ``c`` is ``(x - c) X'X (x - c)``, which needs
    the sums ``X c`` and ``X'(X c)`` only.  All categories run in the same jobs; a round is a few
    aggregates over the cells of ``X``, and a category may be of any size.  Tokens of one character are
    left out; a name without any other has the zero profile.  Equal distances go to the smaller cluster.
    """
    names = materialize(df.select(F.col(category).alias("cat"), F.col(name).alias("name")).distinct())
    long_tokens = F.explode(F.filter(tokens, lambda t: F.length(t) > 1)).alias("token")
    one = df.dropDuplicates([category, name]).select(F.col(category).alias("cat"), F.col(name).alias("name"), long_tokens)
    counts = one.groupBy("cat", "name", "token").agg(F.count(F.lit(1)).alias("c"))
    norms = counts.groupBy("cat", "name").agg(F.sqrt(F.sum(F.col("c") * F.col("c"))).alias("norm"))
    cells = materialize(
        counts.join(norms, ["cat", "name"]).select("cat", "name", "token", (F.col("c") / F.col("norm")).alias("x"))
    )
    in_order = Window.partitionBy("cat").orderBy("name")
    first = names.withColumn("label", F.row_number().over(in_order) - 1).filter(F.col("label") < k)
    centres = materialize(cells.join(first, ["cat", "name"]).select("cat", "label", "token", F.col("x").alias("c")))
    grid = materialize(first.select("cat", "label"))  # at most k rows a category
    labels = None
    for _ in range(max_iter + 1):
        fresh = materialize(_nearest_profiles(names, cells, centres, grid))
        if labels is not None:
            moved = fresh.withColumnRenamed("label", "now").join(labels, ["cat", "name"]).filter("now <> label")
            if not moved.limit(1).count():
                break
        labels = fresh
        centres = materialize(_mean_profiles(cells, labels, centres))
    return labels.select(F.col("cat").alias(category), F.col("name").alias(name), F.col("label").alias("cluster"))


def _nearest_profiles(names: DataFrame, cells: DataFrame, centres: DataFrame, grid: DataFrame) -> DataFrame:
    """``(cat, name, label)``: the centre with the nearest profile."""
    near = cells.join(centres, ["cat", "token"]).groupBy("cat", "name", "label").agg(
        F.sum(F.col("x") * F.col("c")).alias("s")
    )
    near = materialize(near)
    squares = near.groupBy("cat", "label").agg(F.sum(F.col("s") * F.col("s")).alias("q"))
    through = cells.join(near, ["cat", "name"]).groupBy("cat", "token", "label").agg(
        F.sum(F.col("x") * F.col("s")).alias("p")
    )
    product = cells.join(through, ["cat", "token"]).groupBy("cat", "name", "label").agg(
        F.sum(F.col("x") * F.col("p")).alias("d")
    )
    zero = F.lit(0.0)
    distance = F.round(F.coalesce("q", zero) - 2 * F.coalesce("d", zero), 9)
    return (
        names.join(grid.join(squares, ["cat", "label"], "left"), "cat")
        .join(product, ["cat", "name", "label"], "left")
        .groupBy("cat", "name")
        .agg(F.min_by("label", F.struct(distance.alias("gap"), "label")).alias("label"))
    )


def _mean_profiles(cells: DataFrame, labels: DataFrame, centres: DataFrame) -> DataFrame:
    """New centres ``(cat, label, token, c)``; a cluster without names keeps its centre."""
    sizes = labels.groupBy("cat", "label").agg(F.count(F.lit(1)).alias("n"))
    sums = cells.join(labels, ["cat", "name"]).groupBy("cat", "label", "token").agg(F.sum("x").alias("x"))
    means = sums.join(sizes, ["cat", "label"]).select("cat", "label", "token", (F.col("x") / F.col("n")).alias("c"))
    return means.unionByName(centres.join(sizes, ["cat", "label"], "left_anti"))


def char_grams(col: F.Column, n: int = 2) -> F.Column:
    """Character n-grams of the cleaned, lower-cased text; short texts are one gram."""
    cleaned = F.lower(text.clean(col))
    grams = F.transform(
        F.sequence(F.lit(1), F.length(cleaned) - (n - 1)), lambda i: F.substring(cleaned, i, F.lit(n))
    )
    return F.when(F.length(cleaned) >= n, grams).otherwise(F.array(cleaned))


class TextVectors:
    """Hashed, inverse-frequency weighted character grams as unit vectors of fixed length."""

    def __init__(self, dims: int = 256, n: int = 2):
        self.dims, self.n = dims, n
        self.model: PipelineModel | None = None

    def _grams(self, df: DataFrame, column: str) -> DataFrame:
        return df.withColumn("_grams", char_grams(F.col(column), self.n))

    def fit(self, df: DataFrame, column: str) -> TextVectors:
        stages = [
            HashingTF(inputCol="_grams", outputCol="_tf", numFeatures=self.dims),
            IDF(inputCol="_tf", outputCol="_idf"),
            Normalizer(inputCol="_idf", outputCol="_unit"),
        ]
        self.model = Pipeline(stages=stages).fit(self._grams(df, column))
        return self

    def transform(self, df: DataFrame, column: str, out: str = "vector") -> DataFrame:
        vectors = self.model.transform(self._grams(df, column))
        return vectors.withColumn(out, vector_to_array("_unit", "float32")).drop(
            "_grams", "_tf", "_idf", "_unit"
        )


def gram_counts(df: DataFrame, key: str, name: str) -> DataFrame:
    """Unigrams and bigrams of every distinct key with their counts."""
    grams = text.with_bigrams(text.name_tokens(F.col(name)))
    return (
        df.select(key, F.explode(grams).alias("gram"))
        .groupBy(key, "gram")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def frequency_weights(df: DataFrame, name: str, label: str, classes: list[int]) -> DataFrame:
    """Class weights of every gram: the share of its occurrences in each class."""
    grams = text.with_bigrams(text.name_tokens(F.col(name)))
    counts = (
        df.select(label, F.explode(grams).alias("gram"))
        .groupBy("gram", label)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_class = [F.coalesce(F.sum(F.when(F.col(label) == c, F.col("n"))), F.lit(0)) for c in classes]
    total = F.sum("n").cast("double")
    return counts.groupBy("gram").agg(F.array(*[x / total for x in per_class]).alias("weights"))


def classify_names(
    names: DataFrame,
    weights: DataFrame,
    n_classes: int,
    name: str = "product",
    bias: list[float] | None = None,
    unknown: list[float] | None = None,
    max_values: int = MAX_WEIGHT_VALUES,
) -> DataFrame:
    """Class with the best score for every distinct name: ``(name, class_no, score)``.

    The score of a class is the mean weight over the grams of the name plus the bias.  ``weights``
    has one row per gram with one weight per class; grams without a row take ``unknown``.  A name
    without grams is scored by the bias alone.  Classes are numbered from 1 and ties go to the smaller
    number.

    The weights are a matrix whose size is counted; names are scored where they are, in Arrow batches.
    A larger matrix is cut into blocks of grams, whose sums per name are added up.
    """
    distinct = names.select(name).distinct()
    own = F.coalesce(text.with_bigrams(text.name_tokens(F.col(name))), F.array().cast("array<string>"))
    grams = distinct.select(name, own.alias("grams"))
    n_blocks = max(1, -(-weights.count() * n_classes // max_values))
    block = F.pmod(F.xxhash64("gram"), F.lit(n_blocks))
    sums = [
        _block_sums(grams, weights.filter(block == b) if n_blocks > 1 else weights, n_classes, name)
        for b in range(n_blocks)
    ]
    if n_blocks == 1:
        summed = sums[0]
    else:
        cells = reduce(DataFrame.unionAll, sums).select(name, "n", "known", F.posexplode("sums").alias("c", "x"))
        per_class = cells.groupBy(name, "n", "c").agg(F.sum("known").alias("known"), F.sum("x").alias("x"))
        in_order = F.sort_array(F.collect_list(F.struct("c", "x")))
        summed = per_class.groupBy(name, "n", "known").agg(F.transform(in_order, lambda s: s["x"]).alias("sums"))
    per_unknown, start = F.lit(unknown or [0.0] * n_classes), F.lit(bias or [0.0] * n_classes)

    def score(total: F.Column, i: F.Column) -> F.Column:
        mean = (total + (F.col("n") - F.col("known")) * F.get(per_unknown, i)) / F.col("n")
        return F.when(F.col("n") > 0, mean).otherwise(0.0) + F.get(start, i)

    ranked = F.transform(
        F.transform("sums", score), lambda s, i: F.struct(F.round(s, 9).alias("score"), (-i).alias("minus"))
    )
    return summed.withColumn("_best", F.array_max(ranked)).select(
        name, (1 - F.col("_best.minus")).alias("class_no"), F.col("_best.score").alias("score")
    )


def _block_sums(grams: DataFrame, weights: DataFrame, n_classes: int, name: str) -> DataFrame:
    """Sums of the weights of a counted block: ``(name, n, known, sums)``, one row per name."""
    local = weights.select("gram", "weights").toPandas()
    matrix = np.array(local["weights"].tolist(), float).reshape(len(local), n_classes)
    held = grams.sparkSession.sparkContext.broadcast(({g: i for i, g in enumerate(local["gram"])}, matrix))

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, values = held.value
        for b in batches:
            rows = [[place[g] for g in own if g in place] for own in b["grams"]]
            yield pd.DataFrame(
                {
                    name: b[name],
                    "n": b["grams"].map(len),
                    "known": [len(r) for r in rows],
                    "sums": [values[r].sum(0) for r in rows],
                }
            )

    return grams.mapInPandas(add, f"`{name}` string, n long, known long, sums array<double>")


def train_classifier(
    df: DataFrame, name: str, label: str, max_iter: int = 20, vocabulary: int | None = None
) -> PipelineModel:
    """Linear classifier over the mean of the gram vectors of a name.

    All grams have a vector; ``vocabulary`` keeps only the most frequent ones on request.  Grams are made
    once and written, as the fits read them several times.
    """
    rows = materialize(with_grams(df.select(name, label), name))
    if vocabulary is None:
        grams = rows.select(F.explode("_grams").alias("g"))
        vocabulary = max(1, grams.agg(F.count_distinct("g")).first()[0])
    stages = [
        StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc"),
        CountVectorizer(inputCol="_grams", outputCol="_counts", vocabSize=vocabulary),
        Normalizer(inputCol="_counts", outputCol="_mean", p=1.0),
        LogisticRegression(
            featuresCol="_mean", labelCol="_label", maxIter=max_iter, family="multinomial"
        ),
    ]
    return Pipeline(stages=stages).fit(rows)


def with_grams(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("_grams", text.with_bigrams(text.name_tokens(F.col(name))))


def model_weights(model: PipelineModel, spark) -> tuple[DataFrame, list[float], list[str]]:
    """Gram weights, bias and class names of a trained classifier, for ``classify_names``."""
    vocabulary = model.stages[1].vocabulary
    linear = model.stages[-1]
    matrix = linear.coefficientMatrix.toArray()
    rows = [(g, [float(x) for x in matrix[:, i]]) for i, g in enumerate(vocabulary)]
    table = spark.createDataFrame(rows, "gram string, weights array<double>")
    return table, [float(x) for x in linear.interceptVector], list(model.stages[0].labels)
