"""Supervised models and projections over vectors."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import (
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_vectors(df: DataFrame, array: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(array).cast("array<double>")))


def forest(train: DataFrame, test: DataFrame, label: str = "label", trees: int = 20, depth: int = 5, seed: int = 50):
    """Predictions of a random forest, and the importance of every feature."""
    model = RandomForestClassifier(
        labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, predictionCol="predicted"
    ).fit(train)
    rows = [(i, float(x)) for i, x in enumerate(model.featureImportances.toArray())]
    importance = train.sparkSession.createDataFrame(rows, "feature int, importance double")
    return model.transform(test).drop("rawPrediction", "probability"), importance


def perceptron(train: DataFrame, test: DataFrame, layers: list[int], label: str = "label", max_iter: int = 50, seed: int = 50):
    """Predictions of a feed-forward network; ``layers`` are sizes from input to output."""
    model = MultilayerPerceptronClassifier(
        layers=layers, labelCol=label, maxIter=max_iter, seed=seed, predictionCol="predicted"
    ).fit(train)
    return model.transform(test).drop("rawPrediction", "probability")


def project_2d(df: DataFrame, features: str = "features", cosine: bool = True) -> DataFrame:
    """Two linear coordinates ``x, y``; with ``cosine`` the vectors are scaled to length 1 first.

    The directions are the two leading ones of the covariance, a small matrix of the features; the
    sign is fixed by the largest component.
    """
    unit = Normalizer(inputCol=features, outputCol="_unit").transform(df) if cosine else (
        df.withColumn("_unit", F.col(features))
    )
    covariance = row_matrix(unit, "_unit").computeCovariance().toArray()
    _, vectors = np.linalg.eigh(covariance)
    axes = vectors[:, ::-1][:, :2]
    axes = axes * np.where(axes[np.abs(axes).argmax(0), [0, 1]] < 0, -1.0, 1.0)

    def dot(weights: np.ndarray):
        terms = F.zip_with("_array", F.lit([float(w) for w in weights]), lambda a, b: a * b)
        return F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)

    return (
        unit.withColumn("_array", vector_to_array("_unit"))
        .withColumns({"x": dot(axes[:, 0]), "y": dot(axes[:, 1])})
        .drop("_unit", "_array")
    )


def row_matrix(df: DataFrame, column: str) -> RowMatrix:
    """The vectors of a column as a distributed matrix."""
    return RowMatrix(MLUtils.convertVectorColumnsFromML(df.select(column), column))
