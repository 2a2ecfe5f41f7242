"""Quality of predictions; ``actual`` and ``predicted`` are column names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.session import materialize


def accuracy(df: DataFrame, actual: str, predicted: list[str]) -> DataFrame:
    """Accuracy per prediction column over its non-null rows, with the number of nulls."""
    parts = [
        F.struct(
            F.lit(p).alias("prediction"),
            F.avg((F.col(actual) == F.col(p)).cast("double")).alias("accuracy"),
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col(p).isNull().cast("long")).alias("missing"),
        ).alias(f"s{i}")
        for i, p in enumerate(predicted)
    ]
    one = df.agg(*parts)
    return one.select(F.explode(F.array(*[f"s{i}" for i in range(len(parts))])).alias("s")).select(
        "s.*"
    )


def level_matches(df: DataFrame, levels: dict[str, tuple[str, str]]) -> DataFrame:
    """Per level: matching rows, rows, and the accuracy of a blind guess (1 / classes)."""
    parts = [
        F.struct(
            F.lit(name).alias("level"),
            F.sum((F.col(a) == F.col(p)).cast("long")).alias("matches"),
            F.count(F.lit(1)).alias("n"),
            (1.0 / F.count_distinct(a)).alias("chance"),
        ).alias(name)
        for name, (a, p) in levels.items()
    ]
    one = df.agg(*parts)
    return one.select(F.explode(F.array(*levels)).alias("s")).select("s.*")


def confident_errors(
    df: DataFrame, actual: str, predicted: str, score: str, above: float = 0.8
) -> DataFrame:
    return df.filter((F.col(actual) != F.col(predicted)) & (F.col(score) > above))


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows ``(actual, predicted, cnt)`` without missing predictions."""
    return (
        df.filter(F.col(predicted).isNotNull())
        .groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def class_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """True/false positives and negatives per class.

    Works on the counts per (actual, predicted), so no class is ever one task of raw rows.  They are
    written once: the predictions may be the result of a long search.
    """
    cells = materialize(confusion(df, actual, predicted))
    sides = cells.select(
        "cnt",
        F.explode(
            F.array(
                F.struct(F.col("actual").alias("class"), F.lit(1).alias("is_actual")),
                F.struct(F.col("predicted").alias("class"), F.lit(0).alias("is_actual")),
            )
        ).alias("s"),
        (F.col("actual") == F.col("predicted")).alias("hit"),
    )
    support = F.sum(F.when(F.col("s.is_actual") == 1, F.col("cnt")).otherwise(0))
    guessed = F.sum(F.when(F.col("s.is_actual") == 0, F.col("cnt")).otherwise(0))
    hits = F.sum(F.when((F.col("s.is_actual") == 1) & F.col("hit"), F.col("cnt")).otherwise(0))
    total = cells.agg(F.sum("cnt").alias("total"))
    return (
        sides.groupBy(F.col("s.class").alias("class"))
        .agg(support.alias("support"), guessed.alias("guessed"), hits.alias("tp"))
        .crossJoin(F.broadcast(total))
        .select(
            "class",
            "tp",
            (F.col("guessed") - F.col("tp")).alias("fp"),
            (F.col("support") - F.col("tp")).alias("fn"),
            (F.col("total") - F.col("guessed") - F.col("support") + F.col("tp")).alias("tn"),
        )
    )


def class_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    zero = F.lit(0.0)
    counts = materialize(class_counts(df, actual, predicted))  # one row per class, read three times
    rows = counts.select(
        F.col("class").cast("string").alias("class"),
        F.coalesce(F.try_divide(tp, tp + fp), zero).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), zero).alias("f1"),
        (tp + fn).alias("support"),
    )
    measures = ["precision", "recall", "f1"]
    macro = rows.agg(*[F.avg(m).alias(m) for m in measures], F.sum("support").alias("support"))
    weighted = rows.agg(
        *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in measures],
        F.sum("support").alias("support"),
    )
    averages = macro.withColumn("class", F.lit("macro avg")).unionByName(
        weighted.withColumn("class", F.lit("weighted avg"))
    )
    return rows.unionByName(averages)


def disagreement(df: DataFrame, first: str, second: str) -> DataFrame:
    """One row: rows where two predictions differ; two nulls agree."""
    differ = ~F.col(first).eqNullSafe(F.col(second))
    return df.agg(F.sum(differ.cast("long")).alias("differ"), F.count(F.lit(1)).alias("n"))


def rmse(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    error = F.col(actual).cast("double") - F.col(predicted).cast("double")
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"))
