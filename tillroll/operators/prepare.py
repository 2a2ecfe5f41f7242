"""From the feature table to the input of a segmentation."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import rfm
from tillroll.operators.quantiles import exact_quantiles
from tillroll.operators.ranking import dense_index
from tillroll.session import small

# The feature catalogue, group -> (column, format).
CATALOGUE = {
    "personal": [("sex", "object"), ("age", "values"), ("home_city", "object")],
    "purchasetime": [
        ("midnight", "values"),
        ("morning", "values"),
        ("noon", "values"),
        ("afternoon", "values"),
        ("night", "values"),
    ],
    "prefer": [("weekday", "object"), ("weekend", "object")],
    "rfm": [("rfm_recency", "values"), ("rfm_frequency", "values"), ("rfm_monetary", "values")],
    "calculated": [("cv_ratio", "values"), ("aov", "values"), ("cv", "values")],
    "area": [
        (f"area_{code}", "object")
        for code in ("01", "02", "03", "04", "05", "06", "07", "09", "10", "11")
    ],
    "active": [("active_city", "object"), ("active_region", "object")],
}
REQUIRED = [
    ("mid", "object"),
    ("pma_no_fin", "object"),
    ("qty", "values"),
    ("avg_qty", "values"),
]
METHODS = ["KMeans", "KPrototypes", "KMedoids", "KModes", "WKMeans"]
SCORES = ["elbow", "calinski-harabasz", "davies-bouldin", "silhouette"]
SPLITS = ["average", "median", "mode"]
# End of fixed values.

IDS = ["mid", "pma_no_fin"]
RFM_COLUMNS = dict(zip(rfm.LETTERS, ["rfm_recency", "rfm_frequency", "rfm_monetary"]))
BLANK = " "


@dataclass(frozen=True)
class Options:
    """Choices of one segmentation run; wrong combinations raise ``ValueError``."""

    method: str = "KMeans"
    k: int | None = None
    auto: bool = False
    score: str = "elbow"
    k_min: int = 5
    k_max: int = 20
    groups: tuple[str, ...] | None = None
    rfm_split: str = "average"
    rfm_letters: tuple[str, ...] | None = None
    weight: str | None = None
    scale: bool = False
    seed: int = 50
    max_iter: int = 100
    restarts: int = 1
    init: str | None = None  # None: the method's own start

    def __post_init__(self):
        if self.method not in METHODS:
            raise ValueError(f"method must be one of {METHODS}")
        if self.method == "WKMeans" and not self.weight:
            raise ValueError("WKMeans needs a weight column")
        if self.weight in IDS:
            raise ValueError("an id cannot be a weight")
        if self.auto == (self.k is not None):
            raise ValueError("give either k or auto")
        if self.score not in SCORES:
            raise ValueError(f"score must be one of {SCORES}")
        if self.restarts < 1 or self.init not in (None, "hash", "first"):
            raise ValueError("restarts must be positive and init one of hash, first")
        if self.rfm_split not in SPLITS:
            raise ValueError(f"rfm_split must be one of {SPLITS}")
        if self.rfm_letters is not None and (
            len(self.rfm_letters) != 2 or not set(self.rfm_letters) <= set(rfm.LETTERS)
        ):
            raise ValueError("rfm_letters must be two of r, f, m")
        for group in self.groups or ():
            if group != "all" and group not in CATALOGUE:
                raise ValueError(f"unknown feature group {group}")

    def group_names(self) -> list[str]:
        """The chosen feature groups; ``all`` stands for the whole catalogue."""
        chosen = list(self.groups or ())
        return list(CATALOGUE) if "all" in chosen else chosen


def option_problem() -> Column:
    """The option that is wrong first, or null, for a table of planned runs with the columns of ``Options``.

    The checks are those of ``Options``: ``method``, ``weight``, ``k`` (either it or ``auto``), ``score``,
    ``start`` (``restarts`` and ``init``) and ``rfm_split``.
    """
    weight = F.col("weight")
    checks = {
        "method": ~F.col("method").isin(METHODS) | F.col("method").isNull(),
        "weight": ((F.col("method") == "WKMeans") & (F.coalesce(weight, F.lit("")) == "")) | weight.isin(IDS),
        "k": F.coalesce(F.col("auto"), F.lit(False)) == F.col("k").isNotNull(),
        "score": ~F.col("score").isin(SCORES) | F.col("score").isNull(),
        "start": (F.coalesce(F.col("restarts"), F.lit(0)) < 1) | ~F.coalesce(F.col("init"), F.lit("first")).isin("hash", "first"),
        "rfm_split": ~F.col("rfm_split").isin(SPLITS) | F.col("rfm_split").isNull(),
    }
    return F.coalesce(*[F.when(wrong, F.lit(name)) for name, wrong in checks.items()])


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The frame itself, or ``ValueError`` naming the missing columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def feature_columns(groups: Iterable[str], catalogue: dict | None = None) -> list[tuple[str, str]]:
    """Required columns and those of the chosen groups, with their formats."""
    catalogue = catalogue or CATALOGUE
    return REQUIRED + [pair for g in groups for pair in catalogue[g]]


def select_features(df: DataFrame, groups: Iterable[str], catalogue: dict | None = None) -> DataFrame:
    names = [name for name, _ in feature_columns(groups, catalogue)]
    return require_columns(df, names).select(*names)


def one_category(df: DataFrame, code: str) -> DataFrame:
    return df.filter(F.col("pma_no_fin") == code)


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def fill_missing(df: DataFrame) -> DataFrame:
    """Blank for missing texts, 0 for missing numbers."""
    texts = [c for c in df.columns if _is_text(df, c)]
    numbers = [c for c in df.columns if c not in texts]
    return df.fillna(BLANK, texts).fillna(0, numbers)


def rfm_splits(df: DataFrame, how: str = "average", by: str = "pma_no_fin") -> DataFrame:
    """One row per category with the split point of each measure: mean, median or mode.

    The smallest of several equally frequent values is the mode.
    """
    columns = list(RFM_COLUMNS.values())
    values = df.select(by, *[F.col(c).cast("double").alias(c) for c in columns])
    split_names = {c: f"{c}_split" for c in columns}
    if how == "average":
        return values.groupBy(by).agg(*[F.avg(c).alias(split_names[c]) for c in columns])
    if how == "median":
        long = exact_quantiles(values, [by], columns, [0.5])
    elif how == "mode":
        long = (
            values.unpivot([by], columns, "column", "value")
            .groupBy(by, "column", "value")
            .agg(F.count(F.lit(1)).alias("n"))
            .groupBy(by, "column")
            .agg(F.max_by("value", F.struct(F.col("n"), -F.col("value"))).alias("value"))
        )
    else:
        raise ValueError(f"split must be one of {SPLITS}")
    return long.groupBy(by).agg(
        *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(split_names[c]) for c in columns]
    )


def rfm_levels(
    df: DataFrame,
    how: str = "average",
    letters: Iterable[str] | None = None,
    by: str = "pma_no_fin",
) -> DataFrame:
    """Add ``rfm_level``: one digit per measure (or two measures) against its split point."""
    splits = small(rfm_splits(df, how, by))
    kept = rfm.kept_letters(list(letters) if letters is not None else None)
    digits = [
        rfm.level_flag(x, F.col(RFM_COLUMNS[x]), F.col(f"{RFM_COLUMNS[x]}_split")) for x in kept
    ]
    return (
        df.join(splits, by)
        .withColumn("rfm_level", F.concat(*digits))
        .drop(*[f"{c}_split" for c in RFM_COLUMNS.values()])
    )


def text_columns(df: DataFrame) -> list[str]:
    """Text columns to encode: ids and store areas stay as they are."""
    return [c for c in df.columns if _is_text(df, c) and c not in IDS and "area" not in c]


def label_codes(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Rows ``(column, value, code)``; codes follow the sorted order of the values."""
    columns = list(columns if columns is not None else text_columns(df))
    long = df.select(*columns).unpivot([], columns, "column", "value")
    return dense_index(long.filter(F.col("value").isNotNull()), "column", "value")


def encode_labels(df: DataFrame, codes: DataFrame, columns: Iterable[str]) -> DataFrame:
    return _map_labels(df, codes, columns, "value", "code")


def decode_labels(df: DataFrame, codes: DataFrame, columns: Iterable[str]) -> DataFrame:
    return _map_labels(df, codes, columns, "code", "value")


def _map_labels(df, codes, columns, source, target) -> DataFrame:
    for c in columns:
        lookup = codes.filter(F.col("column") == c).select(
            F.col(source).alias(c), F.col(target).alias("_mapped")
        )
        df = df.join(lookup, c, "left").drop(c).withColumnRenamed("_mapped", c)
    return df


def clustering_columns(df: DataFrame, with_rfm: bool) -> list[str]:
    """Columns that enter the clustering: no ids, and no raw measures beside their level."""
    raw = list(RFM_COLUMNS.values()) if with_rfm else []
    return [c for c in df.columns if c not in IDS + raw]


def categorical_positions(columns: list[str], categorical: Iterable[str]) -> list[int]:
    chosen = set(categorical)
    return [i for i, c in enumerate(columns) if c in chosen]

