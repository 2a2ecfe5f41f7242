"""Product names to class, parent class and keywords in one wide table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators import keywords as kw
from tillroll.operators import names as nm


def classify_products(
    products: DataFrame,
    weights: DataFrame,
    hierarchy: DataFrame,
    keywords: DataFrame,
    n_classes: int,
    bias: list[float] | None = None,
    unknown: list[float] | None = None,
    n_keywords: int = 5,
) -> DataFrame:
    """Class, parent and keywords for every row of ``products(product)``.

    Every distinct name is classified once; the rows of ``products`` then look their name up, so
    repeated names cost a join and nothing else.  ``hierarchy`` has
    ``(sub_no, sub_name, category_no, category_name)``, ``keywords`` has ``(category, name, num)``
    with the class name as category.
    """
    classes = nm.classify_names(products, weights, n_classes, "product", bias, unknown)
    placed = classes.select("product", F.col("class_no").alias("sub_no")).join(
        hierarchy, "sub_no", "left"
    )
    tagged = kw.match_keywords(
        placed.select("product", F.col("sub_name").alias("category")), keywords, n_keywords
    )
    found = placed.join(tagged.drop("category"), "product", "left")
    rows = products.select("product").join(found, "product", "left")
    wide = kw.fan_out(rows, n_keywords)
    return wide.select(
        F.col("product").alias("name"),
        "category_no",
        "category_name",
        "sub_no",
        "sub_name",
        *[f"keyword_{i + 1}" for i in range(n_keywords)],
    )
