"""Readers for the text formats of the workflow; schemas are always given, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.prepare import require_columns

#: Stands for null in files that also hold empty texts.
NULL_MARK = "\\N"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str,
    columns: list[str] | None = None,
    header: bool = True,
    sep: str = ",",
    own: bool = False,
) -> DataFrame:
    """CSV from any file system; ``columns`` are read and checked, others are not parsed.

    ``own`` reads what ``sinks.write_csv`` wrote: line breaks inside quotes, and its mark for null.
    Such files can't be split; the writer bounds their number of rows.
    """
    reader = spark.read.schema(schema).option("header", header).option("sep", sep).option("escape", '"')
    df = (with_breaks(reader) if own else reader).csv(path)
    return require_columns(df, columns).select(*columns) if columns else df


def with_breaks(reader):
    """Reader or writer options under which every text survives, with line breaks, empty or null."""
    options = {
        "multiLine": True,
        "lineSep": "\n",
        "nullValue": NULL_MARK,
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        "quote": '"',
        "escape": '"',
        "maxColumns": 20_480,
    }
    return reader.options(**options)


def read_indexed_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV whose first column is a row index, which is dropped."""
    return read_csv(spark, path, f"_row_index string, {schema}").drop("_row_index")


def read_lines(spark: SparkSession, path: str, name: str = "product") -> DataFrame:
    """One value per line, no header; quotes are part of the value and empty lines are dropped."""
    lines = spark.read.text(path).filter(F.col("value") != "")
    return lines.select(F.col("value").alias(name))


def read_first_words(spark: SparkSession, path: str, name: str = "name") -> DataFrame:
    """First word of every line of a blank-separated list."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.select(F.split(F.trim("value"), "\\s+")[0].alias(name))


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Nested feature catalogue to rows ``(category, key, format)``."""
    kind = "map<string, struct<key: array<string>, format: array<string>>>"
    groups = (
        spark.read.text(path, wholetext=True)
        .select(F.from_json("value", kind).alias("m"))
        .select(F.explode("m").alias("category", "g"))
    )
    pairs = F.arrays_zip(F.col("g.key").alias("key"), F.col("g.format").alias("format"))
    return groups.select("category", F.explode(pairs).alias("p")).select("category", "p.*")


def catalogue_groups(rows: DataFrame) -> dict[str, list[tuple[str, str]]]:
    """A catalogue as the dict that the preparation takes; it is a small configuration."""
    groups: dict[str, list[tuple[str, str]]] = {}
    for r in rows.collect():
        groups.setdefault(r["category"], []).append((r["key"], r["format"]))
    return groups


def read_sample_map(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """JSON map of category to sample names, as rows ``(category, samples)``.

    With ``lines`` every line is an object of its own, and a category may have several.
    """
    return (
        spark.read.text(path, wholetext=not lines)
        .select(F.from_json("value", "map<string, array<string>>").alias("m"))
        .select(F.explode("m").alias("category", "samples"))
    )


def read_glob(
    spark: SparkSession,
    pattern: str,
    schema: str,
    name_pattern: str,
    column: str = "category",
    partition_folders: bool = False,
) -> DataFrame:
    """All CSV files of a path pattern, with a column taken from the path.

    ``partition_folders`` undoes the escapes that a partitioned write puts into folder names.
    """
    found = F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), name_pattern, 1))
    found = F.url_decode(found) if partition_folders else found
    reader = with_breaks(spark.read.schema(schema)).option("header", True)
    return reader.csv(pattern).select("*", found.alias(column))


def numbers(spark: SparkSession, first: int = 1, last: int = 10_000) -> DataFrame:
    """Integer sequence, both ends included."""
    return spark.range(first, last + 1).withColumnRenamed("id", "n")
