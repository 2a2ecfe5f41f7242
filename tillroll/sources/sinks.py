"""Writers.  All of them write from the tasks that hold the rows; nothing passes the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.keywords import top_n
from tillroll.sources.files import with_breaks


def run_path(base: str, overwrite: bool, run_ts: str) -> str:
    """The target folder: the base itself, or a new folder per run that keeps earlier ones."""
    return base if overwrite else f"{base.rstrip('/')}/run_ts={run_ts}"


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet table; an existing one is replaced."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


FILE_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None, sep: str = ",") -> None:
    """CSV with header in UTF-8, one folder per value of the partition columns.

    Line breaks, quotes, blanks at the edges and empty texts survive; null has a mark of its own.  Files
    have at most ``FILE_ROWS`` rows, as a file with line breaks in its texts is read by one task.
    """
    writer = with_breaks(df.write.mode("overwrite")).option("header", True).option("sep", sep)
    writer = writer.option("maxRecordsPerFile", FILE_ROWS).option("emptyValue", '""')
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def write_json(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).json(path)


def write_groups(detail: DataFrame, describe: DataFrame, path: str, label: str = "label") -> None:
    """Detail rows and statistics, one folder per group."""
    write_csv(detail, f"{path}/detail", [label])
    write_csv(describe, f"{path}/describe", [label])


def write_records(records: DataFrame, path: str) -> None:
    """One JSON object per record below its first tier; the key of the link identifies it."""
    write_json(records, f"{path.rstrip('/')}/content", ["tier1"])


def write_sample_map(samples: DataFrame, path: str, by: str = "category", name: str = "sample", chunk: int = 1000) -> None:
    """JSON objects of category to sample names, one line per category and about ``chunk`` names, in many files.

    A category of any size is many bounded lines, dealt by the hash of the names; repeated names count once.
    """
    names = samples.select(by, name).distinct()
    sizes = names.groupBy(F.col(by).alias("_by")).agg(F.ceil(F.count(F.lit(1)) / F.lit(chunk)).alias("_chunks"))
    dealt = names.join(sizes, F.col(by).eqNullSafe(F.col("_by")))
    lines = dealt.groupBy(by, F.pmod(F.xxhash64(name), F.col("_chunks")).alias("_chunk")).agg(F.collect_list(name).alias("names"))
    object_of = F.map_from_arrays(F.array(F.col(by)), F.array("names"))
    lines.filter(F.col(by).isNotNull()).select(F.to_json(object_of).alias("value")).write.mode("errorifexists").text(path)


def write_keyword_map(
    keywords: DataFrame, path: str, by: str = "category", n: int = 80
) -> None:
    """One JSON object per category with its top names and counts as parallel lists."""
    listed = (
        top_n(keywords, [by], n, name="name")
        .groupBy(by)
        .agg(F.sort_array(F.collect_list(F.struct("rank", "name", "num"))).alias("top"))
        .select(
            by,
            F.transform("top", lambda t: t["name"]).alias("name"),
            F.transform("top", lambda t: t["num"]).alias("num"),
        )
    )
    write_json(listed, path)
