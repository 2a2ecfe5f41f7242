"""Expressions and small helpers that several operators share."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Word characters of the contracts: digits, a-z and everything beyond ASCII; the text is lower-cased
#: in A-Z before.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
#: White space of the contracts.
BLANK = r"\x20\x09-\x0D"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """Lower-cased words; an empty array where there are none or the text is null."""
    parts = F.split(lower_ascii(text), NOT_WORD + "+")
    return F.coalesce(F.filter(parts, lambda w: w != ""), F.array().cast("array<string>"))


def blank_words_count(text: Column) -> Column:
    """Number of runs without white space; 0 for null."""
    run = rf"[{BLANK}]*+[^{BLANK}]++[{BLANK}]*+"
    some = text.rlike(rf"[^{BLANK}]")
    return F.when(some, F.length(F.regexp_replace(text, run, "x"))).otherwise(0).cast("long")


def same(left: Column, right: Column) -> Column:
    """Equality that holds for two nulls."""
    return left.eqNullSafe(right)


#: Bounds of a table of keys that is broadcast: about 100 MB as a hash table.
KEY_ROWS, KEY_BYTES = 1_000_000, 1 << 25


def broadcast_keys(keys: DataFrame, size: Column | None = None) -> DataFrame:
    """A written table of keys, marked for broadcast while it is below the bounds.

    The other side of the join, whole texts, then stays where it is.  A larger table is left to a
    shuffled join.  ``size``: bytes of a row, by default those of its values as text.
    """
    of_row = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in keys.columns), F.lit(0))
    n, total = keys.agg(F.count(F.lit(1)), F.sum(of_row if size is None else size)).first()
    return F.broadcast(keys) if n <= KEY_ROWS and (total or 0) <= KEY_BYTES else keys


def arrow_batches(spark: SparkSession, rows: int = 512) -> None:
    """Hand texts to Python workers in batches that stay small even if texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


#: Characters kept on either side of a match, unless the caller takes others.
_NEAR = 60


def near_before(gap: Column) -> Column:
    return F.right(gap, F.lit(_NEAR))


def near_after(gap: Column) -> Column:
    return F.left(gap, F.lit(_NEAR))


_PIECES = "array<struct<kind:string,at:int,x:struct<gap:int,before:string,after:string,value:string>>>"


def _pieces(text: Column, kind: str, expression: str, maybe: Column, before: Callable, after: Callable) -> Column:
    """Matches of one expression with what stands before each; a last entry holds the rest of the text."""
    both = F.zip_with(
        F.split(text, expression, -1),
        F.regexp_extract_all(text, F.lit(f"({expression})"), F.lit(0)),
        lambda gap, value: F.struct(
            F.char_length(gap).alias("gap"),
            before(gap).alias("before"),
            after(gap).alias("after"),
            value.alias("value"),
        ),
    )
    numbered = F.transform(both, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("at"), x.alias("x")))
    return F.when(maybe, numbered).otherwise(F.array().cast(_PIECES))


def matches(
    docs: DataFrame,
    id_column: str,
    text: str,
    expressions: dict[str, tuple[str, Column]],
    *more: str,
    before: Callable[[Column], Column] = near_before,
    after: Callable[[Column], Column] = near_after,
) -> DataFrame:
    """All non-overlapping matches of each expression: places in code points, and what stands around.

    ``expressions``: kind to ``(expression, whether a text can match)``; expressions mustn't hold groups
    that capture.  Rows ``(id, text_hash, kind, at, start, end, value, before, after, *more)``, once for
    repeated rows; a text is read once, and only matches and their surroundings leave that stage.
    ``before`` and ``after`` take those surroundings from the stretch between two matches.
    """
    own = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"), *more)
    every = [_pieces(F.col("text"), kind, expression, maybe, before, after) for kind, (expression, maybe) in expressions.items()]
    rows = own.select("id", "text_hash", *more, F.explode(F.concat(*every)).alias("p")).select(
        "id", "text_hash", *more, "p.kind", "p.at", "p.x.*"
    )
    rows = rows.dropDuplicates(["id", "text_hash", "kind", "at"])
    order = Window.partitionBy("id", "text_hash", "kind").orderBy("at")
    length = F.coalesce(F.char_length("value"), F.lit(0))
    end = F.sum(F.col("gap") + length).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = rows.withColumn("end", end.cast("long")).withColumn("after", F.lead("after").over(order))
    return placed.filter("value is not null").select(
        "id", "text_hash", "kind", "at", (F.col("end") - F.char_length("value")).alias("start"), "end", "value", "before", "after", *more
    )
