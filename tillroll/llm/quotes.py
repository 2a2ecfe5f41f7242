"""Quotation linking: replies to the messages they quote.

Lines that begin with ``>`` marks are quotes; the number of marks is the level.  Quoted passages, and
their lines, are normalised, hashed and joined to the first message of the conversation that holds the
same passage or line unquoted.  The message quoted most at the lowest level is the parent; following
parents gives the thread.

Only DataFrame functions are used.  Originals are aggregated to one row per passage before the join, so
a passage that thousands of messages share meets each quote once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import same
from tillroll.session import materialize

_MARKS = r"^[ \t]*(?:>[ \t]?)+"


def _lines(text: Column) -> Column:
    return F.split(text, r"\r\n|\r|\n", -1)


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, f"({_MARKS})", 1), "[^>]", ""))


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def unquoted(text: Column) -> Column:
    """The text's own lines; line ends become line feeds, blank lines at either end go."""
    own = F.filter(_lines(text), lambda line: _level(line) == 0)
    return F.regexp_replace(F.array_join(own, "\n"), r"^\s+|\s+$", "")


def _units(messages: DataFrame) -> DataFrame:
    """Lines and passages ``(conv, turn, level, unit, chars)``, hashed; a passage is a run of one level."""
    line = F.posexplode(_lines(F.col("text")))
    rows = messages.select("conv", "turn", "row", line.alias("at", "line")).select(
        "conv", "turn", "row", "at", _level(F.col("line")).alias("level"), F.regexp_replace("line", _MARKS, "").alias("body")
    )
    by_row = Window.partitionBy("conv", "turn", "row").orderBy("at")
    changed = F.coalesce(F.col("level") != F.lag("level").over(by_row), F.lit(True)).cast("int")
    rows = rows.withColumn("changed", changed).withColumn("passage", F.sum("changed").over(by_row))
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("at", "body"))), lambda x: x["body"])
    whole = rows.groupBy("conv", "turn", "row", "passage", "level").agg(F.array_join(pieces, " ").alias("body"))
    every = rows.select("conv", "turn", "level", "body").unionByName(whole.select("conv", "turn", "level", "body"))
    normal = every.select("conv", "turn", "level", _normal(F.col("body")).alias("body")).filter("body != ''")
    return normal.select(
        "conv", "turn", "level", F.xxhash64("body").alias("unit"), F.md5("body").alias("check"), F.char_length("body").alias("chars")
    ).distinct()


def links(messages: DataFrame) -> DataFrame:
    """``(conv, turn, parent)``: which earlier message a message replies to."""
    units = materialize(_units(messages))
    first = (
        units.filter("level = 0")
        .groupBy(F.col("conv").alias("of"), F.col("unit").alias("original"), F.col("check").alias("original_check"))
        .agg(F.min("turn").alias("origin"))
    )
    here = same(F.col("conv"), F.col("of")) & (F.col("unit") == F.col("original")) & (F.col("check") == F.col("original_check"))
    met = units.filter("level > 0").join(first, here).filter(F.col("origin") < F.col("turn"))
    votes = met.groupBy("conv", "turn", "level", "origin").agg(F.sum("chars").alias("chars"))
    best = F.max_by("origin", F.struct(-F.col("level"), F.col("chars"), F.col("origin")))
    return votes.groupBy("conv", "turn").agg(best.alias("parent"))


def threads(parents: DataFrame) -> DataFrame:
    """``(conv, turn, parent, root, depth)`` for all replies; pointers double, so rounds grow as a logarithm."""
    ways = materialize(parents.select("conv", "turn", "parent", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")))
    while True:
        ahead = ways.select(
            F.col("conv").alias("of"), F.col("turn").alias("from"), F.col("root").alias("next"), F.col("depth").alias("more")
        )
        joined = ways.join(ahead, same(F.col("conv"), F.col("of")) & (F.col("root") == F.col("from")), "left")
        stepped = materialize(
            joined.select(
                "conv",
                "turn",
                "parent",
                F.coalesce("next", "root").alias("root"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("next").isNotNull().alias("moved"),
            )
        )
        ways = stepped.drop("moved")
        if not stepped.filter("moved").limit(1).count():
            return ways


def link_quotes(messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """All columns of ``messages`` with ``text`` freed from quotes, and the place in the conversation.

    Added, in place of columns with these names: ``quote_level`` (deepest, 0 for none), ``parent_turn`` (null without a link), ``thread_turn``
    (the root's turn, its own without a link) and ``reply_depth``.  Conversation, ``thread_turn`` and
    turn are the reply order: a message follows what it answers.  Rows with the same conversation and
    turn count as one message.  A null conversation is one of its own; a message without a turn is
    linked with nothing.  A null text stays null; a text of quotes only becomes empty.
    """
    own = messages.select(
        F.col(conversation).alias("conv"), F.col(turn).alias("turn"), F.xxhash64(text).alias("row"), F.col(text).alias("text")
    ).filter(F.col("turn").isNotNull() & F.col("text").isNotNull())
    found = threads(links(own.dropDuplicates(["conv", "turn", "row"])))
    found = found.select(
        F.col("conv").alias("__conv"),
        F.col("turn").alias("__turn"),
        F.col("parent").alias("__parent"),
        F.col("root").alias("__root"),
        F.col("depth").alias("__depth"),
    )
    here = same(F.col(conversation), F.col("__conv")) & (F.col(turn) == F.col("__turn"))
    levels = F.array_max(F.transform(_lines(F.col(text)), _level))
    return (
        messages.join(found, here, "left")
        .withColumn("quote_level", F.coalesce(levels, F.lit(0)))
        .withColumn("parent_turn", F.col("__parent"))
        .withColumn("thread_turn", F.coalesce("__root", F.col(turn)))
        .withColumn("reply_depth", F.coalesce("__depth", F.lit(0)))
        .withColumn(text, unquoted(F.col(text)))
        .drop("__conv", "__turn", "__parent", "__root", "__depth")
    )
