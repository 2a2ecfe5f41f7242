"""Exact copies by deterministic block naming.

White space runs become one blank, and a text is cut into blocks of ``BLOCK`` code points.  The distinct
blocks of all texts are sorted and named by their rank.  Then adjacent names are joined to pairs, the
distinct pairs are sorted and named in turn, and so on, until one name is left of each text.  Equal ranks
mean equal blocks on every level, so ``(number of blocks, last name)`` is an identity without collisions.

Blocks are sorted by a 64-bit hash first and by their characters where hashes tie.  A hash that only one
block has needs no characters afterwards, so each distinct block crosses the network once; later levels
move numbers only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import BLANK, broadcast_keys, same
from tillroll.session import materialize

#: Code points of a block.
BLOCK = 1024
#: Rows that are sorted together when names are given.
RANGE_ROWS = 1_000_000
#: ``monotonically_increasing_id`` counts the rows of a partition in its lower 33 bits.
_ROW_BITS = 33


def normalised(text: Column) -> Column:
    """The text with each run of white space as one blank; empty for null."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{BLANK}]+", " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text; tells rows with the same id apart."""
    return F.unhex(F.sha2(normalised(text), 256))


def _blocks(docs: DataFrame, id_column: str, text: str, block: int, key: Callable) -> DataFrame:
    """``(id, digest, n, pos, block, h)``: all blocks of all rows; an empty text is one empty block."""
    own = docs.select(F.col(id_column).alias("id"), normalised(F.col(text)).alias("text"))
    cut = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    parts = F.when(F.col("text") == "", F.array(F.lit(""))).otherwise(cut)
    keyed = own.select("id", F.unhex(F.sha2("text", 256)).alias("digest"), parts.alias("parts"))
    out = keyed.select("id", "digest", F.size("parts").alias("n"), F.posexplode("parts").alias("pos", "block"))
    return out.withColumn("h", key(F.col("block")))


def numbered(keys: DataFrame, name: str = "name", range_rows: int = RANGE_ROWS) -> DataFrame:
    """``keys``, distinct rows, with their rank from 0 in the order of their columns.

    Keys are range partitioned, sorted in bounded ranges and written; a rank is the place in the range
    plus the rows of the ranges before (one row per range).
    """
    order = keys.columns
    keys = materialize(keys)
    ranges = max(1, -(-keys.count() // range_rows))
    placed = materialize(
        keys.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    )
    placed = placed.select(
        *order, F.shiftright("at", _ROW_BITS).alias("range"), F.col("at").bitwiseAND((1 << _ROW_BITS) - 1).alias("at")
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("range")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    return placed.join(F.broadcast(offsets), "range").select(*order, (F.col("at") + F.col("offset")).alias(name))


def _named_blocks(docs: DataFrame, id_column: str, text: str, block: int, key: Callable) -> DataFrame:
    """``(id, digest, n, pos, name)``: every block by its name, repeated rows included."""
    # Written once with their characters: cutting a text costs more than reading its blocks.
    blocks = materialize(_blocks(docs, id_column, text, block, key))
    places = blocks.drop("block")
    variants = materialize(blocks.select("h", "block").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("variants")))
    clashing = variants.filter("variants > 1").select(F.col("h").alias("clash"))
    if clashing.limit(1).count() == 0:
        names = numbered(variants.select("h"))
        return places.join(names, "h").select("id", "digest", "n", "pos", "name")
    # Several blocks share a hash: these, and only these, are told apart by their characters.
    apart = materialize(
        blocks.join(broadcast_keys(clashing), F.col("h") == F.col("clash")).select(
            F.col("id").alias("of"), F.col("digest").alias("of_digest"), F.col("pos").alias("of_pos"), "h", "block"
        ).distinct()
    )
    order = Window.partitionBy("h").orderBy("block")
    ranks = apart.select("h", "block").distinct().withColumn("variant", F.row_number().over(order))
    ranked = apart.join(ranks, ["h", "block"]).drop("h", "block")
    here = same(F.col("id"), F.col("of")) & (F.col("digest") == F.col("of_digest")) & (F.col("pos") == F.col("of_pos"))
    told = places.join(ranked, here, "left").select(
        "id", "digest", "n", "pos", "h", F.coalesce("variant", F.lit(0)).alias("variant")
    )
    told = materialize(told)
    names = numbered(told.select("h", "variant").distinct())
    return told.join(names, ["h", "variant"]).select("id", "digest", "n", "pos", "name")


def _identified(docs: DataFrame, id_column: str, text: str, block: int, key: Callable) -> DataFrame:
    """``(id, digest, n, name, row)`` per row of ``docs``: the identity ``(n, name)`` and a number of its own."""
    named = materialize(_named_blocks(docs, id_column, text, block, key))
    most = named.agg(F.max("n")).first()[0] or 0
    rest, left, whole = named.filter("n > 1"), F.col("n"), []
    for _ in range((most - 1).bit_length() if most else 0):
        name = lambda odd: F.max(F.when(F.col("pos") % 2 == odd, F.col("name")))
        halves = rest.groupBy("id", "digest", "n", F.floor(F.col("pos") / 2).alias("pair")).agg(
            name(0).alias("a"), F.coalesce(name(1), F.lit(-1)).alias("b")
        )
        halves = materialize(halves)
        names = numbered(halves.select("a", "b").distinct())
        level = materialize(
            halves.join(names, ["a", "b"]).select("id", "digest", "n", F.col("pair").alias("pos"), "name")
        )
        left = F.ceil(left / 2)
        whole.append(level.filter(left == 1))
        rest = level.filter(left > 1)
    rows = named.filter("n = 1").select("id", "digest", "n", "name")
    if whole:
        found = whole[0]
        for more in whole[1:]:
            found = found.unionAll(more)
        found = found.select(F.col("id").alias("of"), F.col("digest").alias("of_digest"), F.col("name").alias("last"))
        heads = named.filter("n > 1 and pos = 0").drop("pos", "name")
        mine = same(F.col("id"), F.col("of")) & (F.col("digest") == F.col("of_digest"))
        rows = rows.unionAll(heads.join(found, mine).select("id", "digest", "n", F.col("last").alias("name")))
    return materialize(rows.withColumn("row", F.monotonically_increasing_id()))


def _grouped(docs: DataFrame, id_column: str, text: str, block: int, key: Callable) -> DataFrame:
    """``(id, digest, keep_id, keep_digest, group_size, kept)`` per row of ``docs``."""
    rows = _identified(docs, id_column, text, block, key)
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "digest", "row")).alias("first")
    groups = rows.groupBy("n", "name").agg(first, F.count(F.lit(1)).alias("size")).filter("size > 1")
    groups = materialize(groups.select(F.col("n").alias("of_n"), F.col("name").alias("of_name"), "first", "size"))
    size = F.lit(80)  # bytes of a row; ids are short
    joined = rows.join(
        broadcast_keys(groups, size), (F.col("n") == F.col("of_n")) & (F.col("name") == F.col("of_name")), "left"
    )
    alone = F.col("size").isNull()
    return joined.select(
        "id",
        "digest",
        F.when(alone, F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.when(alone, F.col("digest")).otherwise(F.col("first.digest")).alias("keep_digest"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("first.row"))).alias("kept"),
    )


def exact_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    block: int = BLOCK,
    key: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per document row: ``(id, keep_id, group_size, kept, text_sha256)``.

    Texts are equal if they are identical after each run of white space became one blank; null counts as
    empty.  Of equal texts the row with the smallest id stays, of repeated rows any one; null ids come
    after all others.  ``key`` is the hash that blocks are sorted by first.  An empty table gives no rows;
    other columns, whatever their names, are left out.
    """
    found = _grouped(docs, id_column, text, block, key)
    return found.select(
        F.col("id").alias(id_column), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def drop_exact_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    block: int = BLOCK,
    key: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """``docs`` with the row of each group of equal texts that stays; all columns unchanged."""
    found = materialize(_grouped(docs, id_column, text, block, key))
    own = same(F.col("id"), F.col("keep_id")) & (F.col("digest") == F.col("keep_digest"))
    dropped = found.filter(~own).select(F.col("id").alias("__id"), F.col("digest").alias("__of")).distinct()
    marked = docs.withColumn("__digest", digest(F.col(text)))
    here = same(F.col(id_column), F.col("__id")) & (F.col("__digest") == F.col("__of"))
    left = marked.join(broadcast_keys(materialize(dropped)), here, "left_anti")
    if found.filter(own & ~F.col("kept")).limit(1).count():
        left = left.dropDuplicates([id_column, "__digest"])
    return left.drop("__digest")
