"""Mixing sources to target weights by Sainte-Lague apportionment.

A source's target is a number of words.  The mix is dealt in blocks of equal length: sources get
blocks by the highest quotients ``votes / (2 * seats + 1)``, then the shards of a source get its
blocks in the same way.  A shard is a few thousand documents in seeded order; its blocks are taken
evenly from a seeded offset.  No block is ever a row: how many words the blocks of a stretch hold
has a closed form, so the cost depends on the number of documents only.

Only DataFrame functions are used.  Sources and shards are aggregated before they meet; a hot source
has many shards, so no task holds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import BLANK, same
from tillroll.operators.ranking import dense_index
from tillroll.session import materialize

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Words in a block.
BLOCK = 32
SHARD_ROWS = 4096
SEED = "mix-1"


def seeded_hex(*parts: Column, seed: str) -> Column:
    """A reproducible order key: hex digits of a digest of the parts, null written as 'null'."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))


def seeded_number(digest: Column) -> Column:
    """The first 8 hex digits as a number."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def source_targets(
    sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """Add ``target`` to ``(source, source_size, source_rows)``, one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` times all
    words; a target stops at ``most`` times the source's size and the excess is shared anew.  All
    sizes 0: every target is 0.
    """
    order = F.struct(F.col("source").isNull().alias("last"), F.col("source").alias("name"))
    keyed = sources.withColumn("order_key", order).withColumn("all", F.lit(0))
    code = dense_index(keyed, "all", "order_key", "code").select("order_key", "code")
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod("code", F.lit(len(weights))).cast("int") + 1)
    weighed = materialize(
        keyed.join(code, "order_key").select("source", "source_size", "source_rows", "code", weight.alias("weight"))
    )
    words = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:  # ends: the level only rises, and a source once at its limit stays there
        over = F.col("weight") * F.lit(level) > most * F.col("source_size")
        n, held, free = weighed.agg(
            F.count_if(over), F.sum(F.when(over, F.col("source_size"))), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if n == capped or not free:
            break
        capped, level = n, (share * words - most * (held or 0)) / free
    return weighed.withColumn(
        "target", F.least((most * F.col("source_size")).cast("double"), F.col("weight") * F.lit(level))
    )


def sainte_lague(parties: DataFrame, group: str, party: str) -> DataFrame:
    """Deal ``seats`` of every group to its parties by the highest quotients.

    ``parties``: ``(group, party, votes double, seats long, most long)``, one row per party; ``seats``
    is that of the group.  Equal quotients go to the smaller party.  Quotients far above the cut are
    dealt without being listed: rounding with the group's mean divisor misses a party's seats by at
    most its share of the number of parties, so only so many quotients around it are ranked.
    Returns ``(group, party, quota)``.
    """
    totals = parties.groupBy(F.col(group).alias("of_group")).agg(
        F.sum("votes").alias("all_votes"), F.count(F.lit(1)).alias("n_parties")
    )
    shared = parties.join(totals, F.col(group) == F.col("of_group")).drop("of_group")
    fair = F.when(F.col("all_votes") > 0, F.col("votes") / F.col("all_votes")).otherwise(0.0)
    slack = 2 + F.ceil(2 * F.col("fair") * F.col("n_parties")).cast("long")
    near = F.round(F.col("fair") * F.col("seats")).cast("long")
    start = F.least("most", F.greatest(F.lit(0), near - F.col("slack")))
    stop = F.least("most", near + F.col("slack"))
    bracket = materialize(
        shared.withColumn("fair", fair)
        .withColumn("slack", slack)
        .withColumn("start", start)
        .withColumn("stop", F.when(F.col("votes") > 0, stop).otherwise(F.col("start")))
        .select(group, party, "votes", "seats", "start", "stop")
    )
    held = bracket.groupBy(F.col(group).alias("of_group")).agg((F.max("seats") - F.sum("start")).alias("left"))
    one = F.explode(F.sequence(F.col("start"), F.col("stop") - 1))
    quotient = bracket.filter("stop > start").select(group, party, "votes", one.alias("seat"))
    rank_key = F.struct((-F.col("votes") / (2 * F.col("seat") + 1)).alias("q"), F.col(party), F.col("seat"))
    ranked = dense_index(quotient.withColumn("rank_key", rank_key), group, "rank_key", "rank_no")
    won = (
        ranked.join(held, F.col(group) == F.col("of_group"))
        .filter(F.col("rank_no") < F.col("left"))
        .groupBy(F.col(group).alias("g"), F.col(f"rank_key.{party}").alias("p"))
        .agg(F.count(F.lit(1)).alias("more"))
    )
    return bracket.join(won, (F.col(group) == F.col("g")) & (F.col(party) == F.col("p")), "left").select(
        group, party, (F.col("start") + F.coalesce("more", F.lit(0))).alias("quota")
    )


def _shard(digest: Column, rows: Column, shard_rows: int) -> Column:
    return F.pmod(seeded_number(digest), F.ceil(rows / F.lit(shard_rows))).cast("long")


def shard_quotas(
    sizes: DataFrame,
    block: int = BLOCK,
    shard_rows: int = SHARD_ROWS,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """Blocks each shard gives: ``(source, shard, quota, blocks, source_size, source_rows, target)``.

    ``sizes``: ``(source, digest, size)``, one row per document.
    """
    sources = materialize(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    )
    targets = materialize(source_targets(sources, weights, share, most))
    wanted = targets.agg(F.sum("target")).first()[0] or 0.0
    blocks = F.ceil(F.col("source_size") / F.lit(block))
    parties = targets.select(
        F.lit(0).alias("all"),
        F.col("code"),
        F.col("target").alias("votes"),
        F.lit(int(wanted / block + 0.5)).cast("long").alias("seats"),
        (most * blocks).alias("most"),
    )
    source_quota = materialize(sainte_lague(parties, "all", "code").select("code", F.col("quota").alias("seats")))
    by_source = targets.join(source_quota, "code")
    with_rows = sizes.join(
        targets.select(F.col("source").alias("of"), "code", "source_rows"), same(F.col("source"), F.col("of"))
    )
    shards = (
        with_rows.withColumn("shard", _shard(F.col("digest"), F.col("source_rows"), shard_rows))
        .groupBy("code", "shard")
        .agg(F.sum("size").alias("shard_size"))
    )
    shards = materialize(shards.withColumn("blocks", F.ceil(F.col("shard_size") / F.lit(block))))
    parties = shards.join(source_quota, "code").select(
        "code", "shard", F.col("shard_size").cast("double").alias("votes"), "seats", (most * F.col("blocks")).alias("most")
    )
    dealt = sainte_lague(parties, "code", "shard")
    return materialize(
        shards.join(dealt, ["code", "shard"])
        .join(by_source.select("code", "source", "source_size", "source_rows", "target"), "code")
        .select("source", "shard", "quota", "blocks", "source_size", "source_rows", "target")
    )


def mix(
    docs: DataFrame,
    quotas: DataFrame,
    order: list[str],
    block: int = BLOCK,
    shard_rows: int = SHARD_ROWS,
    seed: str = SEED,
    text: str | None = None,
    length: str | None = None,
    most: int = MOST,
) -> DataFrame:
    """Add ``source_size``, ``target`` and ``taken`` to rows with ``source``, ``digest`` and ``size``.

    The documents of a shard stand in the order of ``digest`` and then ``order``.  Block ``k`` is
    taken ``floor(((k + 1) * quota + offset) / blocks) - floor((k * quota + offset) / blocks)`` times,
    which sums up to the quota and is never above ``most``.  Empty documents take nothing.  Other
    columns stay; earlier ones with the added names are replaced.

    ``text`` names a column of the texts that ``size`` counts; it becomes the words that are taken.  All
    passages taken once or more stand in their order, after a line break those taken twice, and so on up
    to ``most`` times; white space inside a passage stays, and a text taken once as a whole is unchanged.
    ``length`` names a column with its code points, which follows where the text changes.
    """
    own = docs.drop("source_size", "target", "taken")
    per_source = quotas.select(
        F.col("source").alias("__of"), "source_size", F.col("source_rows").alias("__rows"), "target"
    ).distinct()
    held = own.join(per_source, same(F.col("source"), F.col("__of"))).withColumn(
        "__shard", _shard(F.col("digest"), F.col("__rows"), shard_rows)
    )
    dealt = quotas.select(
        F.col("source").alias("__source"),
        F.col("shard").alias("__in_shard"),
        F.col("quota").alias("__quota"),
        F.col("blocks").alias("__blocks"),
    )
    both = same(F.col("source"), F.col("__source")) & (F.col("__shard") == F.col("__in_shard"))
    window = Window.partitionBy("source", "__shard").orderBy("digest", *order)
    upto = F.sum("size").over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    offset_key = seeded_hex(F.col("source"), F.col("__shard"), seed=seed)
    offset = F.pmod(seeded_number(offset_key), F.greatest(F.col("__blocks"), F.lit(1)))
    placed = held.withColumn("__end", upto).join(dealt, both).withColumn("__offset", offset)

    def passed(at: Column) -> Column:
        """Words the mix takes of the first ``at`` words of the shard."""
        k = F.floor(at / F.lit(block))
        upto = lambda j: F.floor((j * F.col("__quota") + F.col("__offset")) / F.col("__blocks"))
        return block * upto(k) + (at - block * k) * (upto(k + 1) - upto(k))

    taken = F.when(F.col("size") > 0, passed(F.col("__end")) - passed(F.col("__end") - F.col("size")))
    placed = placed.withColumn("taken", F.coalesce(taken, F.lit(0)).cast("long"))
    if text:
        placed = _with_taken_text(placed, text, length, block, most)
    return placed.drop(
        "__of", "__rows", "__shard", "__source", "__in_shard", "__quota", "__blocks", "__end", "__offset"
    )


def _with_taken_text(placed: DataFrame, text: str, length: str | None, block: int, most: int) -> DataFrame:
    """Replace ``text`` by the words that the blocks of the shard take of it."""
    start = F.col("__end") - F.col("size")
    quota, offset, blocks = F.col("__quota"), F.col("__offset"), F.col("__blocks")
    upto = lambda j: F.floor((j * quota + offset) / blocks)
    # Every word with the white space after it; the first one also with what stands before it.
    run = rf"[{BLANK}]*+[^{BLANK}]++[{BLANK}]*+"
    words = F.regexp_extract_all(F.col(text), F.lit(f"({run})"), F.lit(1))
    held = F.sequence(F.floor(start / F.lit(block)), F.floor((F.col("__end") - 1) / F.lit(block)))
    spans = F.transform(
        held,
        lambda k: F.struct(
            (upto(k + 1) - upto(k)).alias("times"),
            (F.greatest(block * k, start) - start).cast("int").alias("from"),
            (F.least(block * (k + 1), F.col("__end")) - start).cast("int").alias("to"),
        ),
    )

    def copy(number: int) -> Column:
        chosen = F.filter("__spans", lambda x: x["times"] >= number)
        passages = F.transform(chosen, lambda x: F.slice("__words", x["from"] + 1, x["to"] - x["from"]))
        return F.when(F.size(chosen) > 0, F.array_join(F.flatten(passages), ""))

    some = F.col("taken") > 0
    times = F.transform("__spans", lambda x: x["times"])
    # A text whose blocks are all taken equally often is not cut into words.
    even = F.array_min(times) == F.array_max(times)
    repeated = F.array_join(F.array_repeat(F.col(text), F.array_max(times).cast("int")), "\n")
    pieced = F.concat_ws("\n", *[copy(c) for c in range(1, most + 1)])
    cut = (
        placed.withColumn("__spans", F.when(some, spans))
        .withColumn("__even", even)
        .withColumn("__words", F.when(some & ~F.col("__even"), words))
        .withColumn("__text", F.when(~some, F.lit("")).when(F.col("__even"), repeated).otherwise(pieced))
    )
    if length:
        kind = placed.schema[length].dataType
        follows = F.when(same(F.col("__text"), F.col(text)), F.col(length)).otherwise(F.char_length("__text").cast(kind))
        cut = cut.withColumn(length, follows)
    return cut.withColumn(text, F.col("__text")).drop("__text", "__spans", "__words", "__even")
