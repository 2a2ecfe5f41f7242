"""Benchmark decontamination: windows of benchmark words looked up in training texts.

The benchmark's windows are a broadcast hash table, keyed by a hash of four spread words of the
window.  Each document is split once; its windows' hashes are exploded and joined in the same stage,
and a hit counts only if all words of the window agree.  Only hits are shuffled.  A benchmark whose
windows exceed the bound of one broadcast is looked up in blocks below that bound, one pass each.

Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import NOT_WORD, broadcast_keys, same, words
from tillroll.session import materialize

#: Words in a window.
NGRAM = 13
#: Share of hit words, 1 in so many, from which a document is contaminated.
ONE_IN = 20
#: Windows in one broadcast; at 13 words of 8 bytes on average about 50 MB.
BROADCAST_WINDOWS = 200_000


def _spread_hash(of: Column, start: Column, n: int) -> Column:
    """Hash of the length and four spread words of the window of ``n`` words at ``start`` (from 0)."""
    return F.xxhash64(F.lit(n), *[F.get(of, start + k) for k in (0, n // 3, 2 * n // 3, n - 1)])


def _hashes(n: int) -> Column:
    """Hashes of all windows of ``n`` of the words ``w``."""
    starts = F.sequence(F.lit(0), F.size("w") - n)
    every = F.transform(starts, lambda i: _spread_hash(F.col("w"), i, n))
    return F.when(F.size("w") >= n, every).otherwise(F.array().cast("array<bigint>"))


def _window_of(lengths: list[int]) -> tuple[Column, Column]:
    """Length and start of the window whose hash is at ``place`` among those of all lengths in turn."""
    length, start, before = F.lit(lengths[0]), F.col("place"), F.lit(0)
    for earlier, n in zip(lengths, lengths[1:]):
        before = before + F.greatest(F.size("w") - earlier + 1, F.lit(0))
        length = F.when(F.col("place") >= before, n).otherwise(length)
        start = F.when(F.col("place") >= before, F.col("place") - before).otherwise(start)
    return length, start


def benchmark_windows(
    benchmark: DataFrame, id_column: str = "item_id", text: str = "text", ngram: int = NGRAM
) -> DataFrame:
    """Distinct windows ``(window_key, n, window, item_ids)`` of the benchmark.

    An item of fewer than ``ngram`` words is one window of all its words; an item without words has
    none.  Item ids are strings; a null id keeps its windows but is listed nowhere.
    """
    items = benchmark.select(F.col(id_column).cast("string").alias("item"), words(F.col(text)).alias("w")).filter(
        F.size("w") > 0
    )
    n = F.least(F.size("w"), F.lit(ngram))
    starts = F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)
    cut = items.withColumn("n", n).select(
        "item", "n", F.explode(F.transform(starts, lambda i: F.slice("w", i, F.col("n")))).alias("window")
    )
    found = cut.groupBy("n", "window").agg(F.collect_set("item").alias("item_ids"))
    key = F.lit(None).cast("long")
    for k in range(1, ngram + 1):
        key = F.when(F.col("n") == k, _spread_hash(F.col("window"), F.lit(0), k)).otherwise(key)
    return found.select(key.alias("window_key"), "n", "window", "item_ids")


def hits(docs: DataFrame, windows: DataFrame, keys: list[str], broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """Rows ``(*keys, at, n, item_ids)``: window of ``n`` words at word ``at`` (from 0) of a document.

    ``docs`` has the key columns and the words as ``w``.
    """
    lengths = sorted(r[0] for r in windows.select("n").distinct().collect())  # at most ``ngram`` numbers
    if not lengths:
        nothing = [F.lit(0).alias("at"), F.lit(0).alias("n"), F.array().cast("array<string>").alias("item_ids")]
        return docs.select(*keys, *nothing).filter(F.lit(False))
    # Only hashes are exploded; what window a hash belongs to is worked out where one is met.
    hashes = F.concat(*[_hashes(n) for n in lengths]) if len(lengths) > 1 else _hashes(lengths[0])
    every = docs.select(*keys, "w", F.posexplode(hashes).alias("place", "key"))
    length, start = _window_of(lengths)
    agree = (
        (F.col("key") == F.col("window_key"))
        & (length == F.col("n"))
        & (F.slice("w", start + 1, F.col("n")) == F.col("window"))
    )
    blocks = max(1, -(-windows.count() // broadcast_windows))
    found = []
    for b in range(blocks):
        some = windows.filter(F.pmod("window_key", F.lit(blocks)) == b) if blocks > 1 else windows
        met = every.join(F.broadcast(some), agree)
        found.append(met.select(*keys, start.alias("at"), "n", "item_ids"))
    return reduce(DataFrame.unionAll, found)


def _positions(spans: Column) -> Column:
    """Sorted word positions that the windows ``(at, n)`` cover."""
    covered = F.transform(spans, lambda s: F.sequence(s["at"], s["at"] + s["n"] - 1))
    return F.sort_array(F.array_distinct(F.flatten(covered)))


def _stretches(positions: Column) -> Column:
    """Runs of consecutive positions as ``(start, end)``, end exclusive."""
    first = F.filter(positions, lambda p, i: (i == 0) | (F.get(positions, i - 1) < p - 1))
    last = F.filter(positions, lambda p, i: (i == F.size(positions) - 1) | (F.get(positions, i + 1) > p + 1))
    return F.zip_with(first, last, lambda a, b: F.struct(a.alias("start"), (b + 1).alias("end")))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    ngram: int = NGRAM,
    one_in: int = ONE_IN,
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document row: ``(id, text_hash, n_words, n_hit, item_ids, spans, contaminated)``.

    ``spans`` are the hit stretches in words, from 0, end exclusive.  A document is contaminated if
    ``n_hit > 0`` and ``one_in * n_hit >= n_words``.  Null and empty texts have no words and no hits.
    Rows with the same id are told apart by their texts; repeated rows stay repeated.  An empty
    benchmark leaves every document clean.
    """
    windows = materialize(benchmark_windows(benchmark, item_column, item_text, ngram))
    own = docs.select(
        F.col(id_column).alias("id"), F.xxhash64(text).alias("text_hash"), words(F.col(text)).alias("w")
    )
    per_doc = (
        hits(own, windows, ["id", "text_hash"])
        .groupBy(F.col("id").alias("hit_id"), F.col("text_hash").alias("hit_hash"))
        .agg(
            F.collect_set(F.struct("at", "n")).alias("places"),
            F.array_distinct(F.flatten(F.collect_set("item_ids"))).alias("items"),
        )
        .withColumn("positions", _positions(F.col("places")))
        .withColumn("spans", _stretches(F.col("positions")))
        .drop("places")
    )
    both = same(F.col("id"), F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    return (
        own.select("id", "text_hash", F.size("w").cast("long").alias("n_words"))
        .join(per_doc, both, "left")
        .withColumn("n_hit", F.coalesce(F.size("positions"), F.lit(0)).cast("long"))
        .select(
            F.col("id").alias(id_column),
            "text_hash",
            "n_words",
            "n_hit",
            F.coalesce(F.array_sort("items"), F.array().cast("array<string>")).alias("item_ids"),
            F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
            ((F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        )
    )


def _of_rows(found: DataFrame, id_column: str, *more: str) -> DataFrame:
    return found.select(
        F.col(id_column).alias("__found_id"), F.col("text_hash").alias("__found_hash"), *more
    ).distinct()


def _same_row(id_column: str, text: str) -> Column:
    return same(F.col(id_column), F.col("__found_id")) & (F.xxhash64(text) == F.col("__found_hash"))


def remove_documents(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """``docs`` without the contaminated documents; all columns, clean rows unchanged."""
    bad = contamination(docs, benchmark, id_column, text, **options).filter("contaminated")
    keys = broadcast_keys(materialize(_of_rows(bad, id_column)))
    return docs.join(keys, _same_row(id_column, text), "left_anti")


def remove_spans(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """``docs`` with hit words, and the separators before them, cut out of the text."""
    found = contamination(docs, benchmark, id_column, text, **options).filter("n_hit > 0")
    found = materialize(_of_rows(found, id_column, F.col("spans").alias("__spans")))
    # NUL counts as a separator, so it can mark that the first word has nothing before it.
    word = "[^" + NOT_WORD[1:-1].replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60") + "]+"
    gap = NOT_WORD.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")
    pieces = F.regexp_extract_all(F.col(text), F.lit(f"({gap}*{word})"), 1)
    tail = F.regexp_extract(F.col(text), f"({gap}*)$", 1)
    kept = F.filter(
        pieces, lambda _, i: ~F.exists("__spans", lambda s: (s["start"] <= i) & (i < s["end"]))
    )
    cut = F.when(F.col("__spans").isNull(), F.col(text)).otherwise(F.concat(F.array_join(kept, ""), tail))
    return (
        docs.join(broadcast_keys(found, 32 + 8 * F.size("__spans")), _same_row(id_column, text), "left")
        .withColumn(text, cut)
        .drop("__found_id", "__found_hash", "__spans")
    )
