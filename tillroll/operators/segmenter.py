"""Segmentation of names by a dictionary with frequencies.

A cleaned text is cut into dictionary words, runs of Latin letters or digits, and single CJK characters, so
that the product of the words' shares in the dictionary is largest (most probable path), or by taking the
longest word from left to right.  Weights are whole thousandths of the logarithm, so equal paths are equal;
of equal paths the one with the longer first word is taken.

A dictionary of counted size is sent to the tasks as a trie.  A larger one is joined: the substrings of the
texts meet the words by key, and each text is cut with the words it holds.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import text as tx

#: Bytes of the words of a dictionary that is sent to the tasks.
TRIE_BYTES = 1 << 24
WEIGHT_UNIT = 1000
_RUN = re.compile("[0-9a-zA-Z]+")
_END = ""

#: Words that begin at a place of a text, with their weights: ``(length, weight)``.
Words = Callable[[str, int], Iterable[tuple[int, int]]]


def word_weights(dictionary: DataFrame) -> DataFrame:
    """``(word, weight)``: thousandths of the logarithm of a word's share; ``dictionary`` has ``(word, n)``."""
    known = dictionary.filter((F.length("word") > 0) & (F.col("n") > 0)).groupBy("word").agg(F.sum("n").alias("n"))
    total = known.agg(F.sum("n").alias("total"))  # one row
    share = F.col("n").cast("double") / F.col("total")
    return known.crossJoin(F.broadcast(total)).select("word", F.floor(F.log(share) * WEIGHT_UNIT).cast("long").alias("weight"))


def trie(words: Iterable[tuple[str, int]]) -> dict:
    root: dict = {}
    for word, weight in words:
        node = root
        for c in word:
            node = node.setdefault(c, {})
        node[_END] = weight
    return root


def _from_trie(root: dict) -> Words:
    def found(text: str, at: int) -> Iterator[tuple[int, int]]:
        node = root
        for i in range(at, len(text)):
            node = node.get(text[i])
            if node is None:
                return
            if _END in node:
                yield i + 1 - at, node[_END]

    return found


def _rest(text: str, at: int) -> int:
    """Length of what stands at a place if no word does: a run, or one character."""
    run = _RUN.match(text, at)
    return run.end() - at if run else 1


def cut(text: str, words: Words, unknown: int, longest: bool) -> list[str]:
    """The tokens of one cleaned text, whose other characters are blanks."""
    step = [0] * len(text)
    if longest:
        for at in range(len(text)):
            step[at] = max((n for n, _ in words(text, at)), default=0) or _rest(text, at)
    else:
        best = [0] * (len(text) + 1)
        for at in range(len(text) - 1, -1, -1):
            choices = list(words(text, at))
            if text[at] == " ":
                choices.append((1, 0))
            else:
                choices.append((_rest(text, at), unknown))
            best[at], step[at] = max((w + best[at + n], n) for n, w in choices)
    out, at = [], 0
    while at < len(text):
        if text[at] != " " or step[at] > 1:
            out.append(text[at : at + step[at]])
        at += step[at]
    return out


def _cut_rows(words_of: Callable[[dict], Words], unknown: int, longest: bool):
    """Add the tokens of column 0; ``words_of`` gets the other column's value, if there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            held = b.column(2).to_pylist() if b.num_columns > 2 else [None] * len(texts)
            tokens = [None if t is None else cut(t, words_of(h), unknown, longest) for t, h in zip(texts, held)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(tokens, pa.list_(pa.string()))], ["text", "tokens"])

    return run


def segment(
    df: DataFrame, column: str, dictionary: DataFrame, out: str = "tokens", longest: bool = False, trie_bytes: int = TRIE_BYTES
) -> DataFrame:
    """``df`` with the tokens of a text column; ``dictionary`` has ``(word, n)``, of any size.

    Each distinct text is cut once.  Rows with a null text have no tokens, and an empty dictionary leaves runs
    and characters.
    """
    spark = df.sparkSession
    weights = word_weights(dictionary)
    n, size, lowest, lengths = weights.agg(
        F.count(F.lit(1)), F.sum(F.octet_length("word")), F.min("weight"), F.collect_set(F.length("word"))
    ).first()  # one row; as many lengths as words can have
    # Rarer than any word: less than half of the rarest one's share.
    unknown = (lowest or 0) - WEIGHT_UNIT
    texts = df.select(F.col(column).alias("text")).distinct().withColumn("cleaned", tx.clean(F.col("text"), " "))
    if (size or 0) <= trie_bytes:
        rows = weights.toArrow()
        held = spark.sparkContext.broadcast(trie(zip(rows["word"].to_pylist(), rows["weight"].to_pylist())) if n else {})

        def cut_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = _from_trie(held.value)
            yield from _cut_rows(lambda _: known, unknown, longest)(batches)

        tokens = texts.mapInArrow(cut_all, "text string, tokens array<string>")
    else:
        sizes = F.explode(F.array(*[F.lit(x) for x in sorted(lengths)]))
        places = texts.filter("cleaned is not null").withColumn("size", sizes).withColumn(
            "at", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("cleaned") - F.col("size") + 1)))
        )
        met = places.withColumn("word", F.substring("cleaned", F.col("at"), F.col("size"))).join(weights, "word")
        met = met.filter(F.length("word") == F.col("size"))
        words = met.groupBy(F.col("text").alias("of")).agg(F.collect_set(F.struct("word", "weight")).alias("words"))
        rows = texts.join(words, F.col("text").eqNullSafe(F.col("of")), "left").select("text", "cleaned", "words")

        def own(held: list | None) -> Words:
            return _from_trie(trie((h["word"], h["weight"]) for h in held or ()))

        tokens = rows.mapInArrow(_cut_rows(own, unknown, longest), "text string, tokens array<string>")
    named = tokens.select(F.col("text").alias("_text"), F.col("tokens").alias(out))
    return df.join(named, F.col(column).eqNullSafe(F.col("_text")), "left").drop("_text")
