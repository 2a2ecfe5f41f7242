"""Language ID with language-bitmask n-gram filters.

One Bloom filter per language, bit-sliced: a cell holds a mask with one bit per language, so the AND
of an n-gram's cells returns all languages that contain it at once.  A text's n-grams are counted per
language; the filters' false positives, known from how full they are, are taken off; the language that
contains most of the text decides.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import arrow_batches

UNKNOWN = "und"
#: Lengths of the character n-grams; a blank stands for the edge of a word.
SIZES = (3,)
#: Bound of the labelled rows per language that the filters are fitted on, chosen by a hash of the id.
FIT_ROWS = 1000
#: A language contains an n-gram that makes up this share of its n-grams ...
MIN_RATE = 1e-5
#: ... and at least this share of the language that uses it most.
MIN_RATIO = 0.25
#: Share of a text's n-grams that some language has to contain, or else the text is in none of them.
LEAST_SCORE = 0.25
CELLS = 1 << 18
PROBES = 3
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_PIECE = 1 << 20


#: Code points from here on are no letters.
_NO_MORE_LETTERS = 0x32400


def letter_table() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(_NO_MORE_LETTERS + 1)])


def _grams(text: str, letters: np.ndarray, sizes: tuple[int, ...] = SIZES) -> Iterator[np.ndarray]:
    """Hashes of the n-grams of a text, a piece at a time; pieces overlap, so none is lost or doubled."""
    lowered = text.lower()
    widest = max(sizes)
    points = np.frombuffer(lowered.encode("utf-32-le", "replace"), np.uint32)
    points = np.where(letters[np.minimum(points, _NO_MORE_LETTERS)], points, 0)
    points = np.concatenate([[0], points, [0]]).astype(np.uint64)
    points = points[np.append(True, (points[1:] != 0) | (points[:-1] != 0))]
    for start in range(0, len(points), _PIECE):
        piece = points[start : start + _PIECE + widest - 1]
        for n in sizes:
            m = min(_PIECE, len(piece) - n + 1)
            if m <= 0:
                continue
            mixed, inner = np.full(m, n, np.uint64), np.ones(m, bool)
            for k in range(n):
                here = piece[k : k + m]
                mixed = (mixed ^ here) * _MULTIPLIERS[k % len(_MULTIPLIERS)]
                mixed ^= mixed >> np.uint64(29)
                inner &= (here != 0) | (k in (0, n - 1))
            # From three on, what lies between two blanks is a whole word.
            yield mixed[inner if n > 2 else inner & ((piece[:m] != 0) | (piece[n - 1 : n - 1 + m] != 0))]


def _cells(grams: np.ndarray, cells: int, probes: int) -> list[np.ndarray]:
    return [((grams * _MULTIPLIERS[j]) >> np.uint64(40)).astype(np.int64) % cells for j in range(probes)]


@dataclass
class Filters:
    """Bit-sliced filters: ``masks[w, cell]`` holds the bits of languages ``64 * w`` and on."""

    languages: list[str]
    masks: np.ndarray
    false_share: np.ndarray
    probes: int = PROBES
    sizes: tuple[int, ...] = SIZES
    letters: np.ndarray = field(default_factory=letter_table, repr=False)

    def counts(self, text: str) -> tuple[int, np.ndarray]:
        """Number of n-grams of the text, and how many of them each language contains."""
        total, own = 0, np.zeros(len(self.languages))
        for grams in _grams(text, self.letters, self.sizes):
            total += len(grams)
            at = _cells(grams, self.masks.shape[1], self.probes)
            for w, row in enumerate(self.masks):
                found = row[at[0]]
                for a in at[1:]:
                    found &= row[a]
                for bit in range(min(64, len(self.languages) - 64 * w)):
                    own[64 * w + bit] += np.count_nonzero(found & np.uint64(1 << bit))
        return total, own

    def decide(self, text: str | None) -> tuple[str, float]:
        """Language and the share of the text's n-grams that it contains, false positives taken off."""
        if not self.languages or not text:
            return UNKNOWN, 0.0
        total, own = self.counts(text)
        if not total:
            return UNKNOWN, 0.0
        share = (own / total - self.false_share) / (1 - self.false_share)
        best = int(share.argmax())  # a tie goes to the smaller code
        return self.languages[best], float(min(1.0, max(0.0, share[best])))


def is_held_out(id_column: Column) -> Column:
    """Whether the row is kept out of learning; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def fit(
    labelled: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    fit_rows: int = FIT_ROWS,
    sizes: tuple[int, ...] = SIZES,
    min_rate: float = MIN_RATE,
    min_ratio: float = MIN_RATIO,
    cells: int = CELLS,
    probes: int = PROBES,
) -> Filters:
    """Filters of the languages in ``labelled``, from about ``fit_rows`` whole texts of each.

    Rows with a null text or language are not used.  Without any row there is no language, and every
    text is unknown.
    """
    rows = labelled.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(id_column).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
    )
    sizes_of = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes_of)
    if not languages:
        return Filters([], np.zeros((1, cells), np.uint64), np.zeros(0), probes, sizes)
    # The share of each language that the bound leaves; the hash of the id decides.
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, fit_rows / sizes_of[k]))])
    draw = F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = rows.filter(draw < share[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for b in batches:
            by_lang: dict[str, Counter] = {}
            for name, words in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for grams in _grams(words, letters, sizes):
                    value, n = np.unique(grams, return_counts=True)
                    by_lang.setdefault(name, Counter()).update(dict(zip(value.tolist(), n.tolist())))
            for name, found in by_lang.items():
                gram = np.array(list(found), np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(gram)), pa.array(gram), pa.array(list(found.values()), pa.int64())],
                    names=["lang", "gram", "n"],
                )

    arrow_batches(labelled.sparkSession)
    counted = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # One row per n-gram with the counts of all languages; at most the n-grams of the bounded sample.
    wide = counted.groupBy("gram").agg(*[F.sum(F.when(F.col("lang") == k, F.col("n"))).alias(f"n{i}") for i, k in enumerate(languages)])
    table = wide.orderBy("gram").toPandas()
    n = table[[f"n{i}" for i in range(len(languages))]].fillna(0).to_numpy(float)
    rate = n / np.maximum(n.sum(0), 1)
    member = (rate >= min_rate) & (rate >= min_ratio * rate.max(1, keepdims=True)) & (n > 0)
    grams = table["gram"].to_numpy(np.int64).view(np.uint64)
    masks = np.zeros((-(-len(languages) // 64), cells), np.uint64)
    for i in range(len(languages)):
        for at in _cells(grams[member[:, i]], cells, probes):
            masks[i // 64, at] |= np.uint64(1 << (i % 64))
    full = [np.count_nonzero(masks[i // 64] & np.uint64(1 << (i % 64))) / cells for i in range(len(languages))]
    return Filters(languages, masks, np.array(full) ** probes, probes, sizes)


def predicted(filters: Filters, text: Column, spark: SparkSession) -> Column:
    """``(lang_pred, score)`` of a text column; a text that is null or has no letter is ``und``, 0."""
    parts = (filters.languages, filters.masks, filters.false_share, filters.probes, filters.sizes)
    held = spark.sparkContext.broadcast(parts)  # some MB, whatever the data
    arrow_batches(spark)

    @F.pandas_udf("lang_pred string, score double")
    def decide(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Filters(*held.value)
        for part in texts:
            yield pd.DataFrame([own.decide(t) for t in part], columns=["lang_pred", "score"])

    return decide(text.cast("string"))


def fit_not_held_out(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang", **options
) -> Filters:
    """Filters learned from the labelled rows that are not held out."""
    return fit(docs.filter(~is_held_out(F.col(id_column))), id_column, text, lang, **options)


def predict(docs: DataFrame, filters: Filters, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: ``(id, held_out, lang_pred, score)``."""
    found = docs.select(
        F.col(id_column),
        is_held_out(F.col(id_column)).alias("held_out"),
        predicted(filters, F.col(text), docs.sparkSession).alias("found"),
    )
    return found.select(id_column, "held_out", "found.lang_pred", "found.score")


def keep_known(docs: DataFrame, filters: Filters, text: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """``docs`` in a language the filters know; all columns.

    A text goes if it is null, has no letter, or if no language contains ``least`` of its n-grams.
    """
    found = predicted(filters, F.col(text), docs.sparkSession)
    known = docs.withColumn("__found", found).filter(
        (F.col("__found.lang_pred") != UNKNOWN) & (F.col("__found.score") >= least)
    )
    return known.drop("__found")
