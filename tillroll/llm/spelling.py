"""Spelling variants of words, found with blocked Gram matrices of letter counts.

The squared distance of two words' letter counts is 1 if one has a letter more and 2 if one letter is
replaced, so the near pairs (one code point inserted, deleted or replaced) are among the pairs at most two
apart.  Distances come from matrix products of the letter counts of blocks, and what they leave is verified
letter by letter.

A block holds the words of one length that also agree in how many letters fall into each of ``GROUPS``
letter groups.  One edit changes the length by at most one and moves at most one letter between groups, so
a word meets its own block and the few adjacent ones: longer by one, or with one letter moved.  Each word
visits the adjacent blocks on one side only; a pair meets once.  Large blocks are cut into tiles of residents
and visitors.  Every task reports counts and best partners per word, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import broadcast_keys, lower_ascii
from tillroll.session import materialize

#: Letter groups of a block's key: a code point belongs to the group of its remainder.
GROUPS = 5
#: Residents of a tile, and visitors that one task compares with them.
RESIDENTS, VISITORS = 2048, 1 << 16
#: Visitors of one matrix product.
_STEP = 1024
#: Odd factors of the letter groups in the 64-bit key of a block.
_FACTORS = np.random.default_rng(12).integers(1, 1 << 62, 64, dtype=np.int64) * 2 + 1
_OWN = 0


def runs(text: Column, least: int) -> Column:
    """Maximal runs of Latin letters of at least ``least`` code points, lower-cased in A-Z."""
    return F.regexp_extract_all(lower_ascii(text), F.lit(f"[a-z\\u00C0-\\u00FF]{{{least},}}"), F.lit(0))


def counted(words: DataFrame, word: str, least_length: int, least_n: int) -> DataFrame:
    """``(word, n)`` of the words that are long and frequent enough."""
    long_enough = words.filter(F.char_length(word) >= least_length)
    return long_enough.groupBy(F.col(word).alias("word")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_n)


def _codes(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length: a row per word."""
    if not length:
        return np.zeros((len(words), 0), np.uint32)
    return np.array(words, f"<U{length}").view(np.uint32).reshape(len(words), length)


def _groups(codes: np.ndarray, groups: int) -> np.ndarray:
    """How many letters of each word fall into each letter group."""
    cell = np.arange(len(codes))[:, None] * groups + codes % groups
    return np.bincount(cell.ravel().astype(np.int64), minlength=len(codes) * groups).reshape(-1, groups)


def _moves(groups: int) -> np.ndarray:
    """What each kind of visit adds to the counts of the groups: nothing, one letter, or a letter moved up."""
    unit = np.eye(groups, dtype=np.int64)
    moved = [unit[j] - unit[i] for i in range(groups) for j in range(i + 1, groups)]
    return np.array([unit[0] * 0, *unit, *moved])


def _visits(groups: int):
    """Residents (kind -1) and visitors of all blocks, by the block's key."""
    moves = _moves(groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = np.array(batch.column(0).to_pylist(), object)
            n = batch.column(1).to_numpy(zero_copy_only=False)
            lengths = np.array([len(w) for w in words], np.int64)
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                held = _groups(_codes(words[at].tolist(), int(length)), groups)
                kinds = np.arange(-1, len(moves), dtype=np.int32)
                # A visit that takes a letter out of an empty group leads nowhere.
                reached = held[:, None, :] + np.concatenate([moves[:1] * 0, moves])[None]
                row, kind = np.nonzero((reached >= 0).all(2))
                with np.errstate(over="ignore"):
                    key = reached[row, kind] @ _FACTORS[:groups] + (length + (kinds[kind] > 0) * (kinds[kind] <= groups)) * _FACTORS[-1]
                yield pa.RecordBatch.from_pydict(
                    {"key": key, "kind": kinds[kind], "word": pa.array(words[at][row].tolist(), pa.string()), "n": n[at][row]}
                )

    return run


def _counts(codes: list[np.ndarray]) -> list[np.ndarray]:
    """Letter counts over the letters that occur, for several sets of words."""
    letters = np.unique(np.concatenate([c.ravel() for c in codes]))
    kind = np.float32 if all(c.shape[1] < 1024 for c in codes) else np.float64  # exact either way
    out = []
    for c in codes:
        cell = np.arange(len(c))[:, None] * len(letters) + np.searchsorted(letters, c)
        out.append(np.bincount(cell.ravel(), minlength=len(c) * len(letters)).reshape(len(c), len(letters)).astype(kind))
    return out


def _near(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in two sets of words of equal length, or ``b`` shorter by one, that one edit parts."""
    grams_a, grams_b = _counts([a, b])
    square = (grams_a * grams_a).sum(1)[:, None] + (grams_b * grams_b).sum(1)[None] - 2 * (grams_a @ grams_b.T)
    i, j = np.nonzero(square <= 2)
    left, right = a[i], b[j]
    if a.shape[1] == b.shape[1]:
        good = (left != right).sum(1) == 1
    else:
        width = b.shape[1]
        before = np.logical_and.accumulate(left[:, :width] == right, axis=1).sum(1)
        after = np.logical_and.accumulate(left[:, :0:-1] == right[:, ::-1], axis=1).sum(1)
        good = before + after >= width
    return i[good], j[good]


class _Best:
    """Number of near words, and the best of them, of every word that was met."""

    def __init__(self) -> None:
        self.found: dict[str, list] = {}

    def add(self, words: np.ndarray, near: np.ndarray, n: np.ndarray) -> None:
        for word, other, count in zip(words.tolist(), near.tolist(), n.tolist()):
            own = self.found.get(word)
            if own is None:
                self.found[word] = [1, count, other]
            else:
                own[0] += 1
                if count > own[1] or count == own[1] and other < own[2]:
                    own[1:] = count, other

    def batch(self) -> pa.RecordBatch:
        rows = [(w, *x) for w, x in self.found.items()]
        self.found = {}
        columns = list(zip(*rows)) or [[], [], [], []]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["word", "n_near", "best_n", "best"]
        )


def _compare(groups: int):
    """Near words per tile; rows of a tile come one after another, residents first."""
    moves = _moves(groups)

    def meet(best: _Best, kinds, words, n, codes, res_words, res_n, res_codes) -> None:
        """Visitors of one length against the residents of their block."""
        for at in range(0, len(words), _STEP):
            part = slice(at, at + _STEP)
            i, j = _near(res_codes, codes[part])
            # Keys are hashes of counts: a pair counts only where this visit leads, and once in its own block.
            led = _groups(res_codes[i], groups) - _groups(codes[part][j], groups) == moves[kinds[part][j]]
            right = led.all(1) & ((kinds[part][j] != _OWN) | (res_words[i] < words[part][j]))
            i, j = i[right], j[right]
            best.add(res_words[i], words[part][j], n[part][j])
            best.add(words[part][j], res_words[i], res_n[i])

    def tile(best: _Best, kinds: np.ndarray, words: np.ndarray, n: np.ndarray) -> None:
        lengths = np.array([len(w) for w in words], np.int64)
        longer = (kinds > 0) & (kinds <= groups)
        for length in np.unique(lengths[kinds < 0]):
            res = np.flatnonzero((kinds < 0) & (lengths == length))
            res_codes = _codes(words[res].tolist(), int(length))
            for more in (0, 1):
                own = np.flatnonzero((kinds >= 0) & (longer == more) & (lengths == length - more))
                if len(own):
                    codes = _codes(words[own].tolist(), int(length) - more)
                    meet(best, kinds[own], words[own], n[own], codes, words[res], n[res], res_codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        best = _Best()

        def flush() -> None:
            if held:
                rows = pa.Table.from_batches(held)
                tile(
                    best,
                    rows["kind"].to_numpy(),
                    np.array(rows["word"].to_pylist(), object),
                    rows["n"].to_numpy(),
                )
                held.clear()

        last = None
        for batch in batches:
            ids = np.stack([batch.column(c).to_numpy() for c in range(3)], 1)
            cuts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(1)) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    if last is not None and tuple(ids[a]) != last:
                        flush()
                    held.append(batch.slice(a, b - a))
                    last = tuple(ids[a])
            if len(best.found) > 50_000:
                yield best.batch()
        flush()
        yield best.batch()

    return run


def near_words(
    words: DataFrame, groups: int = GROUPS, residents: int = RESIDENTS, visitors: int = VISITORS
) -> DataFrame:
    """``(word, n_near, best, best_n)`` of the words that have a near word.

    ``words``: distinct words with their number ``n``.  ``best`` is the near word of largest ``n``, of
    equal ones the smallest in code-point order.
    """
    visits = materialize(
        words.select("word", F.col("n").cast("long").alias("n")).mapInArrow(
            _visits(groups), "key long, kind int, word string, n long"
        )
    )
    is_resident = F.col("kind") < 0
    r, v = F.count_if(is_resident), F.count_if(~is_resident)
    # A block without residents, or whose only visitor is its one resident, has no pair.
    sizes = visits.groupBy(F.col("key").alias("block")).agg(
        F.ceil(r / residents).alias("across"), F.ceil(v / visitors).alias("down"), ((r > 0) & (v > 1)).alias("some")
    )
    sizes = materialize(sizes.filter("some").drop("some"))
    cut = visits.join(broadcast_keys(sizes, F.lit(24)), F.col("key") == F.col("block"))
    own = lambda tiles: F.array(F.pmod(F.xxhash64("word"), tiles).cast("int"))
    every = lambda tiles: F.sequence(F.lit(0), (tiles - 1).cast("int"))
    across, down = F.col("across"), F.col("down")
    tiled = cut.withColumn("r", F.explode(F.when(is_resident, own(across)).otherwise(every(across)))).withColumn(
        "v", F.explode(F.when(is_resident, every(down)).otherwise(own(down)))
    )
    rows = tiled.select("key", "r", "v", "kind", "word", "n").repartition("key", "r", "v")
    found = rows.sortWithinPartitions("key", "r", "v", "kind").mapInArrow(
        _compare(groups), "word string, n_near long, best_n long, best string"
    )
    first = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best"))).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first).select(
        "word", "n_near", F.col("first.best").alias("best"), (-F.col("first.n")).alias("best_n")
    )


def _roots(forms: DataFrame, steps: int) -> DataFrame:
    """``(word, root)``: the end of the chain of forms, by doubling the pointers ``steps`` times."""
    roots = materialize(forms.select("word", F.col("form").alias("root")))
    for _ in range(steps):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = materialize(
            roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        )
    return roots


def variants(
    words: DataFrame,
    ratio: int = 5,
    groups: int = GROUPS,
    residents: int = RESIDENTS,
    visitors: int = VISITORS,
) -> DataFrame:
    """Spelling groups of distinct words: ``(word, form, root, n, n_near, form_n)``.

    ``words``: ``(word, n)``.  Two words are near if exactly one inserted, deleted or replaced code point
    parts them.  A word's form is its near word of largest ``n`` (ties: the smallest in code-point order) if
    that is at least ``ratio`` times its own; otherwise null.  The root is the last word of the chain of
    forms.  Rows with a null word or number are left out, repeated words count as one with the sum of their
    numbers; other columns are left out, and an empty table gives no rows.
    """
    if ratio < 2:
        raise ValueError("a form needs at least twice the number")
    words = words.filter("word is not null and n is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    words = materialize(words)
    near = near_words(words, groups, residents, visitors)
    takes = F.col("best_n") >= ratio * F.col("n")
    marked = materialize(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(takes, F.col("best")).alias("form"),
            F.when(takes, F.col("best_n")).alias("form_n"),
        )
    )
    # Numbers grow along a chain by the ratio at least, which bounds its length.
    lowest, highest = words.agg(F.min("n"), F.max("n")).first()
    longest, at = 0, max(1, lowest or 1)
    while at * ratio <= (highest or 0):
        longest, at = longest + 1, at * ratio
    roots = _roots(marked.filter("form is not null"), longest.bit_length())
    return marked.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
