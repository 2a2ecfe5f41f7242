"""Recency, frequency and monetary levels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

LETTERS = ["r", "f", "m"]

# They must equal the reference's for right results.
LEVEL_NAMES = {
    "111": "重要價值",
    "101": "重要發展",
    "011": "重要保持",
    "001": "重要挽留",
    "110": "一般價值",
    "100": "一般發展",
    "010": "一般保持",
    "000": "一般挽留",
}
# End of fixed values.


def level_flag(letter: str, value: Column, split: Column) -> Column:
    """``1`` on the good side of the split, which itself is good; low recency is good."""
    good = value <= split if letter == "r" else value >= split
    return F.when(good, "1").otherwise("0")


def kept_letters(letters: list[str] | None) -> list[str]:
    """All three letters, or all but the first one that is missing from ``letters``."""
    if letters is None:
        return LETTERS
    missing = next((x for x in LETTERS if x not in letters), None)
    return [x for x in LETTERS if x != missing]


def level_name(level: Column) -> Column:
    """Segment name of a three-digit level."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(LEVEL_NAMES.items())])[level]
