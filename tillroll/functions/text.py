"""Cleaning and splitting of product names."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that survive cleaning, and the range of CJK ideographs.
KEPT = "0-9a-zA-Z\\u4e00-\\u9fff"
CJK = "\\u4e00-\\u9fff"
# End of fixed values.


def clean(col: Column, filler: str = "") -> Column:
    """Keep digits, Latin letters and CJK; every other run becomes ``filler``.

    Joining the kept runs takes a quarter of the time of replacing the others.
    """
    kept = F.regexp_extract_all(col, F.lit(f"[{KEPT}]+"), F.lit(0))
    body = F.array_join(kept, filler)
    if not filler:
        return body
    edge = f"[^{KEPT}]"
    first = F.when(F.substring(col, 1, 1).rlike(edge), filler).otherwise("")
    last = F.when(F.substring(col, -1, 1).rlike(edge), filler).otherwise("")
    only = F.when(F.length(col) > 0, filler).otherwise("")
    return F.when(F.size(kept) == 0, only).otherwise(F.concat(first, body, last))


def space_cjk(col: Column) -> Column:
    """A blank before every CJK character."""
    return F.regexp_replace(col, f"([{CJK}])", " $1")


def words(col: Column) -> Column:
    """Lower-cased words without empty ones; quotes go, punctuation stands apart."""
    text = F.lower(col)
    text = F.regexp_replace(text, '"', "")
    text = F.regexp_replace(text, "<br />|[;:]", " ")
    text = F.regexp_replace(text, "([.,()!?])", " $1 ")
    text = F.regexp_replace(text, "'", " '  ")
    return F.filter(F.split(text, "\\s+"), lambda w: w != "")


def name_tokens(col: Column) -> Column:
    """Tokens of a product name: single CJK characters and Latin/digit runs."""
    return spaced_tokens(clean(col))


def spaced_tokens(col: Column) -> Column:
    """Tokens of a text whose blanks separate words: punctuation counts as a blank.

    One pass over the text: a CJK character with the letters behind it, or a run of letters.
    """
    found = F.regexp_extract_all(col, F.lit(f"([{CJK}][0-9a-zA-Z]*|[0-9a-zA-Z]+)"))
    return F.transform(found, lambda w: F.lower(w))


def dictionary_tokens(col: Column, dictionary: Iterable[str]) -> Column:
    """Longest-match segmentation: dictionary words first, then Latin/digit runs, then characters.

    For a list of words at hand.  A large dictionary is a table: ``operators.segmenter``.
    """
    entries = sorted({w for w in dictionary if w}, key=lambda w: (-len(w), w))
    choices = [re.escape(w) for w in entries] + ["[0-9a-zA-Z]+", f"[{CJK}]"]
    return F.regexp_extract_all(clean(col, " "), F.lit(f"({'|'.join(choices)})"))


def with_bigrams(tokens: Column) -> Column:
    """The tokens followed by their bigrams."""
    pairs = F.transform(
        F.sequence(F.lit(1), F.size(tokens) - 1),
        lambda i: F.concat_ws(" ", F.element_at(tokens, i), F.element_at(tokens, i + 1)),
    )
    return F.when(F.size(tokens) > 1, F.concat(tokens, pairs)).otherwise(tokens)


def path_safe(col: Column) -> Column:
    """Slashes become underscores."""
    return F.translate(col, "/", "_")


def contains_any(col: Column, needles: Iterable[str]) -> Column:
    """Whether the text holds any of the needles."""
    condition = F.lit(False)
    for needle in needles:
        condition = condition | col.contains(needle)
    return condition


def starts_with_any(col: Column, needles: Iterable[str]) -> Column:
    condition = F.lit(False)
    for needle in needles:
        condition = condition | col.startswith(needle)
    return condition
