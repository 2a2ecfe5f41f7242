"""License scans: exact phrases of words, and short notices within a bounded number of edits.

A text is brought to one line of lower-cased words with single blanks.  A notice within ``k`` edits
contains at least one of its ``k + 1`` pieces unchanged, so only places around a piece are looked at:
there the ``regex`` library's bounded-error matching verifies the edits and gives the span.  Where
notices overlap, the one with fewer edits for its length stays.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import arrow_batches

# Phrases that count exactly, as given.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Short notices that are searched with edits, and their labels.
NOTICES = {
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution noncommercial": "cc-by-nc",
    "licensed under cc by 4 0": "cc-by",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under the gnu general public license version 3": "gpl-3",
    "licensed under the gnu general public license version 2": "gpl-2",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license version 2 0": "mpl-2",
    "all rights reserved": "all-rights-reserved",
}
#: One edit for so many characters of a notice.
CHARS_PER_EDIT = 10
_SPACE = bytes(c if chr(c).isascii() and chr(c).isalnum() or c >= 0x80 else 0x20 for c in range(256))


def word_line(text: str | None) -> str:
    """Lower-cased words with single blanks, and one blank at either end; a blank for no words."""
    parts = (text or "").encode("utf-8", "replace").lower().translate(_SPACE).split()
    return b"".join([b" ", *[p + b" " for p in parts]]).decode()


@dataclass
class Notice:
    """A notice with its pieces and its bounded-error pattern."""

    words: str
    label: str
    edits: int = field(init=False)

    def __post_init__(self) -> None:
        self.edits = len(self.words) // CHARS_PER_EDIT

    @cached_property
    def pieces(self) -> list[tuple[int, str]]:
        """``edits + 1`` pieces of nearly equal length with their offsets."""
        n = self.edits + 1
        cuts = [round(k * len(self.words) / n) for k in range(n + 1)]
        return [(a, self.words[a:b]) for a, b in zip(cuts, cuts[1:])]

    @cached_property
    def pattern(self) -> regex.Pattern:
        near = rf"(?:{regex.escape(self.words, literal_spaces=True)}){{e<={self.edits}}}"
        return regex.compile(rf"(?<= )({near})(?= )", regex.ENHANCEMATCH)


def _windows(line: str, notice: Notice) -> list[list[int]]:
    """Stretches of the line that can hold the notice, joined where they overlap."""
    spots = set()
    for offset, piece in notice.pieces:
        at = line.find(piece)
        while at >= 0:
            spots.add(at - offset)
            at = line.find(piece, at + 1)
    out: list[list[int]] = []
    slack = 2 * notice.edits + 2
    for at in sorted(spots):
        lo, hi = max(0, at - slack), min(len(line), at + len(notice.words) + slack)
        if out and lo <= out[-1][1]:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
    return out


def find_notices(line: str, notices: list[Notice]) -> list[tuple[int, int, str, int, int]]:
    """``(start, end, label, edits, length)`` of the notices in a word line, in order, not overlapping.

    A notice starts and ends with whole words.
    """
    found = []
    for notice in notices:
        for lo, hi in _windows(line, notice):
            for m in notice.pattern.finditer(line[lo:hi]):
                found.append((lo + m.start(1), lo + m.end(1), notice.label, sum(m.fuzzy_counts), len(notice.words)))
    kept: list[tuple[int, int, str, int, int]] = []
    for hit in sorted(found, key=lambda h: (h[3] / h[4], -h[4], h[0], h[2])):
        at = bisect(kept, hit[:1])
        clear_before = at == 0 or kept[at - 1][1] <= hit[0]
        if clear_before and (at == len(kept) or hit[1] <= kept[at][0]):
            kept.insert(at, hit)
    return kept


def places(line: str, phrase: str) -> list[int]:
    """Character places where the words of the phrase stand consecutively."""
    out, at = [], line.find(f" {phrase} ")
    while at >= 0:
        out.append(at + 1)
        at = line.find(f" {phrase} ", at + 1)
    return out


def scan_text(text: str | None, phrases: dict[str, str], notices: list[Notice]) -> dict:
    """What one text holds; see ``scan``."""
    line = word_line(text)

    def word_at(char: int) -> int:
        return line.count(" ", 0, char) - 1

    exact = [(at, label) for phrase, label in phrases.items() for at in places(line, phrase)]
    found = find_notices(line, notices)
    base = {label for _, label in exact}
    fit = [1 - h[3] / h[4] for h in found] + [1.0] * bool(exact)
    return {
        "n_words": line.count(" ") - 1,
        "n_base": len(exact),
        "first_word": word_at(min(exact)[0]) if exact else None,
        "last_word": word_at(max(exact)[0]) if exact else None,
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(base | {h[2] for h in found})),
        "score": max(fit, default=0.0),
        "spans": [{"label": h[2], "first": word_at(h[0]), "last": word_at(h[1]), "edits": h[3]} for h in found],
    }


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    phrases: dict[str, str] | None = None,
    notices: dict[str, str] | None = None,
) -> DataFrame:
    """One row per document row: exact phrases, labels, and the spans of notices found with edits.

    ``(id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans)``; words count
    from 0, ``last`` of a span is exclusive, ``score`` is 1 for an exact phrase, else the best share of
    a notice without edits, 0 for none.  Null and empty texts have no words, no labels and score 0.
    """
    exact = PHRASES if phrases is None else phrases
    fuzzy = NOTICES if notices is None else notices
    own = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    kind = own.schema["id"].dataType.simpleString()
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Notice(words, label) for words, label in fuzzy.items()]
        for b in batches:
            rows = pa.array([scan_text(t, exact, known) for t in b.column(1).to_pylist()], _FOUND)
            yield pa.RecordBatch.from_arrays([b.column(0), *rows.flatten()], names=["id", *_FOUND.names])

    columns = ", ".join(f"{c} {k}" for c, k in _COLUMNS.items())
    return own.mapInArrow(run, f"id {kind}, {columns}").withColumnRenamed("id", id_column)


_COLUMNS = {
    "n_words": "long",
    "n_base": "long",
    "first_word": "long",
    "last_word": "long",
    "base_labels": "string",
    "labels": "string",
    "score": "double",
    "spans": "array<struct<label:string,first:long,last:long,edits:long>>",
}
_SPAN = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("edits", pa.int64())])
_ARROW = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
_FOUND = pa.struct([(c, _ARROW.get(k, pa.list_(_SPAN))) for c, k in _COLUMNS.items()])
