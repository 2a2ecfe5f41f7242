"""Prompts before and structured answers after a text generator."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted_list(values: Column) -> Column:
    """Array of texts as ``"a", "b",`` with inner quotes removed."""
    return F.array_join(
        F.transform(values, lambda x: F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit("")), F.lit('",'))),
        " ",
    )


def prompt(template: str, **columns: Column) -> Column:
    """Fill ``{name}`` marks of a template with columns; ``{{`` and ``}}`` stand for braces.

    A null column fills in nothing; the rest of the prompt stays.
    """
    parts = []
    for piece in re.split(r"(\{\{|\}\}|\{\w+\})", template):
        if piece in ("{{", "}}"):
            parts.append(F.lit(piece[0]))
        elif re.fullmatch(r"\{\w+\}", piece) and piece[1:-1] in columns:
            parts.append(F.coalesce(columns[piece[1:-1]].cast("string"), F.lit("")))
        else:
            parts.append(F.lit(piece))
    return F.concat(*parts)


def json_object(reply: Column) -> Column:
    """From the first to the last brace of a reply, on one line; null without braces."""
    flat = F.translate(reply, "\n", " ")
    found = F.regexp_extract(flat, r"(?s)(\{.*\})", 1)
    return F.when(found != "", found)


def json_list(reply: Column, key: str) -> Column:
    """The list under ``key`` in the JSON object of a reply; null where either is missing."""
    parsed = F.from_json(json_object(reply), f"struct<`{key}`: array<string>>")
    return parsed[key]


def without_given(values: Column, n_given: Column) -> Column:
    """Skip the samples that the prompt had given."""
    return F.slice(values, n_given + 1, F.greatest(F.size(values) - n_given, F.lit(0)))


def numbered_list(reply: Column) -> Column:
    """Values of a reply such as ``{"1": "a", "2": "b"}``.

    If the reply is no JSON, the text between the first brace and the next closing one is tried.
    """
    kind = "map<string, string>"
    inner = F.split_part(F.split_part(reply, F.lit("{"), F.lit(2)), F.lit("}"), F.lit(1))
    repaired = F.when(reply.contains("{"), F.concat(F.lit("{"), inner, F.lit("}")))
    whole = F.from_json(reply, kind)
    return F.map_values(F.coalesce(whole, F.from_json(repaired, kind)))
