"""Every runnable query over the given tables, with SQL where SQL can express it."""

from tillroll.registry import (  # noqa: F401
    crawl,
    files,
    groups,
    learning,
    relational,
    similarity,
    text,
    workflow,
)
from tillroll.registry.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
