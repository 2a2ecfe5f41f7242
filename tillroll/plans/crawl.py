"""Saved product pages to de-duplicated records below their first tier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tillroll.operators import pages as pg
from tillroll.sources import sinks


def store_products(pages: DataFrame, path: str, data_date: Column) -> DataFrame:
    """Extract shop-A records, keep the first page of every link, write them by tier.

    Pages are parsed where they lie; only the records are shuffled, by the key of their link.  The
    records returned are read from what was written before, not parsed again.
    """
    first = pg.first_by_key(pg.product_records_a(pages, data_date), "hash_id", "page_id")
    kept = pg.with_tiers(first).filter("tier1 IS NOT NULL")
    sinks.write_records(kept, path)
    return kept
