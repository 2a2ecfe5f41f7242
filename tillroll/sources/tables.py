"""Explicit schemas and readers for warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "member": "mid string, birthday date, home_city string, gender string",
    "pos_line": (
        "mid string, pma_no_fin string, rec_no string, data_date date, sale_time string, "
        "store_no string, job_id string, item_cont int, mm_sales double"
    ),
    "festival": "start_date date",
    "store": (
        "store_no string, old_store_no string, address string, master_area_no string, "
        "eff_date_from date, eff_date_to string, store_test_flag string"
    ),
    "area": "master_area_no string, area_name string, eff_date_to string",
    "category_name": "pma_no string, pma_name string",
    "area_stores": "master_area_no string, master_area_name string, cnt int",
    "class_hierarchy": "major_no int, major string, sub_no int, sub string",
    "product": "product string",
    "pages": "page_id long, url string, html string",
    "crawled_category": (
        "tier1_category_name string, tier2_category_name string, tier3_category_name string, "
        "tier4_category_name string, category_link string, category_type string"
    ),
}


def read_table(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """Parquet table at ``path``; ``name`` adds the known warehouse schema."""
    reader = spark.read.schema(SCHEMAS[name]) if name else spark.read
    return reader.parquet(path)
