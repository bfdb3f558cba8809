"""Cleaning and totals over point-of-sale rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cleaning import fill_values, full_row_dedup


def average_by_category(rows: DataFrame, region: str) -> DataFrame:
    return (
        rows.filter(F.col("region") == region)
        .groupBy("product_category")
        .agg(F.round(F.sum("sale_amount").cast("double") / F.count("sale_amount"), 4).alias("average_sale_amount"))
    )


def busy_cities(rows: DataFrame, more_than: int = 100) -> DataFrame:
    return rows.groupBy("city").agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > more_than)


def valid_users(rows: DataFrame) -> DataFrame:
    """Rows with an e-mail and a non-blank user name."""
    return rows.filter(F.col("email").isNotNull() & (F.coalesce(F.trim("username"), F.lit("")) != ""))


def revenue_per_store(rows: DataFrame) -> DataFrame:
    """Exact copies count once, a missing price counts as zero."""
    return (
        fill_values(full_row_dedup(rows), {"price": 0})
        .groupBy("store_id")
        .agg(F.sum("price").cast("double").alias("total_revenue"))
    )
