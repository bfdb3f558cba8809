"""Tidying of a shop catalogue and of a sales sample with gaps and copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cleaning import drop_nulls, fill_medians, fill_modes, fill_values, full_row_dedup

# What a gap in a descriptive column reads as.
NOT_AVAILABLE = "Not Available"


def clean_sample(sample: DataFrame) -> DataFrame:
    """Medians and modes come from the rows as delivered, copies included; copies go last."""
    filled = fill_modes(fill_medians(sample, {"price": False, "quantity": True}), ["region", "ship_mode"])
    rows = full_row_dedup(drop_nulls(filled, ["order_id"]))
    return rows.withColumn("total_amount", F.col("price") * F.col("quantity"))


def clean_listing(products: DataFrame, numbers: dict[str, int], texts: list[str]) -> DataFrame:
    """Constant fills for a product listing, one row per product."""
    return fill_values(products, {**numbers, **{t: NOT_AVAILABLE for t in texts}})
