"""Listings and counts over the shop tables, and the order batch update."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import one_to_many_left, orphans
from tidemark.operators.aggregates import tier


def delivered_split(orders: DataFrame) -> DataFrame:
    """Delivered and other orders in one row; a NULL status is in neither."""
    return orders.agg(
        F.count_if(F.col("status") == "Delivered").alias("delivered_orders"),
        F.count_if(F.col("status") != "Delivered").alias("not_delivered_orders"),
    )


def order_listing(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return orders.join(customers, "customer_id").select(
        "order_id", "order_date", "first_name", "last_name", "total_amount"
    )


def customers_with_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Every customer, with its orders if there are any."""
    who = customers.select("customer_id", "first_name", "last_name")
    what = orders.select("customer_id", "order_id", "order_date", "status")
    return one_to_many_left(who, what, "customer_id")


def item_detail(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    return (
        items.join(orders.select("order_id"), "order_id")
        .join(products.select("product_id", "product_name"), "product_id")
        .select("order_id", "product_name", "quantity", "unit_price_at_purchase", "discount_pct")
    )


def price_tier(price: Column, low: float = 1000, high: float = 3000) -> Column:
    return tier(price, [(price < low, "Budget"), (price.between(low, high), "Mid-Range")], "Premium")


def batch_problems(
    customers: DataFrame, products: DataFrame, new_orders: DataFrame, new_items: DataFrame
) -> DataFrame:
    """Why an order batch cannot be applied: one row per broken check with its number of cases."""
    wanted = new_items.groupBy("product_id").agg(F.sum("quantity").alias("wanted"))
    short = products.join(wanted, "product_id").filter(F.col("stock_qty") < F.col("wanted"))
    checks = {
        "unknown_customer": orphans(new_orders, "customer_id", customers),
        "unknown_order": orphans(new_items, "order_id", new_orders),
        "unknown_product": orphans(new_items, "product_id", products),
        "bad_quantity": new_items.filter(~F.coalesce(F.col("quantity") > 0, F.lit(False))),
        "short_stock": short,
    }
    out = None
    for name, rows in checks.items():
        one = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("problem"), "n")
        out = one if out is None else out.unionByName(one)
    return out.filter(F.col("n") > 0)


def apply_batch(
    customers: DataFrame, products: DataFrame, new_orders: DataFrame, new_items: DataFrame
) -> DataFrame:
    """Products with their stock after the batch; all of it or, if any check fails, none of it."""
    failed = batch_problems(customers, products, new_orders, new_items).agg(F.count(F.lit(1)).alias("_failed"))
    wanted = new_items.groupBy("product_id").agg(F.sum("quantity").alias("_wanted"))
    taken = F.when(F.col("_failed") == 0, F.coalesce(F.col("_wanted"), F.lit(0))).otherwise(0)
    return (
        products.join(wanted, "product_id", "left")
        .crossJoin(F.broadcast(failed))
        .withColumn("stock_qty", (F.col("stock_qty") - taken).cast("long"))
        .drop("_wanted", "_failed")
    )
