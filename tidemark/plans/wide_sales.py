"""Questions asked of wide sales rows: totals, rankings and best-of lists per customer and product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import to_double
from tidemark.operators import aggregates as agg
from tidemark.operators.ordering import number_by_day, with_rank
from tidemark.session import freeze


def customer_lines(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Sales and profit per order, with the customer who placed it."""
    per_order = lines.groupBy("order_id").agg(
        F.sum("sales").alias("sales"), F.sum("profit").alias("profit"), F.count(F.lit(1)).alias("n_lines"),
        F.max("sales").alias("best_sale"),
    )
    return per_order.join(orders.select("order_id", "customer_id"), "order_id")


def customer_totals(lines: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per customer: sales, profit, number of lines and of orders."""
    per_customer = (
        customer_lines(lines, orders)
        .groupBy("customer_id")
        .agg(
            F.sum("sales").alias("total_sales"),
            F.sum("profit").alias("total_profit"),
            F.sum("n_lines").alias("line_count"),
            F.count(F.lit(1)).alias("order_count"),
            F.max("best_sale").alias("highest_order_value"),
        )
    )
    return per_customer.join(customers.select("customer_id", "customer_name"), "customer_id")


def customers_above_average(totals: DataFrame) -> DataFrame:
    # the mean and the comparison both read the written totals, not the sales
    slim = freeze(totals.select("customer_id", "customer_name", "total_sales"))
    above = agg.above_average(slim, "total_sales")
    return above.withColumn("total_sales", to_double(F.col("total_sales")))


def ranked_customers(totals: DataFrame) -> DataFrame:
    """Every customer with the rank of its total sales; ties share a rank."""
    out = with_rank(totals.select("customer_id", "customer_name", "total_sales"), "total_sales", ["customer_id"],
                    "sales_rank")
    return out.withColumn("total_sales", to_double(F.col("total_sales")))


def top_ranked_customers(totals: DataFrame, ranks: int = 3) -> DataFrame:
    """Customers of rank 1 to `ranks`.

    The total in place `ranks` decides: whoever reaches it is in, and only those rows are ranked.
    """
    slim = freeze(totals.select("customer_id", "customer_name", "total_sales"))
    last = agg.top_k(slim, "total_sales", ranks, ["customer_id"]).agg(F.min("total_sales").alias("_last"))
    reached = slim.crossJoin(F.broadcast(last)).filter(F.col("total_sales") >= F.col("_last")).drop("_last")
    out = with_rank(reached, "total_sales", ["customer_id"], "sales_rank")
    return out.withColumn("total_sales", to_double(F.col("total_sales")))


def order_sequence(lines: DataFrame) -> DataFrame:
    """Number each customer's lines by date; lines of one day by order, line and product."""
    return number_by_day(
        lines, ["customer_id"], "order_date",
        ["order_id", "line_number", "product_id", "supplier_id", "quantity", "sales"], "order_number",
    )


def single_purchase_customers(totals: DataFrame, count: str = "order_count") -> DataFrame:
    """Customers seen once: by orders, or by lines with count='line_count'."""
    return totals.filter(F.col(count) == 1).select("customer_id", "customer_name", count)


def best_sales(lines: DataFrame) -> DataFrame:
    return agg.rows_with_group_max(lines, "customer_id", "sales")


def customers_per_segment(lines_per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct buying customers and mean line sale per segment."""
    per_customer = lines_per_customer.groupBy("customer_id").agg(
        F.sum("sales").alias("sales"), F.sum("n_lines").alias("n_lines")
    )
    joined = per_customer.join(customers.select("customer_id", "segment"), "customer_id")
    return joined.groupBy("segment").agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.round(F.sum("sales").cast("double") / F.sum("n_lines"), 4).alias("avg_sales"),
    )
