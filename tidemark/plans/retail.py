"""Reports over orders, order items, products and customers.

Cancelled and returned orders bring no revenue and are left out unless a report says otherwise. Money is
summed as DECIMAL and turned into DOUBLE at the end. Items are summed per order or per product before they
meet another table, so a busy customer or product is already small when rows are regrouped.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import percent, to_double
from tidemark.operators.joins import looked_up, spread
from tidemark.operators.ordering import with_ntiles
from tidemark.session import freeze

NO_REVENUE = ("Cancelled", "Returned")


def earning(orders: DataFrame) -> DataFrame:
    return orders.filter(~F.col("status").isin(*NO_REVENUE))


def line_value() -> Column:
    return F.col("quantity") * F.col("unit_price_at_purchase")


def month_of(date: str) -> Column:
    return F.date_format(F.col(date), "yyyy-MM")


def order_totals(items: DataFrame) -> DataFrame:
    # items are dealt first: a task that sums them as they are read meets nearly all of its rows' orders, and holds them all
    return spread(items, "order_id", always=True).groupBy("order_id").agg(F.sum(line_value()).alias("order_total"))


def order_values(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per earning order that has items."""
    return looked_up(earning(orders)).join(order_totals(items), "order_id")


def stored_values(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables of REPORTS with the order values that three of them start from, written once."""
    values = order_values(tables["orders"], tables["items"]).select("order_id", "customer_id", "order_date", "order_total")
    return {**tables, "values": freeze(values)}


def revenue_by_category(orders: DataFrame, items: DataFrame, products: DataFrame, dealt: bool = False) -> DataFrame:
    """dealt tells that items lie in enough buckets of the order id already."""
    # a task that counts distinct orders holds all pairs of category and order that it meets, nearly as many as items
    placed = earning(orders).select("order_id")
    if not dealt:
        items, placed = spread(items, "order_id"), looked_up(placed)
    kept = items.join(placed, "order_id")
    # rows are combined per (category, order) before the shuffle of the distinct count
    return (
        kept.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(
            F.count_distinct("order_id").alias("orders_with_category"),
            F.sum("quantity").alias("units_sold"),
            to_double(F.sum(line_value())).alias("revenue"),
        )
    )


def monthly_revenue(values: DataFrame) -> DataFrame:
    return (
        values.groupBy(month_of("order_date").alias("order_month"))
        .agg(F.round(F.sum("order_total"), 2).alias("revenue"))
    )


def monthly_trend(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue per month and growth over the previous month that has revenue."""
    return trend_of(order_values(orders, items))


def trend_of(values: DataFrame) -> DataFrame:
    # one row per calendar month: the un-partitioned window stays small
    by_month = Window.orderBy("order_month")
    prev = F.lag("revenue").over(by_month)
    return (
        monthly_revenue(values)
        .withColumn("prev", prev)
        .select(
            "order_month",
            to_double(F.col("revenue")).alias("revenue"),
            to_double(F.col("prev")).alias("prev_month_revenue"),
            percent(F.col("revenue") - F.col("prev"), F.col("prev"), 1).alias("mom_growth_pct"),
        )
    )


def cumulative_revenue(orders: DataFrame, items: DataFrame) -> DataFrame:
    up_to_now = Window.orderBy("order_month").rowsBetween(Window.unboundedPreceding, 0)
    return monthly_revenue(order_values(orders, items)).select(
        "order_month",
        to_double(F.col("revenue")).alias("revenue"),
        to_double(F.sum("revenue").over(up_to_now)).alias("cumulative_revenue"),
    )


def top_products_per_category(
    orders: DataFrame, items: DataFrame, products: DataFrame, n: int = 3
) -> DataFrame:
    """Best products by rounded revenue; ties share a rank and are all kept."""
    kept = items.join(earning(orders).select("order_id"), "order_id")
    per_product = kept.groupBy("product_id").agg(
        F.sum("quantity").alias("units"), F.sum(line_value()).alias("amount")
    )
    named = (
        per_product.join(products.select("product_id", "product_name", "category"), "product_id")
        .groupBy("category", "product_name")
        .agg(F.sum("units").alias("units_sold"), F.round(F.sum("amount"), 2).alias("amount"))
    )
    # rank with a limit is cut down before the shuffle, so a large category sends n rows per task
    best = Window.partitionBy("category").orderBy(F.col("amount").desc())
    return (
        named.withColumn("rank_in_category", F.rank().over(best))
        .filter(F.col("rank_in_category") <= n)
        .select(
            "category", "product_name", "units_sold", to_double(F.col("amount")).alias("revenue"), "rank_in_category"
        )
    )


def rfm_base(values: DataFrame) -> DataFrame:
    return values.groupBy("customer_id").agg(
        F.max("order_date").alias("last_order"),
        F.count(F.lit(1)).alias("frequency"),
        F.round(F.sum("order_total"), 2).alias("monetary"),
    )


def segment_of(total: Column) -> Column:
    return F.when(total >= 10, "Champion").when(total >= 7, "Loyal").when(total >= 5, "At Risk").otherwise("Dormant")


def rfm_segments(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Quartile scores for recency, frequency and spend; ties are split by customer id."""
    return segments_of(order_values(orders, items))


def segments_of(values: DataFrame) -> DataFrame:
    # one row per customer, written once: its latest day and the tiles both start from it
    base = freeze(rfm_base(values))
    latest = base.agg(F.max("last_order").alias("latest"))
    dated = base.crossJoin(F.broadcast(latest)).select(
        "customer_id", F.datediff("latest", "last_order").alias("recency_days"), "frequency", "monetary"
    )
    # fewer days since the last order score higher
    measures = {"r": -F.col("recency_days"), "f": F.col("frequency"), "m": F.col("monetary")}
    scored = with_ntiles(dated, 4, "customer_id", measures)
    total = F.col("r") + F.col("f") + F.col("m")
    return scored.select(
        "customer_id",
        "recency_days",
        "frequency",
        to_double(F.col("monetary")).alias("monetary"),
        total.alias("rfm_total"),
        segment_of(total).alias("segment"),
    )


def segment_summary(segments: DataFrame) -> DataFrame:
    amount = F.col("monetary").cast("decimal(18,2)")
    return (
        segments.groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            to_double(F.sum(amount)).alias("total_spend"),
            F.round(F.sum(amount).cast("double") / F.count(F.lit(1)), 2).alias("avg_spend"),
        )
    )


def month_number(date: str) -> Column:
    return F.year(date) * 12 + F.month(date)


def cohort_retention(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Share of each signup month's customers that order again, by months since signup."""
    activity = (
        earning(orders)
        .select("customer_id", F.trunc("order_date", "month").alias("activity"))
        .distinct()
    )
    cohorts = customers.select(
        "customer_id", "signup_date", month_of("signup_date").alias("cohort_month")
    )
    sizes = cohorts.groupBy("cohort_month").agg(F.count_distinct("customer_id").alias("cohort_customers"))
    # (customer, month) is unique by now, so a plain count is a count of customers
    return (
        activity.join(cohorts, "customer_id")
        .withColumn("month_number", month_number("activity") - month_number("signup_date"))
        .filter(F.col("month_number") >= 0)
        .groupBy("cohort_month", "month_number")
        .agg(F.count(F.lit(1)).alias("active_customers"))
        .join(sizes, "cohort_month")
        .select(
            "cohort_month",
            "cohort_customers",
            "month_number",
            "active_customers",
            percent(F.col("active_customers"), F.col("cohort_customers"), 1).alias("retention_pct"),
        )
    )


def customer_value(values: DataFrame) -> DataFrame:
    return values.groupBy("customer_id").agg(F.count(F.lit(1)).alias("total_orders"), F.sum("order_total").alias("amount"))


def lifetime_value(customers: DataFrame, orders: DataFrame, items: DataFrame, limit: int = 20) -> DataFrame:
    """The known customers with the highest spend, densely ranked.

    The first `limit` rows hold every value that can rank among them, so the rank is taken on the cut list. Customers
    meet their totals, one row each, before the cut: a spender who is not in the table takes no place.
    """
    return top_of(customers, order_values(orders, items), limit)


def top_of(customers: DataFrame, values: DataFrame, limit: int = 20) -> DataFrame:
    known = customer_value(values).join(customers.select("customer_id", "first_name", "last_name"), "customer_id")
    top = known.orderBy(F.col("amount").desc(), "customer_id").limit(limit)
    return top.withColumn("value_rank", F.dense_rank().over(Window.orderBy(F.col("amount").desc()))).select(
        "customer_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"),
        "total_orders",
        to_double(F.col("amount")).alias("lifetime_value"),
        "value_rank",
    )


def cancellation_by_payment(orders: DataFrame) -> DataFrame:
    cancelled = F.count_if(F.col("status") == "Cancelled")
    return orders.groupBy("payment_method").agg(
        F.count(F.lit(1)).alias("total_orders"),
        cancelled.alias("cancelled_orders"),
        F.count_if(F.col("status") == "Returned").alias("returned_orders"),
        percent(cancelled, F.count(F.lit(1)), 1).alias("cancellation_rate_pct"),
    )


def repeat_vs_onetime(orders: DataFrame) -> DataFrame:
    per_customer = earning(orders).groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    kind = F.when(F.col("n") == 1, "One-time buyer").otherwise("Repeat buyer")
    counted = per_customer.groupBy(kind.alias("customer_type")).agg(F.count(F.lit(1)).alias("num_customers"))
    # at most two rows
    everyone = F.sum("num_customers").over(Window.partitionBy())
    return counted.withColumn("pct_of_customers", percent(F.col("num_customers"), everyone, 1))


def new_vs_returning_revenue(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue per month, split by whether it is the customer's first month with an order.

    The first month also counts orders without items; these add no revenue row of their own.
    """
    monthly = (
        earning(orders)
        .join(order_totals(items), "order_id", "left")
        .groupBy("customer_id", month_of("order_date").alias("order_month"))
        .agg(F.sum("order_total").alias("amount"))
    )
    # rows per customer are bounded by the months of the calendar
    first = F.min("order_month").over(Window.partitionBy("customer_id"))
    return (
        monthly.withColumn("customer_type", F.when(F.col("order_month") == first, "New").otherwise("Returning"))
        .filter(F.col("amount").isNotNull())
        .groupBy("order_month", "customer_type")
        .agg(to_double(F.sum("amount")).alias("revenue"))
    )


# Of tables that stored_values() has completed.
REPORTS = {
    "revenue-by-category": lambda t: revenue_by_category(t["orders"], t["items"], t["products"]),
    "monthly-trend": lambda t: trend_of(t["values"]),
    "top-customers": lambda t: top_of(t["customers"], t["values"]),
    "cohort-retention": lambda t: cohort_retention(t["customers"], t["orders"]),
    "segments": lambda t: segment_summary(segments_of(t["values"])),
}

# How the exported files are sorted; each report is small, as its groups are.
REPORT_ORDER = {
    "revenue-by-category": ["-revenue", "category"],
    "monthly-trend": ["order_month"],
    "top-customers": ["-lifetime_value", "customer_id"],
    "cohort-retention": ["cohort_month", "month_number"],
    "segments": ["-total_spend", "segment"],
}
