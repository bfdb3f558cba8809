"""Filters, joins, aggregates, windows and sorting (FLT, JN, AGG, WIN, TOP, ORD, SET) and their SQL."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import percent, to_double
from tidemark.operators import aggregates as agg
from tidemark.operators import joins
from tidemark.operators.ordering import exact_median, number_by_day, with_ntile
from tidemark.plans import retail as R
from tidemark.plans import shop, transactions, workforce
from tidemark.plans import wide_sales as W
from tidemark.registry.base import query
from tidemark.registry.tables import sql
from tidemark.session import freeze, scratch_path
from tidemark.sinks.files import write_partitioned
from tidemark.sources import adapters as A

AS_OF = "2024-06-30"


def dbl(*names):
    return {n: F.col(n).cast("double") for n in names}


# ---- filters


@query("flt_1_select_all", "SELECT * FROM customer")
def flt_1_all(spark, sf):
    return A.table(spark, sf, "customer")


@query("flt_1_select_columns", sql("cust", "SELECT first_name, last_name, city FROM cust"))
def flt_1_columns(spark, sf):
    return A.customers(spark, sf).select("first_name", "last_name", "city")


@query("flt_2_equality", sql("ord", "SELECT order_id, customer_id, order_date FROM ord WHERE status = 'Delivered'"))
def flt_2(spark, sf):
    return A.orders(spark, sf).filter(F.col("status") == "Delivered").select("order_id", "customer_id", "order_date")


@query(
    "flt_3_conjunction",
    sql("prod", """
        SELECT product_id, product_name, CAST(unit_price AS DOUBLE) AS unit_price FROM prod
        WHERE category = 'ECONOMY' AND unit_price > 950"""),
)
def flt_3(spark, sf):
    rows = A.products(spark, sf).filter((F.col("category") == "ECONOMY") & (F.col("unit_price") > 950))
    return rows.select("product_id", "product_name", F.col("unit_price").cast("double").alias("unit_price"))


@query(
    "flt_4_range_violation",
    "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount < 0.02::DOUBLE OR l_discount > 0.08::DOUBLE",
)
def flt_4(spark, sf):
    d = F.col("l_discount")
    return A.table(spark, sf, "lineitem").filter((d < 0.02) | (d > 0.08)).select(
        "l_orderkey", "l_linenumber", "l_discount"
    )


@query(
    "flt_5_between_and_not_equal",
    """SELECT o_orderkey, o_orderstatus FROM orders
       WHERE o_orderdate BETWEEN TIMESTAMP '1997-08-10' AND TIMESTAMP '1997-08-25' AND o_orderstatus <> 'P'""",
)
def flt_5(spark, sf):
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("1997-08-10", "1997-08-25"))
    return (
        A.table(spark, sf, "orders")
        .filter(F.col("o_orderdate").between(low, high) & (F.col("o_orderstatus") != "P"))
        .select("o_orderkey", "o_orderstatus")
    )


@query(
    "flt_6_half_open_year",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""",
)
def flt_6(spark, sf):
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("1997-01-01", "1998-01-01"))
    return (
        A.table(spark, sf, "orders")
        .filter((F.col("o_orderdate") >= low) & (F.col("o_orderdate") < high))
        .select("o_orderkey", "o_totalprice")
    )


@query(
    "flt_7_in_and_not_in",
    sql("trans_rows trans", """
        SELECT user_id, status, region FROM trans WHERE status NOT IN ('Inactive') AND region IN ('West', 'East')"""),
)
def flt_7(spark, sf):
    rows = A.transactions(spark, sf)
    return rows.filter(~F.col("status").isin("Inactive") & F.col("region").isin("West", "East")).select(
        "user_id", "status", "region"
    )


@query(
    "flt_8_null_tests",
    sql("trans_rows trans", "SELECT user_id, email, store_id FROM trans WHERE status IS NULL AND email IS NOT NULL"),
)
def flt_8(spark, sf):
    rows = A.transactions(spark, sf).filter(F.col("status").isNull() & F.col("email").isNotNull())
    return rows.select("user_id", "email", "store_id")


@query(
    "flt_9_non_empty_string",
    sql("trans_rows trans", "SELECT user_id, username FROM trans WHERE coalesce(trim(username), '') <> ''"),
)
def flt_9(spark, sf):
    rows = A.transactions(spark, sf)
    return rows.filter(F.coalesce(F.trim("username"), F.lit("")) != "").select("user_id", "username")


@query(
    "flt_10_numeric_threshold",
    sql("sample_rows sample", """
        SELECT order_id, line_number, quantity FROM sample WHERE quantity >= 5 AND price > 90000"""),
)
def flt_10(spark, sf):
    rows = A.sales_sample(spark, sf).filter((F.col("quantity") >= 5) & (F.col("price") > 90000))
    return rows.select("order_id", "line_number", "quantity")


@query(
    "flt_11_case_tiers",
    sql("prod", """
        SELECT product_name, CAST(unit_price AS DOUBLE) AS unit_price,
               CASE WHEN unit_price < 950 THEN 'Budget' WHEN unit_price BETWEEN 950 AND 1050 THEN 'Mid-Range'
                    ELSE 'Premium' END AS price_tier FROM prod"""),
)
def flt_11(spark, sf):
    price = F.col("unit_price")
    return A.products(spark, sf).select(
        "product_name", price.cast("double").alias("unit_price"), shop.price_tier(price, 950, 1050).alias("price_tier")
    )


@query("flt_12_rename", sql("emp", "SELECT employee_id, name AS full_name, department AS unit FROM emp"))
def flt_12(spark, sf):
    rows = A.employees(spark, sf).withColumnRenamed("name", "full_name")
    return rows.select("employee_id", "full_name", F.col("department").alias("unit"))


@query(
    "flt_13_derived_amount",
    sql("items", """
        SELECT order_id, line_number, product_id, CAST(quantity * unit_price_at_purchase AS DOUBLE) AS total_amount
        FROM items"""),
)
def flt_13(spark, sf):
    return A.order_items(spark, sf).select(
        "order_id", "line_number", "product_id", R.line_value().cast("double").alias("total_amount")
    )


@query("flt_14_drop_columns", "SELECT event_id, ts, user_id, event_type, value FROM events")
def flt_14(spark, sf):
    return A.table(spark, sf, "events").drop("props", "_injection_type")


@query("flt_15_distinct_values", sql("prod", "SELECT DISTINCT category FROM prod"))
def flt_15(spark, sf):
    return A.products(spark, sf).select("category").distinct()


@query(
    "flt_16_above_global_average",
    sql("sales", """
        SELECT order_id, line_number, product_id, CAST(s.sales AS DOUBLE) AS sales FROM sales s
        WHERE s.sales * (SELECT count(*) FROM sales) > (SELECT sum(x.sales) FROM sales x)"""),
)
def flt_16(spark, sf):
    rows = A.sales(spark, sf).select("order_id", "line_number", "product_id", "sales")
    return agg.above_average(rows, "sales").withColumns(dbl("sales"))


@query(
    "flt_17_above_average_of_totals",
    sql("ord", """
        WITH t AS (SELECT customer_id, sum(total_amount) AS total FROM ord GROUP BY 1)
        SELECT customer_id, CAST(total AS DOUBLE) AS total FROM t
        WHERE total * (SELECT count(*) FROM t) > (SELECT sum(total) FROM t)"""),
)
def flt_17(spark, sf):
    totals = agg.total_by(A.orders(spark, sf), ["customer_id"], {"total": "total_amount"})
    return agg.above_average(freeze(totals), "total").withColumns(dbl("total"))


@query(
    "flt_18_rows_with_group_max",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders o
       WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)""",
)
def flt_18(spark, sf):
    rows = A.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return agg.rows_with_group_max(rows, "o_custkey", "o_totalprice")


# ---- joins


@query(
    "jn_1_inner",
    sql("ord cust", """
        SELECT order_id, order_date, first_name, last_name, CAST(total_amount AS DOUBLE) AS total_amount
        FROM ord JOIN cust ON cust.customer_id = ord.customer_id"""),
)
def jn_1(spark, sf):
    rows = shop.order_listing(A.orders(spark, sf), A.customers(spark, sf, with_place=False))
    return rows.withColumns(dbl("total_amount"))


DETAIL = sql("ord items prod", """
    SELECT o.order_id, product_name, quantity, CAST(unit_price_at_purchase AS DOUBLE) AS unit_price_at_purchase,
           CAST(discount_pct AS DOUBLE) AS discount_pct
    FROM ord o JOIN items i ON i.order_id = o.order_id JOIN prod p ON p.product_id = i.product_id""")


@query("jn_2_three_way_inner", DETAIL)
def jn_2(spark, sf):
    rows = shop.item_detail(A.orders(spark, sf), A.order_items(spark, sf), A.products(spark, sf))
    return rows.withColumns(dbl("unit_price_at_purchase", "discount_pct"))


# Gaps on both sides follow from the rows' own attributes: some orders have no customer, some customers no order.
ORD_GAPS = """ord_gaps AS (SELECT order_id, order_date, status, CASE WHEN total_amount >= 400000 THEN customer_id END
                                         AS customer_id FROM ord)"""


def orders_with_gaps(spark, sf):
    known = F.when(F.col("total_amount") >= 400000, F.col("customer_id"))
    return A.orders(spark, sf).withColumn("customer_id", known)


@query(
    "jn_3_left_outer",
    sql("ord cust", f"""WITH {ORD_GAPS}
        SELECT c.customer_id, first_name, last_name, order_id, order_date, status
        FROM cust c LEFT JOIN ord_gaps o ON o.customer_id = c.customer_id"""),
)
def jn_3(spark, sf):
    return shop.customers_with_orders(A.customers(spark, sf, with_place=False), orders_with_gaps(spark, sf))


@query(
    "jn_4_right_outer",
    sql("items prod", """
        SELECT p.product_id, product_name, order_id, line_number
        FROM items i RIGHT JOIN prod p ON p.product_id = i.product_id AND p.category <> 'PROMO'"""),
)
def jn_4_right(spark, sf):
    # products of one category are not sold here: their key is kept aside
    sold = A.products(spark, sf).withColumn("sold", F.when(F.col("category") != "PROMO", F.col("product_id")))
    rows = joins.one_to_many_left(
        sold.select(F.col("product_id").alias("id"), "product_name", F.col("sold").alias("product_id")),
        A.order_items(spark, sf).select("product_id", "order_id", "line_number"),
        "product_id",
    )
    return rows.select(F.col("id").alias("product_id"), "product_name", "order_id", "line_number")


@query(
    "jn_4_full_outer",
    sql("ord cust", f"""WITH {ORD_GAPS}
        SELECT coalesce(c.customer_id, o.customer_id) AS customer_id, first_name, order_id, status
        FROM cust c FULL OUTER JOIN ord_gaps o ON o.customer_id = c.customer_id"""),
)
def jn_4_full(spark, sf):
    return joins.full_outer(
        A.customers(spark, sf, with_place=False).select("customer_id", "first_name"),
        orders_with_gaps(spark, sf).select("customer_id", "order_id", "status"),
        "customer_id",
    )


@query(
    "jn_5_semi",
    sql("ord items", """
        SELECT order_id, line_number, product_id FROM items
        WHERE order_id IN (SELECT order_id FROM ord WHERE status = 'Returned')"""),
)
def jn_5(spark, sf):
    returned = A.orders(spark, sf).filter(F.col("status") == "Returned")
    return joins.known_only(A.order_items(spark, sf), "order_id", returned).select(
        "order_id", "line_number", "product_id"
    )


@query(
    "jn_6_anti",
    sql("ord items", """
        SELECT o.order_id, o.customer_id FROM ord o LEFT JOIN items i ON i.order_id = o.order_id
        WHERE i.order_id IS NULL"""),
)
def jn_6(spark, sf):
    return joins.orphans(A.orders(spark, sf), "order_id", A.order_items(spark, sf)).select("order_id", "customer_id")


@query(
    "jn_7_price_lookup",
    sql("items prod", """
        SELECT order_id, line_number, i.product_id, CAST(unit_price AS DOUBLE) AS catalogue_price
        FROM items i LEFT JOIN prod p ON p.product_id = i.product_id AND i.quantity > 1"""),
)
def jn_7(spark, sf):
    prices = A.products(spark, sf).select(F.col("product_id").alias("priced"), "unit_price")
    known = (F.col("product_id") == F.col("priced")) & (F.col("quantity") > 1)
    rows = A.order_items(spark, sf).join(prices, known, "left")
    return rows.select(
        "order_id", "line_number", "product_id", F.col("unit_price").cast("double").alias("catalogue_price")
    )


@query(
    "jn_8_scalar_cross",
    sql("ord", """
        SELECT order_id, date_diff('day', order_date, (SELECT max(order_date) FROM ord)) AS age_days FROM ord"""),
)
def jn_8(spark, sf):
    rows = A.orders(spark, sf)
    latest = rows.agg(F.max("order_date").alias("latest"))
    return rows.crossJoin(F.broadcast(latest)).select(
        "order_id", F.datediff("latest", "order_date").cast("long").alias("age_days")
    )


@query(
    "jn_11_days_since_first_order",
    sql("ord", """
        SELECT order_id, o.customer_id, date_diff('day', first_date, order_date) AS days_since_first
        FROM ord o JOIN (SELECT customer_id, min(order_date) AS first_date FROM ord GROUP BY 1) f
             ON f.customer_id = o.customer_id"""),
)
def jn_11(spark, sf):
    rows = A.orders(spark, sf)
    first = rows.groupBy("customer_id").agg(F.min("order_date").alias("first_date"))
    return rows.join(first, "customer_id").select(
        "order_id", "customer_id", F.datediff("order_date", "first_date").cast("long").alias("days_since_first")
    )


# ---- aggregates


@query("agg_1_count", sql("ord", "SELECT count(*) AS total_orders FROM ord"))
def agg_1(spark, sf):
    return A.orders(spark, sf).agg(F.count(F.lit(1)).alias("total_orders"))


@query("agg_2_count_distinct", "SELECT count(DISTINCT l_orderkey) AS n_orders, count(DISTINCT l_partkey) AS n_parts FROM lineitem")
def agg_2(spark, sf):
    line = A.table(spark, sf, "lineitem")
    # two plain counts instead of one expanded copy of the rows per distinct column
    orders = line.agg(F.count_distinct("l_orderkey").alias("n_orders"))
    return orders.crossJoin(line.agg(F.count_distinct("l_partkey").alias("n_parts")))


@query(
    "agg_2_sketches_by_day",
    """SELECT event_type, count(DISTINCT CAST(ts AS DATE)) AS n_days, count(DISTINCT user_id) AS n_users, true AS within_2_percent,
              true AS inside_interval FROM events GROUP BY event_type
       UNION ALL SELECT 'all', count(DISTINCT CAST(ts AS DATE)), count(DISTINCT user_id), true, true FROM events""",
)
def agg_2_sketches(spark, sf):
    """Sketches of each day's users are stored; types and the whole table are estimated from them and held against the truth."""
    events = A.table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    path = scratch_path(spark, "user-sketches")
    write_partitioned(agg.distinct_sketches(events, "user_id", ["day", "event_type"]), path, ["day"])
    stored = spark.read.parquet(path)
    both = stored.unionByName(stored.withColumn("event_type", F.lit("all")))
    found = agg.distinct_estimates(both, ["event_type"], "estimate").join(
        both.groupBy("event_type").agg(F.count_distinct("day").alias("n_days")), "event_type"
    )
    rows = events.unionByName(events.withColumn("event_type", F.lit("all")))
    exact = rows.groupBy("event_type").agg(F.count_distinct("user_id").alias("n_users"))
    near = F.abs(F.col("estimate") - F.col("n_users")) <= 0.02 * F.col("n_users")
    return found.join(exact, "event_type").select(
        "event_type", "n_days", "n_users", near.alias("within_2_percent"), F.col("n_users").between(F.col("estimate_low"), F.col("estimate_high")).alias("inside_interval")
    )


@query(
    "agg_3_filtered_total",
    sql("ord", """
        SELECT CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
               round(CAST(sum(total_amount) AS DOUBLE) / count(*), 4) AS avg_revenue FROM ord WHERE status = 'Delivered'"""),
)
def agg_3(spark, sf):
    rows = A.orders(spark, sf).filter(F.col("status") == "Delivered")
    return rows.agg(
        F.sum("total_amount").cast("double").alias("total_revenue"),
        F.round(F.sum("total_amount").cast("double") / F.count("total_amount"), 4).alias("avg_revenue"),
    )


@query(
    "agg_5_grouped_average",
    sql("prod", "SELECT category, round(CAST(sum(unit_price) AS DOUBLE) / count(*), 4) AS average_price FROM prod GROUP BY 1"),
)
def agg_5(spark, sf):
    return A.products(spark, sf).groupBy("category").agg(
        F.round(F.sum("unit_price").cast("double") / F.count("unit_price"), 4).alias("average_price")
    )


@query(
    "agg_6_grouped_min_max",
    sql("prod", """
        SELECT category, CAST(max(unit_price) AS DOUBLE) AS most_expensive, CAST(min(unit_price) AS DOUBLE) AS cheapest
        FROM prod GROUP BY 1"""),
)
def agg_6(spark, sf):
    return A.products(spark, sf).groupBy("category").agg(
        F.max("unit_price").cast("double").alias("most_expensive"), F.min("unit_price").cast("double").alias("cheapest")
    )


@query(
    "agg_7_count_and_sum",
    sql("ord", """
        SELECT status, count(*) AS order_count, CAST(sum(total_amount) AS DOUBLE) AS total_revenue FROM ord GROUP BY 1"""),
)
def agg_7(spark, sf):
    return A.orders(spark, sf).groupBy("status").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("total_amount").cast("double").alias("total_revenue")
    )


@query(
    "agg_8_global_stats",
    sql("trans_rows trans", """
        SELECT CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price,
               round(CAST(sum(price) AS DOUBLE) / count(price), 6) AS mean_price FROM trans"""),
)
def agg_8(spark, sf):
    out = agg.multi_stats(A.transactions(spark, sf), "price")
    return out.withColumns({**dbl("min_price", "max_price"), "mean_price": F.round("mean_price", 6)})


@query(
    "agg_9_grouped_stats",
    """SELECT event_type, min(value) AS min_value, max(value) AS max_value,
              round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*), 4) AS mean_value
       FROM events GROUP BY 1""",
)
def agg_9(spark, sf):
    rows = A.table(spark, sf, "events").withColumn("value", A.money("value"))
    out = agg.multi_stats(rows, "value", ["event_type"])
    return out.withColumns({**dbl("min_value", "max_value"), "mean_value": F.round("mean_value", 4)})


@query(
    "agg_10_having",
    sql("prod", """
        SELECT brand, round(CAST(sum(unit_price) AS DOUBLE) / count(*), 4) AS average_price FROM prod GROUP BY 1
        HAVING sum(unit_price) > 945 * count(*)"""),
)
def agg_10(spark, sf):
    grouped = A.products(spark, sf).groupBy("brand").agg(
        F.sum("unit_price").alias("s"), F.count(F.lit(1)).alias("n")
    )
    return grouped.filter(F.col("s") > 945 * F.col("n")).select(
        "brand", F.round(F.col("s").cast("double") / F.col("n"), 4).alias("average_price")
    )


@query(
    "agg_11_conditional",
    sql("ord", """
        SELECT payment_method, sum(CASE WHEN status = 'Delivered' THEN 1 ELSE 0 END)::BIGINT AS delivered,
               CAST(sum(CASE WHEN status = 'Shipped' THEN total_amount ELSE 0 END) AS DOUBLE) AS on_the_way
        FROM ord GROUP BY 1"""),
)
def agg_11(spark, sf):
    shipped = F.when(F.col("status") == "Shipped", F.col("total_amount")).otherwise(0)
    return A.orders(spark, sf).groupBy("payment_method").agg(
        F.count_if(F.col("status") == "Delivered").alias("delivered"),
        F.sum(shipped).cast("double").alias("on_the_way"),
    )


@query(
    "agg_12_count_and_max_when",
    sql("ord", """
        SELECT customer_id, count(CASE WHEN status = 'Returned' THEN 1 END) AS returned,
               max(CASE WHEN status = 'Returned' THEN order_date END) AS last_return FROM ord GROUP BY 1"""),
)
def agg_12(spark, sf):
    returned = F.col("status") == "Returned"
    return A.orders(spark, sf).groupBy("customer_id").agg(
        F.count(F.when(returned, True)).alias("returned"), F.max(F.when(returned, F.col("order_date"))).alias("last_return")
    )


@query(
    "agg_15_percent_of_total",
    sql("ord", """
        SELECT status, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) AS pct
        FROM ord GROUP BY 1"""),
)
def agg_15(spark, sf):
    counted = A.orders(spark, sf).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("pct", percent(F.col("n"), F.sum("n").over(Window.partitionBy()), 1))


@query(
    "agg_16_ratio",
    sql("ord", """
        SELECT year(order_date) AS y, round(100.0::DOUBLE * count(*) FILTER (status = 'Returned') / count(*), 1) AS pct
        FROM ord GROUP BY 1"""),
)
def agg_16(spark, sf):
    share = percent(F.count_if(F.col("status") == "Returned"), F.count(F.lit(1)), 1)
    return A.orders(spark, sf).groupBy(F.year("order_date").alias("y")).agg(share.alias("pct"))


@query(
    "agg_17_two_level_average",
    sql("sales", """
        WITH o AS (SELECT order_id, order_date, CAST(sum(sales) AS DOUBLE) / count(*) AS m FROM sales GROUP BY 1, 2)
        SELECT order_date, count(*) AS orders,
               CAST(sum(CAST(round(m, 6) AS DECIMAL(18,6))) AS DOUBLE) / count(*) AS avg_line
        FROM o GROUP BY 1"""),
)
def agg_17(spark, sf):
    mean = F.round(F.sum("sales").cast("double") / F.count("sales"), 6).cast("decimal(18,6)")
    per_order = A.sales(spark, sf).groupBy("order_id").agg(mean.alias("m"))
    dated = per_order.join(A.orders(spark, sf).select("order_id", "order_date"), "order_id")
    return dated.groupBy("order_date").agg(
        F.count(F.lit(1)).alias("orders"), (F.sum("m").cast("double") / F.count("m")).alias("avg_line")
    )


@query(
    "agg_18_average_line_sale",
    sql("sales", "SELECT round(CAST(sum(sales) AS DOUBLE) / count(*), 4) AS average_order_value FROM sales"),
)
def agg_18(spark, sf):
    return A.sales(spark, sf).agg(
        F.round(F.sum("sales").cast("double") / F.count("sales"), 4).alias("average_order_value")
    )


@query(
    "agg_19_distinct_rows",
    sql("ord", "SELECT DISTINCT customer_id, strftime(order_date, '%Y-%m') AS activity_month FROM ord"),
)
def agg_19(spark, sf):
    return A.orders(spark, sf).select("customer_id", R.month_of("order_date").alias("activity_month")).distinct()


@query("agg_20_median", "SELECT round(median(o_totalprice), 4) AS median FROM orders")
def agg_20(spark, sf):
    return exact_median(A.orders(spark, sf), "total_amount").select(F.round("median", 4).alias("median"))


@query("agg_20_group_median", "SELECT p_type, median(p_retailprice) AS median FROM part GROUP BY 1")
def agg_20_group(spark, sf):
    return exact_median(A.table(spark, sf, "part"), "p_retailprice", ["p_type"])


@query(
    "agg_21_mode",
    "SELECT o_orderpriority AS mode FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1",
)
def agg_21(spark, sf):
    return agg.mode_of(A.table(spark, sf, "orders"), "o_orderpriority")


PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS n_values, count(DISTINCT {c}) AS n_unique,
               (SELECT CAST({c} AS VARCHAR) FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)
                   AS top,
               (SELECT count(*) FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq,
               {f"round(CAST(sum(CAST({c} AS DECIMAL(38,6))) AS DOUBLE) / count({c}), 4)" if n else "CAST(NULL AS DOUBLE)"}
                   AS mean,
               {f"round(stddev_samp({c}), 4)" if n else "CAST(NULL AS DOUBLE)"} AS std,
               {f"CAST(min({c}) AS DOUBLE)" if n else "CAST(NULL AS DOUBLE)"} AS min,
               {f"quantile_cont({c}::DOUBLE, 0.25)" if n else "CAST(NULL AS DOUBLE)"} AS q25,
               {f"quantile_cont({c}::DOUBLE, 0.5)" if n else "CAST(NULL AS DOUBLE)"} AS q50,
               {f"quantile_cont({c}::DOUBLE, 0.75)" if n else "CAST(NULL AS DOUBLE)"} AS q75,
               {f"CAST(max({c}) AS DOUBLE)" if n else "CAST(NULL AS DOUBLE)"} AS max FROM {t}"""
    for t in ("part",)
    for c, n in (("p_partkey", True), ("p_name", False), ("p_brand", False), ("p_type", False), ("p_size", True),
                 ("p_retailprice", True))
)


@query("agg_22_profile", PROFILE)
def agg_22(spark, sf):
    return agg.profile(A.table(spark, sf, "part"))


def line_sql(c):
    """A column of lineitem: its count and range, and whether quartiles from sketches are within 1 % of the ranks."""
    return f"""SELECT '{c}' AS column_name, count({c}) AS n_values, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
               true AS unique_within_2_percent, true AS ranks_within_1_percent FROM lineitem"""


LINE = ("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")


@query("agg_22_profile_from_sketches", " UNION ALL ".join(line_sql(c) for c in LINE))
def agg_22_sketches(spark, sf):
    line = A.table(spark, sf, "lineitem").select(*LINE)
    found = agg.approximate_profile(line)
    # the share of values below and up to each estimated quartile, in one pass over the table
    marks = found.groupBy().pivot("column_name", list(LINE)).agg(F.first(F.struct("q25", "q50", "q75", "n_unique")))
    held = line.crossJoin(F.broadcast(marks.select(*[F.col(c).alias(f"_{c}") for c in LINE])))
    checks = []
    for c in LINE:
        ok = [(F.avg((F.col(c) < F.col(f"_{c}.{q}")).cast("double")) <= p + 0.01) & (F.avg((F.col(c) <= F.col(f"_{c}.{q}")).cast("double")) >= p - 0.01)
              for q, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))]
        n = F.count_distinct(c)
        checks.append(F.struct(F.lit(c).alias("column_name"), (F.abs(F.max(f"_{c}.n_unique") - n) <= 0.02 * n).alias("unique_within_2_percent"),
                               (ok[0] & ok[1] & ok[2]).alias("ranks_within_1_percent")))
    checked = held.agg(F.array(*checks).alias("x")).select(F.inline("x"))
    return found.join(checked, "column_name").select(
        "column_name", "n_values", "min", "max", "unique_within_2_percent", "ranks_within_1_percent"
    )


# ---- windows, sorting, sets


@query(
    "win_2_row_number_per_customer",
    """SELECT o_custkey, o_orderkey, o_orderdate,
              row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS order_number FROM orders""",
)
def win_2(spark, sf):
    rows = A.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return number_by_day(rows, ["o_custkey"], "o_orderdate", ["o_orderkey"], "order_number")


@query(
    "win_3_top_n_by_rank",
    """SELECT * FROM (SELECT o_orderkey, o_totalprice, rank() OVER (ORDER BY o_totalprice DESC) AS price_rank FROM orders)
       WHERE price_rank <= 10""",
)
def win_3(spark, sf):
    rows = A.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("customer_id"), F.lit("").alias("customer_name"), F.col("o_totalprice").alias("total_sales")
    )
    return W.top_ranked_customers(rows, 10).select(
        F.col("customer_id").alias("o_orderkey"), F.col("total_sales").alias("o_totalprice"),
        F.col("sales_rank").alias("price_rank"),
    )


@query(
    "win_4_top_n_per_group",
    """SELECT * FROM (SELECT o_orderkey, o_orderpriority, o_totalprice,
                             rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS r FROM orders)
       WHERE r <= 5""",
)
def win_4(spark, sf):
    best = Window.partitionBy("o_orderpriority").orderBy(F.col("o_totalprice").desc())
    rows = A.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return rows.withColumn("r", F.rank().over(best)).filter(F.col("r") <= 5)


@query(
    "win_6_lag_growth",
    sql("ord", """
        WITH y AS (SELECT year(order_date) AS y, sum(total_amount) AS t FROM ord GROUP BY 1)
        SELECT y, CAST(t AS DOUBLE) AS total, CAST(lag(t) OVER w AS DOUBLE) AS previous,
               round(CAST((t - lag(t) OVER w) * 100 AS DOUBLE) / nullif(CAST(lag(t) OVER w AS DOUBLE), 0), 1) AS growth_pct
        FROM y WINDOW w AS (ORDER BY y)"""),
)
def win_6(spark, sf):
    yearly = A.orders(spark, sf).groupBy(F.year("order_date").alias("y")).agg(F.sum("total_amount").alias("t"))
    prev = F.lag("t").over(Window.orderBy("y"))
    return yearly.withColumn("p", prev).select(
        "y", to_double(F.col("t")).alias("total"), to_double(F.col("p")).alias("previous"),
        percent(F.col("t") - F.col("p"), F.col("p"), 1).alias("growth_pct"),
    )


@query(
    "win_7_running_total",
    """WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)
       SELECT day, n, CAST(sum(n) OVER (ORDER BY day) AS BIGINT) AS so_far FROM d""",
)
def win_7(spark, sf):
    daily = A.table(spark, sf, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("so_far", F.sum("n").over(so_far))


@query(
    "win_8_ntile",
    """SELECT c_custkey, CAST(ntile(4) OVER (ORDER BY c_mktsegment, c_custkey) AS INTEGER) AS tile,
              CAST(ntile(7) OVER (ORDER BY c_acctbal DESC, c_custkey) AS INTEGER) AS tile_of_balance FROM customer""",
)
def win_8(spark, sf):
    rows = A.table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    tiled = with_ntile(rows, 4, "c_mktsegment", ["c_custkey"], "tile")
    tiled = with_ntile(tiled, 7, "c_acctbal", ["c_custkey"], "tile_of_balance", descending=True)
    return tiled.select("c_custkey", "tile", "tile_of_balance")


@query(
    "win_9_window_over_result",
    "SELECT c_mktsegment, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS everyone FROM customer GROUP BY 1",
)
def win_9(spark, sf):
    counted = A.table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("everyone", F.sum("n").over(Window.partitionBy()))


@query(
    "win_10_trailing_week",
    """SELECT event_type, count(*) AS n FROM events
       WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAYS GROUP BY 1""",
)
def win_10(spark, sf):
    rows = A.table(spark, sf, "events")
    latest = rows.agg(F.max("ts").alias("as_of"))
    recent = rows.crossJoin(F.broadcast(latest)).filter(F.col("ts") >= F.col("as_of") - F.expr("INTERVAL 7 DAYS"))
    return recent.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("top_3_rows", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10")
def top_3(spark, sf):
    return agg.top_k(A.table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", 10, ["c_custkey"])


@query("ord_1_multi_key_sort", "SELECT n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey ORDER BY r_name, n_name DESC")
def ord_1(spark, sf):
    nation, region = A.table(spark, sf, "nation"), A.table(spark, sf, "region")
    rows = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_name", "r_name")
    return rows.orderBy(F.col("r_name"), F.col("n_name").desc())


@query("set_1_distinct", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def set_1(spark, sf):
    return A.table(spark, sf, "customer").select("c_mktsegment", "c_nationkey").distinct()


# ---- composed reports over shop tables, transactions and staff


@query(
    "rpt_24_delivered_split",
    sql("ord", """
        SELECT sum(CASE WHEN status = 'Delivered' THEN 1 ELSE 0 END)::BIGINT AS delivered_orders,
               sum(CASE WHEN status <> 'Delivered' THEN 1 ELSE 0 END)::BIGINT AS not_delivered_orders FROM ord"""),
)
def rpt_24(spark, sf):
    return shop.delivered_split(A.orders(spark, sf))


@query(
    "rpt_25_customers_with_orders",
    sql("ord cust", """
        SELECT c.customer_id, first_name, last_name, order_id, order_date, status
        FROM cust c LEFT JOIN ord o ON o.customer_id = c.customer_id"""),
)
def rpt_25(spark, sf):
    return shop.customers_with_orders(A.customers(spark, sf, with_place=False), A.orders(spark, sf))


@query("rpt_25_item_detail", DETAIL)
def rpt_25_detail(spark, sf):
    return jn_2(spark, sf)


@query(
    "rpt_26_price_tiers",
    sql("prod", """
        SELECT product_name, CAST(unit_price AS DOUBLE) AS unit_price,
               CASE WHEN unit_price < 1000 THEN 'Budget' WHEN unit_price BETWEEN 1000 AND 3000 THEN 'Mid-Range'
                    ELSE 'Premium' END AS price_tier FROM prod"""),
)
def rpt_26(spark, sf):
    price = F.col("unit_price")
    return A.products(spark, sf).select(
        "product_name", price.cast("double").alias("unit_price"), shop.price_tier(price).alias("price_tier")
    )


@query(
    "rpt_27_revenue_per_store",
    sql("trans_rows trans", """
        SELECT store_id, CAST(sum(coalesce(price, 0)) AS DOUBLE) AS total_revenue
        FROM (SELECT DISTINCT * FROM trans) GROUP BY 1"""),
)
def rpt_27(spark, sf):
    return transactions.revenue_per_store(A.transactions(spark, sf))


@query(
    "rpt_28_average_by_category",
    sql("trans_rows trans", """
        SELECT product_category, round(CAST(sum(sale_amount) AS DOUBLE) / count(*), 4) AS average_sale_amount
        FROM trans WHERE region = 'West' GROUP BY 1"""),
)
def rpt_28(spark, sf):
    return transactions.average_by_category(A.transactions(spark, sf), "West")


@query(
    "rpt_28_busy_cities",
    sql("trans_rows trans", "SELECT city, count(*) AS n_rows FROM trans GROUP BY 1 HAVING count(*) > 1000"),
)
def rpt_28_cities(spark, sf):
    return transactions.busy_cities(A.transactions(spark, sf), 1000)


STAFF = """
    WITH s AS (SELECT employee_id, name AS full_name, department, CAST(trunc(salary) AS BIGINT) AS salary, city,
                      CAST(join_date AS DATE) AS join_date, years_exp,
                      round(date_diff('day', CAST(join_date AS DATE), DATE '2024-06-30') / 365.0::DOUBLE, 1) AS tenure_years
               FROM emp WHERE status = 'Active' AND salary IS NOT NULL),
         b AS (SELECT *, salary * 12 AS annual_salary,
                      CASE WHEN salary < 60000 THEN 'Junior' WHEN salary < 100000 THEN 'Mid'
                           WHEN salary < 140000 THEN 'Senior' ELSE 'Lead' END AS salary_band FROM s)"""


def staff(spark, sf):
    return workforce.enrich(workforce.paid_active(A.employees(spark, sf)), AS_OF)


@query("rpt_30_employee_enrichment", sql("emp", STAFF + " SELECT * FROM b"))
def rpt_30(spark, sf):
    return staff(spark, sf)


@query(
    "rpt_29_department_stats",
    sql("emp", STAFF + """
        SELECT department, count(*) AS headcount, round(avg(salary), 2) AS avg_salary, min(salary) AS min_salary,
               max(salary) AS max_salary,
               round(CAST(sum(CAST(tenure_years AS DECIMAL(12,1))) AS DOUBLE) / count(*), 1) AS avg_tenure,
               round(avg(years_exp), 1) AS avg_exp FROM b GROUP BY 1"""),
)
def rpt_29(spark, sf):
    return workforce.department_stats(staff(spark, sf))


@query(
    "rpt_29_band_stats",
    sql("emp", STAFF + " SELECT salary_band, count(*) AS employees, round(avg(salary), 0) AS avg_salary FROM b GROUP BY 1"),
)
def rpt_29_band(spark, sf):
    return workforce.band_stats(staff(spark, sf))


@query(
    "rpt_29_city_stats",
    sql("emp", STAFF + " SELECT city, count(*) AS employees, round(avg(salary), 2) AS avg_salary FROM b GROUP BY 1"),
)
def rpt_29_city(spark, sf):
    return workforce.city_stats(staff(spark, sf))


@query(
    "rpt_29_top_earners",
    sql("emp", STAFF + """
        SELECT employee_id, full_name, department, salary, salary_band, city FROM b
        ORDER BY salary DESC, employee_id LIMIT 10"""),
)
def rpt_29_top(spark, sf):
    return workforce.top_earners(staff(spark, sf))
