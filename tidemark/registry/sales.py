"""Wide sales reports (RPT-12 to RPT-23), global ranks and best-of lists, and their SQL."""

from pyspark.sql import functions as F

from tidemark.functions.numbers import to_double
from tidemark.operators import aggregates as agg
from tidemark.plans import wide_sales as W
from tidemark.registry.base import query
from tidemark.registry.tables import sql
from tidemark.sources import adapters as A


def named_customers(spark, sf, with_place=False):
    who = A.customers(spark, sf, with_place)
    return who.withColumn("customer_name", F.concat("first_name", F.lit(" "), "last_name"))


def totals(spark, sf):
    return W.customer_totals(A.sales(spark, sf), A.orders(spark, sf), named_customers(spark, sf))


def doubled(df, *names):
    return df.withColumns({n: to_double(F.col(n)) for n in names})


TOTALS = """
    WITH t AS (SELECT customer_id, customer_name, sum(sales) AS total_sales, sum(profit) AS total_profit,
                      count(*) AS line_count, count(DISTINCT order_id) AS order_count,
                      max(sales) AS highest_order_value
               FROM sales GROUP BY 1, 2)"""
DBL = "CAST(round(total_sales, 2) AS DOUBLE) AS total_sales"
PROFIT = "CAST(round(total_profit, 2) AS DOUBLE) AS total_profit"


@query("rpt_12_customer_total_sales", sql("sales", TOTALS + f" SELECT customer_id, customer_name, {DBL} FROM t"))
def rpt_12(spark, sf):
    return doubled(totals(spark, sf).select("customer_id", "customer_name", "total_sales"), "total_sales")


@query(
    "rpt_13_customers_above_average",
    sql("sales", TOTALS + f"""
        SELECT customer_id, customer_name, {DBL} FROM t
        WHERE total_sales * (SELECT count(*) FROM t) > (SELECT sum(total_sales) FROM t)"""),
)
def rpt_13(spark, sf):
    return W.customers_above_average(totals(spark, sf))


@query(
    "rpt_14_best_sale_rows_per_customer",
    sql("sales", """
        SELECT customer_id, order_id, line_number, product_id, CAST(sales AS DOUBLE) AS sales FROM sales o
        WHERE sales = (SELECT max(sales) FROM sales i WHERE i.customer_id = o.customer_id)"""),
)
def rpt_14(spark, sf):
    best = W.best_sales(A.sales(spark, sf, ("order",)))
    return doubled(best.select("customer_id", "order_id", "line_number", "product_id", "sales"), "sales")


@query(
    "rpt_14_highest_order_value",
    sql("sales", TOTALS + """
        SELECT customer_id, CAST(highest_order_value AS DOUBLE) AS highest_order_value FROM t"""),
)
def rpt_14_value(spark, sf):
    lines = W.customer_lines(A.sales(spark, sf), A.orders(spark, sf))
    return doubled(
        lines.groupBy("customer_id").agg(F.max("best_sale").alias("highest_order_value")), "highest_order_value"
    )


@query(
    "rpt_15_ranked_customers",
    sql("sales", TOTALS + f"""
        SELECT customer_id, customer_name, {DBL}, rank() OVER (ORDER BY t.total_sales DESC) AS sales_rank FROM t"""),
)
def rpt_15(spark, sf):
    return W.ranked_customers(totals(spark, sf))


@query(
    "rpt_15_top_ranked_customers",
    sql("sales", TOTALS + f"""
        SELECT * FROM (SELECT customer_id, customer_name, {DBL},
                              rank() OVER (ORDER BY t.total_sales DESC) AS sales_rank FROM t) WHERE sales_rank <= 3"""),
)
def rpt_15_top(spark, sf):
    return W.top_ranked_customers(totals(spark, sf), 3)


@query(
    "rpt_15_customer_name_ranking",
    sql("sales", TOTALS + f"""
        SELECT customer_name, {DBL}, rank() OVER (ORDER BY t.total_sales DESC) AS sales_rank FROM t"""),
)
def rpt_15_name(spark, sf):
    return W.ranked_customers(totals(spark, sf)).drop("customer_id")


@query(
    "rpt_16_order_sequence",
    sql("sales", """
        SELECT customer_id, order_id, line_number, product_id, order_date, CAST(sales AS DOUBLE) AS sales,
               row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id, line_number, product_id,
                                  supplier_id, quantity, sales.sales) AS order_number
        FROM sales"""),
)
def rpt_16(spark, sf):
    seq = W.order_sequence(A.sales(spark, sf, ("order",)))
    return doubled(
        seq.select("customer_id", "order_id", "line_number", "product_id", "order_date", "sales", "order_number"),
        "sales",
    )


@query(
    "rpt_17_single_order_customers",
    sql("sales", TOTALS + " SELECT customer_id, customer_name, order_count FROM t WHERE order_count = 1"),
)
def rpt_17(spark, sf):
    return W.single_purchase_customers(totals(spark, sf))


@query(
    "rpt_17_single_line_customers",
    sql("sales ord", """
        SELECT s.customer_id, customer_name, count(*) AS line_count FROM sales s JOIN ord o ON o.order_id = s.order_id
        WHERE status = 'Returned' GROUP BY 1, 2 HAVING count(*) = 1"""),
)
def rpt_17_lines(spark, sf):
    returned = A.orders(spark, sf).filter(F.col("status") == "Returned")
    per_customer = W.customer_totals(A.sales(spark, sf), returned, named_customers(spark, sf))
    return W.single_purchase_customers(per_customer, "line_count")


@query(
    "rpt_18_top_customers",
    sql("sales", TOTALS + f"""
        SELECT customer_id, customer_name, {DBL} FROM t ORDER BY t.total_sales DESC, customer_id LIMIT 5"""),
)
def rpt_18_top(spark, sf):
    slim = totals(spark, sf).select("customer_id", "customer_name", "total_sales")
    return doubled(agg.top_k(slim, "total_sales", 5, ["customer_id"]), "total_sales")


@query(
    "rpt_18_bottom_customers",
    sql("sales", TOTALS + f"""
        SELECT customer_id, customer_name, {DBL} FROM t ORDER BY t.total_sales, customer_id LIMIT 5"""),
)
def rpt_18_bottom(spark, sf):
    slim = totals(spark, sf).select("customer_id", "customer_name", "total_sales")
    return doubled(agg.top_k(slim, "total_sales", 5, ["customer_id"], ascending=True), "total_sales")


@query(
    "rpt_19_busiest_customers",
    sql("sales", TOTALS + """
        SELECT customer_id, customer_name, line_count FROM t ORDER BY line_count DESC, customer_id LIMIT 10"""),
)
def rpt_19_busiest(spark, sf):
    slim = totals(spark, sf).select("customer_id", "customer_name", "line_count")
    return agg.top_k(slim, "line_count", 10, ["customer_id"])


@query(
    "rpt_19_most_profitable_customers",
    sql("sales", TOTALS + f"""
        SELECT customer_id, customer_name, {PROFIT} FROM t ORDER BY t.total_profit DESC, customer_id LIMIT 10"""),
)
def rpt_19_profit(spark, sf):
    slim = totals(spark, sf).select("customer_id", "customer_name", "total_profit")
    return doubled(agg.top_k(slim, "total_profit", 10, ["customer_id"]), "total_profit")


def product_totals(spark, sf, measure):
    names = A.products(spark, sf).select("product_id", "product_name")
    per_product = agg.total_by(A.sales(spark, sf), ["product_id"], {f"total_{measure}": measure})
    return agg.total_by(
        per_product.join(names, "product_id"), ["product_name"], {f"total_{measure}": f"total_{measure}"}
    )


def product_sql(measure, direction):
    return sql("sales", f"""
        WITH p AS (SELECT product_name, sum({measure}) AS t FROM sales GROUP BY 1)
        SELECT product_name, CAST(round(t, 2) AS DOUBLE) AS total_{measure}
        FROM p ORDER BY t {direction}, product_name LIMIT 10""")


@query("rpt_20_top_products_by_revenue", product_sql("sales", "DESC"))
def rpt_20_revenue(spark, sf):
    return doubled(agg.top_k(product_totals(spark, sf, "sales"), "total_sales", 10, ["product_name"]), "total_sales")


@query("rpt_20_top_products_by_profit", product_sql("profit", "DESC"))
def rpt_20_profit(spark, sf):
    top = agg.top_k(product_totals(spark, sf, "profit"), "total_profit", 10, ["product_name"])
    return doubled(top, "total_profit")


@query("rpt_20_loss_making_products", product_sql("profit", "ASC"))
def rpt_20_loss(spark, sf):
    low = agg.top_k(product_totals(spark, sf, "profit"), "total_profit", 10, ["product_name"], ascending=True)
    return doubled(low, "total_profit")


@query("rpt_21_loss_making_count", sql("sales", "SELECT count(*) AS negative_profit_records FROM sales WHERE profit < 0"))
def rpt_21(spark, sf):
    return A.sales(spark, sf).filter(F.col("profit") < 0).agg(F.count(F.lit(1)).alias("negative_profit_records"))


@query(
    "rpt_22_customers_and_average_per_segment",
    sql("sales", """
        SELECT segment, count(DISTINCT customer_id) AS total_customers,
               round(CAST(sum(sales) AS DOUBLE) / count(*), 4) AS avg_sales FROM sales GROUP BY 1"""),
)
def rpt_22(spark, sf):
    lines = W.customer_lines(A.sales(spark, sf), A.orders(spark, sf))
    return W.customers_per_segment(lines, named_customers(spark, sf))


@query(
    "rpt_23_highest_value_orders",
    sql("sales", """
        SELECT order_id, CAST(sum(sales) AS DOUBLE) AS total_sales FROM sales GROUP BY 1
        ORDER BY sum(sales) DESC, order_id LIMIT 10"""),
)
def rpt_23(spark, sf):
    per_order = agg.total_by(A.sales(spark, sf), ["order_id"], {"total_sales": "sales"})
    return doubled(agg.top_k(per_order, "total_sales", 10, ["order_id"]), "total_sales")


# ---- totals by a dimension (AGG-4, AGG-13, AGG-14, TOP-1, TOP-2, TOP-4)


def by_customer_attribute(spark, sf, attribute, measures):
    lines = W.customer_lines(A.sales(spark, sf), A.orders(spark, sf))
    who = named_customers(spark, sf, with_place=attribute in ("city", "region"))
    out = agg.total_by_attribute(lines, "customer_id", who, [attribute], {f"total_{m}": m for m in measures})
    return doubled(out, *[f"total_{m}" for m in measures])


def by_product_attribute(spark, sf, attribute, measures):
    what = A.products(spark, sf).withColumnRenamed("brand", "sub_category")
    out = agg.total_by_attribute(
        A.sales(spark, sf), "product_id", what, [attribute], {f"total_{m}": m for m in measures}
    )
    return doubled(out, *[f"total_{m}" for m in measures])


def total_sql(attribute, measures, expression=None):
    sums = ", ".join(f"CAST(round(sum({m}), 2) AS DOUBLE) AS total_{m}" for m in measures)
    return sql("sales", f"SELECT {expression or attribute} AS {attribute}, {sums} FROM sales GROUP BY 1")


def _register_totals():
    for attribute in ("region", "segment", "city"):
        for measures in (("sales",), ("profit",)):
            query(f"agg_4_total_{measures[0]}_by_{attribute}", total_sql(attribute, measures))(
                lambda spark, sf, a=attribute, m=measures: by_customer_attribute(spark, sf, a, m)
            )
    for attribute in ("category", "sub_category"):
        for measures in (("sales",), ("profit",)):
            query(f"agg_4_total_{measures[0]}_by_{attribute}", total_sql(attribute, measures))(
                lambda spark, sf, a=attribute, m=measures: by_product_attribute(spark, sf, a, m)
            )
    both = ("sales", "profit")
    query("agg_13_sales_and_profit_by_region", total_sql("region", both))(
        lambda spark, sf: by_customer_attribute(spark, sf, "region", both)
    )
    query("agg_13_sales_and_profit_by_category", total_sql("category", both))(
        lambda spark, sf: by_product_attribute(spark, sf, "category", both)
    )


_register_totals()


def by_order_date(spark, sf, name, part, measures=("sales",)):
    per_order = agg.total_by(A.sales(spark, sf), ["order_id"], {f"total_{m}": m for m in measures})
    dated = per_order.join(A.orders(spark, sf).select("order_id", "order_date"), "order_id")
    out = agg.total_by(
        dated.withColumn(name, part("order_date")), [name], {f"total_{m}": f"total_{m}" for m in measures}
    )
    return doubled(out, *[f"total_{m}" for m in measures])


@query("agg_14_sales_by_year", total_sql("sales_year", ("sales",), "year(order_date)"))
def agg_14_year(spark, sf):
    return by_order_date(spark, sf, "sales_year", F.year)


@query("agg_14_sales_by_month_of_year", total_sql("sales_month", ("sales",), "month(order_date)"))
def agg_14_month(spark, sf):
    return by_order_date(spark, sf, "sales_month", F.month)


@query("agg_13_sales_and_profit_by_year", total_sql("sales_year", ("sales", "profit"), "year(order_date)"))
def agg_13_year(spark, sf):
    return by_order_date(spark, sf, "sales_year", F.year, ("sales", "profit"))


@query(
    "top_1_products_by_sales",
    sql("sales", """
        SELECT product_id, CAST(sum(sales) AS DOUBLE) AS total_sales FROM sales GROUP BY 1
        ORDER BY sum(sales) DESC, product_id LIMIT 10"""),
)
def top_1(spark, sf):
    sums = agg.total_by(A.sales(spark, sf), ["product_id"], {"total_sales": "sales"})
    return doubled(agg.top_k(sums, "total_sales", 10, ["product_id"]), "total_sales")


@query(
    "top_2_products_by_profit_ascending",
    sql("sales", """
        SELECT product_id, CAST(round(sum(profit), 2) AS DOUBLE) AS total_profit FROM sales GROUP BY 1
        ORDER BY sum(profit), product_id LIMIT 10"""),
)
def top_2(spark, sf):
    sums = agg.total_by(A.sales(spark, sf), ["product_id"], {"total_profit": "profit"})
    return doubled(agg.top_k(sums, "total_profit", 10, ["product_id"], ascending=True), "total_profit")


@query(
    "top_4_cities_by_sales",
    sql("sales", """
        SELECT city, CAST(sum(sales) AS DOUBLE) AS total_sales FROM sales GROUP BY 1
        ORDER BY sum(sales) DESC, city LIMIT 10"""),
)
def top_4(spark, sf):
    return agg.top_k(by_customer_attribute(spark, sf, "city", ("sales",)), "total_sales", 10, ["city"])


# ---- ranks over the whole table (WIN-1, WIN-3, WIN-5, WIN-8)


@query(
    "win_1_rank_over_tied_counts",
    sql("sales", TOTALS + " SELECT customer_id, order_count, rank() OVER (ORDER BY order_count DESC) AS r FROM t"),
)
def win_1(spark, sf):
    slim = totals(spark, sf).select("customer_id", "order_count")
    return W.with_rank(slim, "order_count", ["customer_id"], "r")


@query(
    "win_5_dense_rank_over_tied_counts",
    sql("sales", TOTALS + " SELECT customer_id, order_count, dense_rank() OVER (ORDER BY order_count DESC) AS r FROM t"),
)
def win_5(spark, sf):
    slim = totals(spark, sf).select("customer_id", "order_count")
    return W.with_rank(slim, "order_count", ["customer_id"], "r", dense=True)
