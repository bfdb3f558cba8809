"""Data quality and cleaning (DQ, CLN, ORD-2) and their SQL."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.functions.numbers import try_number, whole_or
from tidemark.functions.text import mapped, parsed_date, repaired_email, strip, title_case
from tidemark.operators import cleaning as C
from tidemark.operators import quality as Q
from tidemark.operators.joins import known_only
from tidemark.plans import catalogue, clean_retail, jobs, shop, transactions
from tidemark.registry.base import query, with_tables
from tidemark.registry.tables import CTES as CLEAN_CTES
from tidemark.session import scratch_path
from tidemark.sources import adapters as A
from tidemark.sources import dirty as D


def strip_sql(c):
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def title_sql(c):
    """Upper case after a non-letter. s[i - 1] is the character before the i-th."""
    return rf"""array_to_string(list_transform(string_split(lower({c}), ''), lambda ch, i:
        CASE WHEN i > 1 AND regexp_matches(substr(lower({c}), i - 1, 1), '\p{{L}}') THEN ch ELSE upper(ch) END), '')"""


def date_sql(c):
    return f"""coalesce(CAST(try_strptime({c}, '%Y-%m-%d') AS DATE), CAST(try_strptime({c}, '%d/%m/%Y') AS DATE))"""


def email_sql(c):
    mended = rf"regexp_replace(lower({strip_sql(c)}), '\.con$', '.com')"
    return rf"CASE WHEN regexp_matches({mended}, '^[^@\s]+@[^@\s]+\.[^@\s]+$') THEN {mended} END"


LATER = D.LATER
CTES = {
    **CLEAN_CTES,
    "raw_customers_rows": """
        SELECT CASE WHEN c_acctbal < -900 THEN '' WHEN c_acctbal < -850 THEN chr(9) ELSE 'C' || c_custkey END AS customer_id,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN ' o''brien mary-jane' ELSE '  cUSTOMER ' END AS first_name,
               'no' || split_part(c_name, '#', 2) AS last_name,
               CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '  CUSTOMER.' || split_part(c_name, '#', 2) || '@EXAMPLE.COM '
                    WHEN 'BUILDING' THEN 'customer.' || split_part(c_name, '#', 2) || '@example.con'
                    WHEN 'FURNITURE' THEN 'not-an-address' WHEN 'MACHINERY' THEN NULL
                    ELSE 'customer.' || split_part(c_name, '#', 2) || '@example.com' END AS email,
               upper(n_name) || ' ' AS city, lower(r_name) AS state,
               CASE WHEN c_acctbal BETWEEN 100 AND 300 THEN 'unknown'
                    WHEN c_mktsegment = 'AUTOMOBILE'
                    THEN strftime(DATE '1995-01-01' + CAST(floor(abs(c_acctbal) / 10) AS INTEGER), '%d/%m/%Y')
                    ELSE strftime(DATE '1995-01-01' + CAST(floor(abs(c_acctbal) / 10) AS INTEGER), '%Y-%m-%d')
               END AS signup_date, c_custkey AS _seq, c_acctbal
        FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "raw_customers": f"""
        SELECT * EXCLUDE (c_acctbal) FROM raw_customers_rows UNION ALL
        SELECT * EXCLUDE (c_acctbal) REPLACE ('Elsewhere' AS city, _seq + {LATER} AS _seq) FROM raw_customers_rows
        WHERE c_acctbal > 9500""",
    "raw_products": """
        SELECT 'P' || p_partkey AS product_id, p_name || ' #' || p_partkey AS product_name, p_type AS category,
               CASE p_size WHEN 1 THEN '' WHEN 2 THEN 'abc'
                    WHEN 3 THEN '-' || CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR)
                    ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END AS unit_price,
               CASE p_size WHEN 4 THEN '' WHEN 5 THEN 'yes' WHEN 6 THEN '0' WHEN 7 THEN '0.0' WHEN 8 THEN '1e12' ELSE '1' END AS active
        FROM part""",
    "raw_orders_rows": """
        SELECT 'O' || o_orderkey AS order_id,
               CASE WHEN o_totalprice < 3000 THEN 'C-unknown' WHEN o_totalprice < 4000 THEN '' ELSE 'C' || o_custkey END
                   AS customer_id,
               CASE WHEN o_totalprice BETWEEN 5000 AND 8000 THEN 'n/a'
                    WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%d/%m/%Y')
                    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN ' SHIPPED ' ELSE 'Cancelled' END AS status,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'upi' WHEN '2-HIGH' THEN 'Cash On Delivery'
                    WHEN '3-MEDIUM' THEN ' Cash on Delivery ' WHEN '5-LOW' THEN 'COD' ELSE 'Credit Card' END
                   AS payment_method, o_orderkey AS _seq, o_totalprice
        FROM orders""",
    "raw_orders": f"""
        SELECT * EXCLUDE (o_totalprice) FROM raw_orders_rows UNION ALL
        SELECT * EXCLUDE (o_totalprice) REPLACE ('returned' AS status, _seq + {LATER} AS _seq) FROM raw_orders_rows
        WHERE o_totalprice > 480000""",
    "raw_items": """
        SELECT 'I-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS order_item_id,
               CASE WHEN l_tax > 0.07::DOUBLE AND l_quantity < 5 THEN 'O-unknown' ELSE 'O' || l_orderkey END AS order_id,
               CASE WHEN l_discount > 0.09::DOUBLE AND l_quantity > 45 THEN 'P-unknown' ELSE 'P' || l_partkey END
                   AS product_id,
               CASE l_quantity WHEN 1 THEN '-1' WHEN 2 THEN 'abc' WHEN 3 THEN '0' WHEN 4 THEN '0.5' WHEN 5 THEN '12d'
                    WHEN 6 THEN '1e12'
                    ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity
        FROM lineitem""",
    "first_customers": f"""
        SELECT * FROM raw_customers WHERE {strip_sql("coalesce(customer_id, '')")} <> ''
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY _seq) = 1""",
    "c_customers": f"""
        SELECT customer_id, {title_sql(strip_sql('first_name'))} AS first_name,
               {title_sql(strip_sql('last_name'))} AS last_name, {email_sql('email')} AS email,
               {title_sql(strip_sql('city'))} AS city, upper({strip_sql('state')}) AS state,
               coalesce({date_sql('signup_date')}, (SELECT min({date_sql('signup_date')}) FROM first_customers))
                   AS signup_date
        FROM first_customers""",
    "typed_products": "SELECT * REPLACE (TRY_CAST(trim(unit_price) AS DOUBLE) AS unit_price) FROM raw_products",
    "c_products": """
        SELECT product_id, product_name, p.category, round(abs(coalesce(unit_price, m)), 2) AS unit_price,
               coalesce(TRY_CAST(trunc(TRY_CAST(trim(active) AS DOUBLE)) AS INTEGER), 1) AS active
        FROM typed_products p JOIN (SELECT category, median(unit_price) AS m FROM typed_products GROUP BY 1) g
             ON g.category = p.category""",
    "first_orders": """
        SELECT * FROM raw_orders QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _seq) = 1""",
    "c_orders": f"""
        SELECT order_id, customer_id, {date_sql('order_date')} AS order_date, {title_sql(strip_sql('status'))} AS status,
               CASE {strip_sql('payment_method')} WHEN 'upi' THEN 'UPI' WHEN 'Cash On Delivery' THEN 'COD'
                    WHEN 'Cash on Delivery' THEN 'COD' ELSE {strip_sql('payment_method')} END AS payment_method
        FROM first_orders WHERE customer_id IN (SELECT customer_id FROM c_customers)
             AND {date_sql('order_date')} IS NOT NULL""",
    "c_items": """
        SELECT order_item_id, i.order_id, i.product_id, TRY_CAST(quantity AS DOUBLE) AS quantity,
               unit_price AS unit_price_at_purchase
        FROM raw_items i JOIN c_products p ON p.product_id = i.product_id
        WHERE i.order_id IN (SELECT order_id FROM c_orders) AND TRY_CAST(quantity AS DOUBLE) > 0""",
}
CUSTOMERS = "raw_customers_rows raw_customers first_customers c_customers"
PRODUCTS = "raw_products typed_products c_products"
ORDERS = CUSTOMERS + " raw_orders_rows raw_orders first_orders c_orders"
ALL = ORDERS + " " + PRODUCTS + " raw_items c_items"


def sql(names, body):
    return with_tables(CTES, names, body)


# ---- reports


@query(
    "dq_1_null_counts",
    sql("trans_rows trans", "SELECT " + ", ".join(
        f"count(*) FILTER ({c} IS NULL) AS {c}"
        for c in ("user_id", "transaction_date", "region", "product_category", "sale_amount", "status", "city", "age",
                  "subscription", "raw_timestamp", "email", "username", "price", "store_id")) + " FROM trans"),
)
def dq_1(spark, sf):
    return Q.null_counts(A.transactions(spark, sf))


SAMPLE = ("order_id", "line_number", "product_id", "category", "region", "ship_mode", "price", "quantity")


@query(
    "dq_2_missing_share",
    sql("sample_rows sample", "SELECT * FROM (" + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS missing_count,
                   round(count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*), 2) AS missing_pct FROM sample"""
        for c in SAMPLE) + ") WHERE missing_count > 0"),
)
def dq_2(spark, sf):
    return Q.missing_summary(A.sales_sample(spark, sf))


@query(
    "dq_3_duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def dq_3(spark, sf):
    return Q.duplicate_keys(A.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_3_extra_copies",
    sql("trans_rows trans", """
        SELECT CAST(sum(n - 1) AS BIGINT) AS n_duplicates
        FROM (SELECT user_id, raw_timestamp, count(*) AS n FROM trans GROUP BY 1, 2)"""),
)
def dq_3_extra(spark, sf):
    return Q.extra_copies(A.transactions(spark, sf), ["user_id", "raw_timestamp"])


@query(
    "dq_4_range_and_sign",
    sql("sales", """
        SELECT count(*) FILTER (discount < 0 OR discount > 0.08) AS bad_discount, count(*) FILTER (sales.sales < 0) AS bad_sales,
               count(*) FILTER (profit < 0) AS losses, count(*) FILTER (ship_date < order_date) AS shipped_early FROM sales"""),
)
def dq_4(spark, sf):
    return A.sales(spark, sf, ("order",)).agg(
        F.count_if((F.col("discount") < 0) | (F.col("discount") > 0.08)).alias("bad_discount"),
        F.count_if(F.col("sales") < 0).alias("bad_sales"),
        F.count_if(F.col("profit") < 0).alias("losses"),
        F.count_if(F.col("ship_date") < F.col("order_date")).alias("shipped_early"),
    )


@query(
    "dq_5_column_listing",
    " UNION ALL ".join(
        f"SELECT {i + 1} AS ordinal, '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows FROM part"
        for i, (c, t) in enumerate([("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"),
                                    ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")])),
)
def dq_5(spark, sf):
    return Q.column_listing(A.table(spark, sf, "part"))


RULES_SQL = {"valid_email": "email IS NOT NULL", "paid": "price > 0", "adult": "age >= 18"}


def rules():
    return {name: F.expr(condition) for name, condition in RULES_SQL.items()}



@query(
    "dq_6_expectations_warn",
    sql("trans_rows trans", " UNION ALL ".join(
        f"""SELECT '{n}' AS rule, count(*) FILTER (coalesce({c}, false)) AS passed,
                   count(*) FILTER (NOT coalesce({c}, false)) AS failed FROM trans""" for n, c in RULES_SQL.items())),
)
def dq_6(spark, sf):
    return Q.expectation_report(A.transactions(spark, sf), rules())


@query(
    "dq_6_expectations_observed",
    sql("trans_rows trans", "SELECT store_id, count(*) AS n_rows FROM trans GROUP BY 1"),
)
def dq_6_observed(spark, sf):
    seen = Q.warn(A.transactions(spark, sf), rules(), Observation("rules"))
    return seen.groupBy("store_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "dq_7_expectations_drop",
    sql("trans_rows trans", """
        SELECT user_id, raw_timestamp, CAST(price AS DOUBLE) AS price, age FROM trans
        WHERE email IS NOT NULL AND price > 0 AND age >= 18"""),
)
def dq_7(spark, sf):
    rows = Q.expect_or_drop(A.transactions(spark, sf), rules())
    return rows.select("user_id", "raw_timestamp", F.col("price").cast("double").alias("price"), "age")


@query(
    "dq_8_quarantine",
    sql("trans_rows trans", """
        SELECT user_id, raw_timestamp, CASE WHEN email IS NULL THEN 'no_email' WHEN price IS NULL THEN 'no_price'
               WHEN age < 18 THEN 'minor' END AS reject_reason
        FROM trans WHERE email IS NULL OR price IS NULL OR age < 18"""),
)
def dq_8(spark, sf):
    reasons = {"no_email": F.col("email").isNull(), "no_price": F.col("price").isNull(), "minor": F.col("age") < 18}
    _, rejects = Q.quarantine(A.transactions(spark, sf), reasons)
    return rejects.select("user_id", "raw_timestamp", "reject_reason")


@query(
    "dq_9_constraints",
    sql("items prod ord", """
        SELECT 'primary_key' AS "constraint", count(*) - count(DISTINCT (order_id, line_number)) AS violations FROM items
        UNION ALL SELECT 'unique_product', count(*) - count(DISTINCT product_id) FROM items
        UNION ALL SELECT 'quantity_below_50', count(*) FILTER (NOT (quantity < 50)) FROM items
        UNION ALL SELECT 'product_id_not_null', count(*) FILTER (product_id IS NULL) FROM items
        UNION ALL SELECT 'known_order', count(*) FROM items
                  WHERE order_id NOT IN (SELECT order_id FROM ord WHERE status <> 'Returned')
        UNION ALL SELECT 'known_product', count(*) FROM items WHERE product_id NOT IN (SELECT product_id FROM prod)"""),
)
def dq_9(spark, sf):
    kept = A.orders(spark, sf).filter(F.col("status") != "Returned")
    return Q.validate(
        A.order_items(spark, sf),
        [
            Q.Unique("primary_key", ("order_id", "line_number")),
            Q.Unique("unique_product", ("product_id",), not_null=False),
            Q.Check("quantity_below_50", F.col("quantity") < 50),
            Q.not_null("product_id"),
            Q.ForeignKey("known_order", "order_id", kept, "order_id"),
            Q.ForeignKey("known_product", "product_id", A.products(spark, sf), "product_id"),
        ],
    )


@query(
    "dq_10_integrity_after_load",
    sql(ALL, """
        SELECT 'orphaned_orders' AS "constraint", count(*) AS violations FROM c_orders o
               LEFT JOIN c_customers c ON c.customer_id = o.customer_id WHERE c.customer_id IS NULL
        UNION ALL SELECT 'orphaned_items', count(*) FROM c_items i LEFT JOIN c_orders o ON o.order_id = i.order_id
                  WHERE o.order_id IS NULL
        UNION ALL SELECT 'bad_quantity', count(*) FROM c_items WHERE quantity <= 0
        UNION ALL SELECT 'negative_price', count(*) FROM c_products WHERE unit_price < 0"""),
)
def dq_10(spark, sf):
    return clean_retail.integrity_report(jobs.load_retail(D.raw_retail(spark, sf), scratch_path(spark, "clean")))


@query(
    "dq_11_cleaning_log",
    sql(ALL, f"""
        SELECT 'customers' AS table_name, 'missing_customer_id' AS rule, count(*) AS n_rows FROM raw_customers
               WHERE {strip_sql("coalesce(customer_id, '')")} = ''
        UNION ALL SELECT 'customers', 'duplicate_customer_id', count(*) - count(DISTINCT customer_id) FROM raw_customers
                  WHERE {strip_sql("coalesce(customer_id, '')")} <> ''
        UNION ALL SELECT 'customers', 'malformed_email', count(*) FROM first_customers
                  WHERE {email_sql('email')} IS NULL AND {strip_sql("coalesce(email, '')")} <> ''
        UNION ALL SELECT 'customers', 'unparsable_signup_date', count(*) FROM first_customers
                  WHERE {date_sql('signup_date')} IS NULL
        UNION ALL SELECT 'products', 'missing_price', count(*) FROM typed_products WHERE unit_price IS NULL
        UNION ALL SELECT 'products', 'negative_price', count(*) FROM typed_products WHERE unit_price < 0
        UNION ALL SELECT 'orders', 'duplicate_order_id', count(*) - count(DISTINCT order_id) FROM raw_orders
        UNION ALL SELECT 'orders', 'unknown_customer', count(*) FROM first_orders
                  WHERE customer_id NOT IN (SELECT customer_id FROM c_customers)
        UNION ALL SELECT 'orders', 'unparsable_order_date', count(*) FROM first_orders
                  WHERE customer_id IN (SELECT customer_id FROM c_customers) AND {date_sql('order_date')} IS NULL
        UNION ALL SELECT 'order_items', 'unknown_order', count(*) FROM raw_items
                  WHERE order_id NOT IN (SELECT order_id FROM c_orders)
        UNION ALL SELECT 'order_items', 'unknown_product', count(*) FROM raw_items
                  WHERE order_id IN (SELECT order_id FROM c_orders)
                        AND product_id NOT IN (SELECT product_id FROM c_products)
        UNION ALL SELECT 'order_items', 'bad_quantity', count(*) FROM raw_items
                  WHERE order_id IN (SELECT order_id FROM c_orders) AND product_id IN (SELECT product_id FROM c_products)
                        AND NOT coalesce(TRY_CAST(quantity AS DOUBLE) > 0, false)"""),
)
def dq_11(spark, sf):
    raw = D.raw_retail(spark, sf)
    return clean_retail.cleaning_log(raw, jobs.load_retail(raw, scratch_path(spark, "clean")))


@query(
    "dq_12_default_for_missing",
    sql("trans_rows trans", """
        SELECT user_id, raw_timestamp, coalesce(status, 'Pending') AS status, coalesce(email, 'none') AS email FROM trans"""),
)
def dq_12(spark, sf):
    filled = C.fill_values(A.transactions(spark, sf), {"status": "Pending", "email": "none"})
    return filled.select("user_id", "raw_timestamp", "status", "email")


# ---- cleaning steps


@query(
    "cln_1_drop_missing_key",
    sql(CUSTOMERS, f"SELECT customer_id, _seq FROM raw_customers WHERE {strip_sql('customer_id')} <> ''"),
)
def cln_1(spark, sf):
    return C.drop_missing_key(D.raw_customers(spark, sf), "customer_id").select("customer_id", "_seq")


@query(
    "cln_2_full_row_dedup",
    sql("trans_rows trans", """
        SELECT DISTINCT user_id, transaction_date, store_id, raw_timestamp, CAST(price AS DOUBLE) AS price FROM trans"""),
)
def cln_2(spark, sf):
    rows = A.transactions(spark, sf).select(
        "user_id", "transaction_date", "store_id", "raw_timestamp", F.col("price").cast("double").alias("price")
    )
    return C.full_row_dedup(rows)


@query("cln_3_subset_dedup", sql("trans_rows trans", "SELECT DISTINCT user_id, transaction_date FROM trans"))
def cln_3(spark, sf):
    return C.dedup_any(A.transactions(spark, sf), ["user_id", "transaction_date"]).select("user_id", "transaction_date")


@query("cln_4_keep_first", sql(CUSTOMERS, "SELECT * FROM first_customers"))
def cln_4(spark, sf):
    return C.dedup_first(C.drop_missing_key(D.raw_customers(spark, sf), "customer_id"), ["customer_id"], ["_seq"])


@query(
    "cln_5_fill_constant",
    sql("trans_rows trans", "SELECT user_id, raw_timestamp, coalesce(status, 'Unknown') AS status FROM trans"),
)
def cln_5(spark, sf):
    return C.fill_values(A.transactions(spark, sf), {"status": "Unknown"}).select("user_id", "raw_timestamp", "status")


@query(
    "cln_6_drop_nulls",
    sql("trans_rows trans", """
        SELECT user_id, raw_timestamp, status, email FROM trans WHERE status IS NOT NULL AND email IS NOT NULL"""),
)
def cln_6(spark, sf):
    rows = C.drop_nulls(A.transactions(spark, sf), ["status", "email"])
    return rows.select("user_id", "raw_timestamp", "status", "email")


MEDIANS = """
    WITH m AS (SELECT median(CAST(price AS DOUBLE)) AS p, median(CAST(quantity AS DOUBLE)) AS q FROM sample)"""


@query(
    "cln_7_fill_median",
    sql("sample_rows sample", MEDIANS + """
        SELECT order_id, line_number, product_id, coalesce(CAST(price AS DOUBLE), p) AS price,
               CAST(round_even(coalesce(CAST(quantity AS DOUBLE), q), 0) AS INTEGER) AS quantity FROM sample, m"""),
)
def cln_7(spark, sf):
    rows = A.sales_sample(spark, sf).select("order_id", "line_number", "product_id", "price", "quantity")
    return C.fill_medians(rows, {"price": False, "quantity": True})


MODES = """
    r AS (SELECT region FROM sample WHERE region IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
    s AS (SELECT ship_mode FROM sample WHERE ship_mode IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"""


@query(
    "cln_8_fill_mode",
    sql("sample_rows sample", "WITH " + MODES + """
        SELECT order_id, line_number, product_id, coalesce(sample.region, r.region) AS region,
               coalesce(sample.ship_mode, s.ship_mode) AS ship_mode FROM sample, r, s"""),
)
def cln_8(spark, sf):
    rows = A.sales_sample(spark, sf).select("order_id", "line_number", "product_id", "region", "ship_mode")
    return C.fill_modes(rows, ["region", "ship_mode"])


@query(
    "cln_9_fill_group_median",
    sql(PRODUCTS, """
        SELECT product_id, p.category, coalesce(unit_price, m) AS unit_price FROM typed_products p
        JOIN (SELECT category, median(unit_price) AS m FROM typed_products GROUP BY 1) g ON g.category = p.category"""),
)
def cln_9(spark, sf):
    rows = D.raw_products(spark, sf).withColumn("unit_price", try_number(F.col("unit_price")))
    return C.fill_group_median(rows, "unit_price", "category").select("product_id", "category", "unit_price")


@query(
    "cln_10_repair_negative",
    sql(PRODUCTS, "SELECT product_id, round(abs(unit_price), 2) AS unit_price FROM typed_products"),
)
def cln_10(spark, sf):
    rows = D.raw_products(spark, sf).withColumn("unit_price", try_number(F.col("unit_price")))
    return rows.select("product_id", C.repair_negative("unit_price").alias("unit_price"))


@query(
    "cln_11_drop_non_positive",
    sql("raw_items", """
        SELECT order_item_id, order_id, product_id, TRY_CAST(quantity AS DOUBLE) AS quantity FROM raw_items
        WHERE TRY_CAST(quantity AS DOUBLE) > 0"""),
)
def cln_11(spark, sf):
    return C.drop_non_positive(D.raw_items(spark, sf), "quantity").drop("unit_price_at_purchase")


@query(
    "cln_12_normalise_names",
    sql(CUSTOMERS, f"""
        SELECT _seq, {title_sql(strip_sql('first_name'))} AS first_name, {title_sql(strip_sql('city'))} AS city,
               upper({strip_sql('state')}) AS state FROM raw_customers"""),
)
def cln_12(spark, sf):
    return D.raw_customers(spark, sf).select(
        "_seq", title_case(strip(F.col("first_name"))).alias("first_name"),
        title_case(strip(F.col("city"))).alias("city"), F.upper(strip(F.col("state"))).alias("state"),
    )


@query("cln_13_email_repair", sql(CUSTOMERS, f"SELECT _seq, {email_sql('email')} AS email FROM raw_customers"))
def cln_13(spark, sf):
    return D.raw_customers(spark, sf).select("_seq", repaired_email(F.col("email")).alias("email"))


@query(
    "cln_14_status_and_payment",
    sql("raw_orders_rows raw_orders", f"""
        SELECT _seq, {title_sql(strip_sql('status'))} AS status,
               CASE {strip_sql('payment_method')} WHEN 'upi' THEN 'UPI' WHEN 'Cash On Delivery' THEN 'COD'
                    WHEN 'Cash on Delivery' THEN 'COD' ELSE {strip_sql('payment_method')} END AS payment_method
        FROM raw_orders"""),
)
def cln_14(spark, sf):
    return D.raw_orders(spark, sf).select(
        "_seq", title_case(strip(F.col("status"))).alias("status"),
        mapped(strip(F.col("payment_method")), clean_retail.PAYMENT_LABELS).alias("payment_method"),
    )


@query(
    "cln_15_unparsable_dates",
    sql(CUSTOMERS, f"""
        SELECT _seq, coalesce({date_sql('signup_date')}, (SELECT min({date_sql('signup_date')}) FROM raw_customers))
               AS signup_date FROM raw_customers"""),
)
def cln_15(spark, sf):
    rows = D.raw_customers(spark, sf).select("_seq", parsed_date(F.col("signup_date")).alias("signup_date"))
    earliest = rows.agg(F.min("signup_date").alias("earliest"))
    return rows.crossJoin(F.broadcast(earliest)).select("_seq", F.coalesce("signup_date", "earliest").alias("signup_date"))


@query("cln_15_orders_without_date_dropped", sql(ORDERS, "SELECT order_id, order_date FROM c_orders"))
def cln_15_orders(spark, sf):
    customers = clean_retail.clean_customers(D.raw_customers(spark, sf))
    return clean_retail.clean_orders(D.raw_orders(spark, sf), customers).select("order_id", "order_date")


@query(
    "cln_16_orphan_chain",
    sql(ORDERS + " raw_items", """
        SELECT order_item_id, order_id FROM raw_items WHERE order_id IN (SELECT order_id FROM c_orders)"""),
)
def cln_16(spark, sf):
    customers = clean_retail.clean_customers(D.raw_customers(spark, sf))
    kept = clean_retail.clean_orders(D.raw_orders(spark, sf), customers)
    return known_only(D.raw_items(spark, sf), "order_id", kept).select("order_item_id", "order_id")


@query(
    "cln_17_price_at_purchase",
    sql(PRODUCTS + " raw_items", """
        SELECT order_item_id, i.product_id, unit_price AS unit_price_at_purchase
        FROM raw_items i LEFT JOIN c_products p ON p.product_id = i.product_id"""),
)
def cln_17(spark, sf):
    prices = clean_retail.clean_products(D.raw_products(spark, sf)).select("product_id", "unit_price")
    rows = D.raw_items(spark, sf).select("order_item_id", "product_id").join(prices, "product_id", "left")
    return rows.withColumnRenamed("unit_price", "unit_price_at_purchase")


@query("cln_18_clean_customers", sql(CUSTOMERS, "SELECT * FROM c_customers"))
def cln_18_customers(spark, sf):
    return clean_retail.clean_customers(D.raw_customers(spark, sf))


@query("cln_18_clean_products", sql(PRODUCTS, "SELECT * FROM c_products"))
def cln_18_products(spark, sf):
    return clean_retail.clean_products(D.raw_products(spark, sf))


@query("cln_18_clean_orders", sql(ORDERS, "SELECT * FROM c_orders"))
def cln_18_orders(spark, sf):
    return clean_retail.clean_retail(D.raw_retail(spark, sf)).orders


@query("cln_18_clean_items", sql(ALL, "SELECT * FROM c_items"))
def cln_18_items(spark, sf):
    return clean_retail.clean_retail(D.raw_retail(spark, sf)).items


@query(
    "cln_18_clean_sales_sample",
    sql("sample_rows sample", MEDIANS + ", " + MODES + """,
        f AS (SELECT DISTINCT order_id, line_number, product_id, category, coalesce(sample.region, r.region) AS region,
                     coalesce(sample.ship_mode, s.ship_mode) AS ship_mode, coalesce(CAST(price AS DOUBLE), p) AS price,
                     CAST(round_even(coalesce(CAST(quantity AS DOUBLE), q), 0) AS INTEGER) AS quantity
              FROM sample, m, r, s WHERE order_id IS NOT NULL)
        SELECT *, price * quantity AS total_amount FROM f"""),
)
def cln_18_sample(spark, sf):
    return catalogue.clean_sample(A.sales_sample(spark, sf))


@query(
    "cln_19_coerce_with_fallback",
    sql(PRODUCTS, "SELECT product_id, coalesce(TRY_CAST(trunc(TRY_CAST(active AS DOUBLE)) AS INTEGER), 1) AS active FROM raw_products"),
)
def cln_19(spark, sf):
    return D.raw_products(spark, sf).select(
        "product_id", whole_or(F.col("active"), 1).alias("active")
    )


@query(
    "cln_20_valid_users",
    sql("trans_rows trans", """
        SELECT user_id, email, username FROM trans WHERE email IS NOT NULL AND coalesce(trim(username), '') <> ''"""),
)
def cln_20(spark, sf):
    return transactions.valid_users(A.transactions(spark, sf)).select("user_id", "email", "username")


# ---- order batch


def batch(spark, sf):
    """All orders as one batch, and enough stock for it."""
    stocked = A.products(spark, sf).withColumn("stock_qty", F.col("stock_qty") + ENOUGH)
    return A.customers(spark, sf, with_place=False), stocked, A.orders(spark, sf), A.order_items(spark, sf)


ENOUGH = 1_000_000
BATCH = """
    WITH b AS (SELECT product_id, sum(quantity) AS wanted FROM items WHERE order_id IN (SELECT order_id FROM ord) GROUP BY 1),
         k AS (SELECT product_id, stock_qty + {extra} AS stock_qty FROM prod),
         x AS (SELECT count(*) AS failed FROM k JOIN b ON b.product_id = k.product_id WHERE stock_qty < wanted)"""


@query(
    "ord_2_apply_batch",
    sql("ord items prod", BATCH.format(extra=ENOUGH) + """
        SELECT k.product_id, CAST(CASE WHEN failed = 0 THEN stock_qty - coalesce(wanted, 0) ELSE stock_qty END AS BIGINT)
               AS stock_qty FROM k LEFT JOIN b ON b.product_id = k.product_id, x"""),
)
def ord_2(spark, sf):
    return shop.apply_batch(*batch(spark, sf)).select("product_id", "stock_qty")


@query(
    "ord_2_batch_problems",
    sql("ord items prod", BATCH.format(extra=-500) + " SELECT 'short_stock' AS problem, failed AS n FROM x WHERE failed > 0"),
)
def ord_2_problems(spark, sf):
    customers, stocked, orders, items = batch(spark, sf)
    short = stocked.withColumn("stock_qty", F.col("stock_qty") - ENOUGH - 500)
    return shop.batch_problems(customers, short, orders, items)
