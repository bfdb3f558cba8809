"""SQL twins of sources/adapters.py, used only by the oracle statements."""

from tidemark.registry.base import with_tables

CTES = {
    "ord": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
               CASE WHEN o_orderstatus = 'F' THEN 'Delivered' WHEN o_orderstatus = 'O' THEN 'Shipped'
                    WHEN o_totalprice < 100000 THEN 'Returned' ELSE 'Cancelled' END AS status,
               o_orderpriority AS payment_method, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount
        FROM orders""",
    "items": """
        SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS unit_price_at_purchase,
               CAST(CAST(l_discount AS DECIMAL(5,2)) * 100 AS DECIMAL(5,2)) AS discount_pct
        FROM lineitem""",
    "prod": """
        SELECT p_partkey AS product_id, p_name || ' #' || CAST(p_partkey AS VARCHAR) AS product_name,
               p_type AS category, p_brand AS brand, CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
               p_size * 20 AS stock_qty
        FROM part""",
    "cust": """
        SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name,
               lower(split_part(c_name, '#', 1)) || '.' || split_part(c_name, '#', 2) || '@example.com' AS email,
               c_mktsegment AS segment,
               CAST(DATE '1995-01-01' + CAST(floor(abs(c_acctbal) / 10) AS INTEGER) AS DATE) AS signup_date,
               n_name AS city, r_name AS region
        FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
             LEFT JOIN region ON r_regionkey = n_regionkey""",
    "sales": """
        SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id,
               l_suppkey AS supplier_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS sales,
               CAST(l_quantity AS INTEGER) AS quantity, CAST(l_discount AS DECIMAL(4,2)) AS discount,
               CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(0.05 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))
                   AS profit,
               CAST(l_shipdate AS DATE) AS ship_date, o_custkey AS customer_id,
               CAST(o_orderdate AS DATE) AS order_date, o_orderpriority AS ship_mode,
               split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2) AS customer_name,
               c_mktsegment AS segment, n_name AS city, r_name AS region,
               p_name || ' #' || CAST(p_partkey AS VARCHAR) AS product_name, p_type AS category,
               p_brand AS sub_category
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
             LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
             JOIN part ON p_partkey = l_partkey""",
    "trans": """
        SELECT * FROM trans_rows UNION ALL SELECT * FROM trans_rows WHERE sale_amount > 100""",
    "trans_rows": """
        SELECT 'U' || user_id AS user_id, CAST(ts AS DATE) AS transaction_date,
               CASE WHEN k < 25 THEN 'North' WHEN k < 50 THEN 'South' WHEN k < 75 THEN 'East' ELSE 'West' END AS region,
               event_type AS product_category, CAST(value AS DECIMAL(18,2)) AS sale_amount,
               CASE WHEN event_type = 'error' THEN NULL ELSE 'Active' END AS status,
               CASE WHEN k < 2 THEN 'Seattle' WHEN k < 40 THEN 'Austin' WHEN k < 70 THEN 'Chicago' ELSE 'New York' END
                   AS city,
               k AS age, CASE WHEN value < 20 THEN 'Basic' WHEN value < 60 THEN 'Premium' ELSE 'Pro' END AS subscription,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS raw_timestamp,
               CASE WHEN k >= 10 THEN 'user' || k || '@example.com' END AS email,
               CASE WHEN value < 5 THEN '' ELSE 'user_' || user_id END AS username,
               CASE WHEN value >= 4 THEN CAST(value AS DECIMAL(18,2)) END AS price, 'S' || (k // 2) AS store_id
        FROM (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k FROM events)""",
    "emp": """
        SELECT 'E' || c_custkey AS employee_id, c_name AS name, c_mktsegment AS department,
               CASE WHEN c_acctbal >= 0 THEN c_acctbal * 20 END AS salary, n_name AS city,
               strftime(DATE '2010-01-01' + CAST(floor(abs(c_acctbal) / 3) AS INTEGER), '%Y-%m-%d') AS join_date,
               CAST(floor(abs(c_acctbal) / 400) AS INTEGER) AS years_exp,
               CASE WHEN c_nationkey < 15 THEN 'Active' ELSE 'Inactive' END AS status
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "sample_rows": """
        SELECT CASE WHEN o_totalprice >= 10000 THEN l_orderkey END AS order_id, l_linenumber AS line_number,
               l_partkey AS product_id, p_type AS category,
               CASE WHEN l_linestatus = 'O' THEN 'West' WHEN l_tax > 0.02::DOUBLE THEN 'East' END AS region,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS ship_mode,
               CASE WHEN l_discount < 0.09::DOUBLE THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS price,
               CASE WHEN l_tax < 0.07::DOUBLE THEN CAST(l_quantity AS INTEGER) END AS quantity
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey""",
    "sample": """
        SELECT * FROM sample_rows UNION ALL SELECT * FROM sample_rows WHERE price > 100000""",
}


def sql(names: str, body: str) -> str:
    return with_tables(CTES, names, body)
