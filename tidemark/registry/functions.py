"""Scalar functions (FN) and whole jobs, with their SQL."""

from pyspark.sql import functions as F

from tidemark.functions.numbers import try_number
from tidemark.functions.text import epoch_to_timestamp, mapped, parsed_date, strip, title_case, us_date
from tidemark.plans import catalogue, jobs
from tidemark.plans import retail as R
from tidemark.registry import calls as RC
from tidemark.registry import cleaning as RK
from tidemark.registry.base import query
from tidemark.registry.basics import AS_OF, STAFF
from tidemark.registry.tables import sql
from tidemark.schemas import text_schema
from tidemark.session import scratch_path
from tidemark.sources import adapters as A
from tidemark.sources import dirty as D
from tidemark.sources.files import read_csv


@query("fn_1_month_key", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS m FROM orders")
def fn_1(spark, sf):
    return A.table(spark, sf, "orders").select("o_orderkey", R.month_of("o_orderdate").alias("m"))


@query("fn_2_year_month", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m FROM orders")
def fn_2(spark, sf):
    return A.table(spark, sf, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")
    )


US = "CASE WHEN o_totalprice < 10000 THEN 'tbd' ELSE CAST(month(o_orderdate) AS VARCHAR) || '/' || day(o_orderdate) || '/' || year(o_orderdate) END"


@query(
    "fn_3_text_date_parts",
    f"""SELECT o_orderkey, CAST(year(d) AS INTEGER) AS y, CAST(month(d) AS INTEGER) AS m
        FROM (SELECT o_orderkey, CAST(try_strptime({US}, '%m/%d/%Y') AS DATE) AS d FROM orders)""",
)
def fn_3(spark, sf):
    day = F.col("o_orderdate")
    text = F.when(F.col("o_totalprice") < 10000, "tbd").otherwise(F.date_format(day, "M/d/yyyy"))
    rows = A.table(spark, sf, "orders").select("o_orderkey", us_date(text).alias("d"))
    return rows.select("o_orderkey", F.year("d").alias("y"), F.month("d").alias("m"))


@query(
    "fn_4_day_difference",
    "SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') AS days FROM orders",
)
def fn_4(spark, sf):
    days = F.datediff(F.lit("2001-08-01").cast("date"), F.col("o_orderdate").cast("date"))
    return A.table(spark, sf, "orders").select("o_orderkey", days.cast("long").alias("days"))


@query(
    "fn_5_month_difference",
    "SELECT o_orderkey, CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 AS INTEGER) AS months FROM orders",
)
def fn_5(spark, sf):
    return A.table(spark, sf, "orders").select(
        "o_orderkey", (R.month_number("o_orderdate") - F.lit(1995 * 12 + 1)).alias("months")
    )


@query(
    "fn_6_epoch_to_timestamp",
    RC.sql("call_rows call_events", """
        SELECT agent_id, epoch_timestamp, CAST(TIMESTAMP '1970-01-01' + to_seconds(epoch_timestamp) AS TIMESTAMP) AS event_ts
        FROM call_events"""),
)
def fn_6(spark, sf):
    return A.calls(spark, sf).select(
        "agent_id", "epoch_timestamp", epoch_to_timestamp(F.col("epoch_timestamp")).alias("event_ts")
    )


@query(
    "fn_7_tenure",
    sql("emp", f"""
        SELECT employee_id, CAST(join_date AS DATE) AS join_date,
               date_diff('day', CAST(join_date AS DATE), DATE '{AS_OF}') AS days FROM emp"""),
)
def fn_7(spark, sf):
    rows = A.employees(spark, sf).select("employee_id", F.to_date("join_date").alias("join_date"))
    return rows.withColumn("days", F.datediff(F.lit(AS_OF).cast("date"), F.col("join_date")).cast("long"))


@query("fn_8_two_date_formats", RK.sql("raw_orders_rows raw_orders", f"SELECT _seq, {RK.date_sql('order_date')} AS order_date FROM raw_orders"))
def fn_8(spark, sf):
    return D.raw_orders(spark, sf).select("_seq", parsed_date(F.col("order_date")).alias("order_date"))


@query(
    "fn_9_safe_casts",
    RC.sql("changes", "SELECT age, TRY_CAST(customer_id AS INTEGER) AS customer_id, TRY_CAST(signup_date AS DATE) AS signup_date FROM changes"),
)
def fn_9(spark, sf):
    return A.customer_changes(spark, sf).select(
        "age", F.col("customer_id").try_cast("int").alias("customer_id"),
        F.col("signup_date").try_cast("date").alias("signup_date"),
    )


@query("fn_10_to_number", RK.sql("raw_items", "SELECT order_item_id, TRY_CAST(quantity AS DOUBLE) AS quantity FROM raw_items"))
def fn_10(spark, sf):
    return D.raw_items(spark, sf).select("order_item_id", try_number(F.col("quantity")).alias("quantity"))


@query(
    "fn_11_trim_and_case",
    RK.sql(RK.CUSTOMERS, f"""
        SELECT _seq, {RK.strip_sql('first_name')} AS stripped, lower(city) AS low, upper(state) AS high FROM raw_customers"""),
)
def fn_11(spark, sf):
    return D.raw_customers(spark, sf).select(
        "_seq", strip(F.col("first_name")).alias("stripped"), F.lower("city").alias("low"), F.upper("state").alias("high")
    )


@query("fn_12_title_case", RK.sql(RK.CUSTOMERS, f"SELECT _seq, {RK.title_sql('first_name')} AS titled FROM raw_customers"))
def fn_12(spark, sf):
    return D.raw_customers(spark, sf).select("_seq", title_case(F.col("first_name")).alias("titled"))


@query(
    "fn_13_regex",
    r"""SELECT p_partkey, regexp_replace(p_name, '[aeiou]+', '_', 'g') AS vowels, regexp_matches(p_name, '^(red|blue) ')::INTEGER
               AS coloured FROM part""",
)
def fn_13(spark, sf):
    return A.table(spark, sf, "part").select(
        "p_partkey", F.regexp_replace("p_name", "[aeiou]+", "_").alias("vowels"),
        F.col("p_name").rlike("^(red|blue) ").cast("int").alias("coloured"),
    )


@query(
    "fn_14_value_mapping",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Shipped' ELSE o_orderstatus END AS status FROM orders",
)
def fn_14(spark, sf):
    status = mapped(F.col("o_orderstatus"), {"F": "Delivered", "O": "Shipped"})
    return A.table(spark, sf, "orders").select("o_orderkey", status.alias("status"))


@query("fn_15_concat", sql("cust", "SELECT customer_id, first_name || ' ' || last_name AS customer_name FROM cust"))
def fn_15(spark, sf):
    return A.customers(spark, sf, with_place=False).select(
        "customer_id", F.concat("first_name", F.lit(" "), "last_name").alias("customer_name")
    )


@query(
    "fn_16_round",
    sql("items", """
        SELECT order_id, line_number, product_id, CAST(round(unit_price_at_purchase, 1) AS DOUBLE) AS tenths,
               CAST(round(unit_price_at_purchase, 0) AS DOUBLE) AS whole FROM items"""),
)
def fn_16(spark, sf):
    price = F.col("unit_price_at_purchase")
    return A.order_items(spark, sf).select(
        "order_id", "line_number", "product_id", F.round(price, 1).cast("double").alias("tenths"),
        F.round(price, 0).cast("double").alias("whole"),
    )


@query(
    "fn_17_abs_nullif_coalesce",
    "SELECT c_custkey, abs(c_acctbal) AS a, nullif(c_nationkey, 3) AS n, coalesce(nullif(c_nationkey, 3), -1) AS f FROM customer",
)
def fn_17(spark, sf):
    nation = F.nullif(F.col("c_nationkey"), F.lit(3))
    return A.table(spark, sf, "customer").select(
        "c_custkey", F.abs("c_acctbal").alias("a"), nation.alias("n"), F.coalesce(nation, F.lit(-1)).alias("f")
    )


@query(
    "fn_18_tokens",
    f"""SELECT doc_id, len({RC.TOKENS.format('text')}) AS n_tokens, array_to_string({RC.TOKENS.format('text')}, ' ') AS tokens
        FROM documents""",
)
def fn_18(spark, sf):
    from tidemark.functions.sentiment import tokens

    words = A.table(spark, sf, "documents").select("doc_id", tokens(F.col("text")).alias("t"))
    return words.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@query("fn_19_struct_fields", RC.sql("call_rows call_events", "SELECT call_id, channel, region FROM call_events"))
def fn_19(spark, sf):
    return A.calls(spark, sf).select("call_id", F.col("metadata.channel"), F.col("metadata.region"))


@query("fn_20_explode", RC.sql("call_rows call_events", """
    SELECT call_id, reply AS text FROM call_events WHERE has_segments = 1
    UNION ALL SELECT call_id, said FROM call_events WHERE has_segments = 1"""))
def fn_20(spark, sf):
    return A.calls(spark, sf).select("call_id", F.explode("transcript_segments").alias("s")).select("call_id", "s.text")


@query("fn_21_boolean_to_int", "SELECT c_custkey, CAST(c_acctbal < 0 AS INTEGER) AS in_debt FROM customer")
def fn_21(spark, sf):
    return A.table(spark, sf, "customer").select("c_custkey", (F.col("c_acctbal") < 0).cast("int").alias("in_debt"))


@query("fn_22_interval", "SELECT event_id, ts - INTERVAL 7 DAYS AS week_before FROM events")
def fn_22(spark, sf):
    return A.table(spark, sf, "events").select("event_id", (F.col("ts") - F.expr("INTERVAL 7 DAYS")).alias("week_before"))


# ---- whole jobs


@query("kpi_1_from_calls_job", RC.sql(RC.LEVEL, RC.sentiment_by_sql("date", "call_level")))
def job_calls(spark, sf):
    tables = jobs.calls_job(A.calls(spark, sf), A.customer_changes(spark, sf), scratch_path(spark, "calls-job"))
    return tables["sentiment_daily"]


@query(
    "dq_6_warn_counts_from_calls_job",
    RC.sql("call_rows call_events changes", """
        SELECT 'bronze_calls' AS table_name, rule, failed FROM (
            SELECT 'valid_call_id' AS rule, count(*) - count(call_id) AS failed FROM call_events
            UNION ALL SELECT 'valid_customer_id', count(*) - count(customer_id) FROM call_events
            UNION ALL SELECT 'valid_epoch', count(*) - count(epoch_timestamp) FROM call_events
            UNION ALL SELECT 'non_negative_duration', count(*) FILTER (duration_sec < 0) FROM call_events)
        UNION ALL SELECT 'bronze_changes', rule, failed FROM (
            SELECT 'valid_customer_id' AS rule, count(*) - count(customer_id) AS failed FROM changes
            UNION ALL SELECT 'valid_operation', count(*) - count(*) FILTER (operation IN ('INSERT', 'UPDATE', 'DELETE')) FROM changes
            UNION ALL SELECT 'valid_update_ts', count(*) - count(update_ts) FROM changes)"""),
)
def job_calls_warnings(spark, sf):
    tables = jobs.calls_job(A.calls(spark, sf), A.customer_changes(spark, sf), scratch_path(spark, "calls-job"))
    return tables["bronze_warnings"]


@query(
    "rpt_1_from_cleaning_job",
    RK.sql(RK.ALL, """
        SELECT category, CAST(round(sum(CAST(quantity AS DECIMAL(20,3)) * CAST(unit_price_at_purchase AS DECIMAL(18,2))), 2) AS DOUBLE)
               AS revenue
        FROM c_items i JOIN c_orders o ON o.order_id = i.order_id JOIN c_products p ON p.product_id = i.product_id
        WHERE status NOT IN ('Cancelled', 'Returned') GROUP BY 1"""),
)
def job_retail(spark, sf):
    paths = jobs.retail_job(D.raw_retail(spark, sf), scratch_path(spark, "retail-job"))
    columns = ["category", "orders_with_category", "units_sold", "revenue"]
    rows = read_csv(spark, paths["revenue-by-category"], text_schema(columns))
    return rows.select("category", F.col("revenue").cast("double").alias("revenue"))


@query("snk_1_workforce_job", sql("emp", STAFF + " SELECT * FROM b"))
def job_workforce(spark, sf):
    return jobs.workforce_job(A.employees(spark, sf), AS_OF, scratch_path(spark, "workforce-job"))


@query(
    "cln_5_product_listing",
    RK.sql(RK.PRODUCTS, """
        SELECT product_id, category, coalesce(unit_price, 0) AS unit_price, coalesce(active, 'Not Available') AS active
        FROM (SELECT * REPLACE (nullif(active, '') AS active) FROM typed_products)"""),
)
def cln_5_listing(spark, sf):
    rows = D.raw_products(spark, sf).withColumns(
        {"unit_price": try_number(F.col("unit_price")), "active": F.nullif(F.col("active"), F.lit(""))}
    )
    return catalogue.clean_listing(rows, {"unit_price": 0}, ["active"]).select(
        "product_id", "category", "unit_price", "active"
    )
