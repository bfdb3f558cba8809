"""Sources, sinks and streams (SRC, SNK, STR, CDC-6) and their SQL.

The files these queries read are written by Spark from the given tables, into the shared folder.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import history as H
from tidemark.operators.joins import tasks_for
from tidemark.plans import calls as P
from tidemark.plans import retail as R
from tidemark.registry import calls as RC
from tidemark.registry.base import ORACLES, query, with_tables
from tidemark.registry.tables import sql
from tidemark.schemas import CALLS, EMPLOYEES, TABLES
from tidemark.session import freeze, scratch_path
from tidemark.sinks import files as K
from tidemark.sources import adapters as A
from tidemark.sources import files as S
from tidemark.streaming import expectations as SE
from tidemark.streaming import history as SH
from tidemark.streaming import ingest as SI
from tidemark.streaming import kpis as SK
from tidemark.streaming import late as SL

EMP = "employee_id, name, department, salary, city, join_date, years_exp, status"


def land(df, label, kind, **options):
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").options(**options).format(kind).save(path)
    return path


def employee_csv(spark, sf, **options):
    return land(A.employees(spark, sf), "employees", "csv", header=True, **options)


# ---- sources


@query("src_1_csv_with_schema", sql("emp", f"SELECT {EMP} FROM emp"))
def src_1(spark, sf):
    return S.read_csv(spark, employee_csv(spark, sf), EMPLOYEES)


@query("src_2_csv_without_inference", sql("emp", "SELECT department, count(*) AS n, count(salary) AS paid FROM emp GROUP BY 1"))
def src_2(spark, sf):
    rows = S.read_csv(spark, employee_csv(spark, sf), EMPLOYEES)
    return rows.groupBy("department").agg(F.count(F.lit(1)).alias("n"), F.count("salary").alias("paid"))


@query(
    "src_3_all_text_csv",
    sql("emp", "SELECT employee_id, name, department, city, join_date, CAST(years_exp AS VARCHAR) AS years_exp, status FROM emp"),
)
def src_3(spark, sf):
    rows = S.read_text_csv(spark, employee_csv(spark, sf), EMPLOYEES.names)
    return rows.drop("salary", S.CORRUPT)


@query(
    "src_4_csv_latin1",
    "SELECT n_nationkey, 'Café ' || n_name AS label FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL",
)
def src_4(spark, sf):
    nation = A.table(spark, sf, "nation").join(
        A.table(spark, sf, "customer"), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi"
    )
    rows = nation.select("n_nationkey", F.concat(F.lit("Café "), F.col("n_name")).alias("label"))
    path = land(rows, "latin1", "csv", header=True, encoding="ISO-8859-1")
    return S.read_csv(spark, path, rows.schema, encoding="ISO-8859-1")


@query(
    "src_5_parquet_partition_filter",
    sql("emp", "SELECT employee_id, city, department FROM emp WHERE department = 'MACHINERY'"),
)
def src_5(spark, sf):
    path = scratch_path(spark, "by-department")
    K.write_partitioned(A.employees(spark, sf), path, ["department"])
    rows = S.read_parquet(spark, path, F.col("department") == "MACHINERY")
    return rows.select("employee_id", "city", "department")


CALL = "call_id, customer_id, agent_id, epoch_timestamp, duration_sec, call_type"


def call_json(spark, sf):
    return land(A.calls(spark, sf), "calls", "json")


def call_columns(rows):
    return rows.select(
        "call_id", "customer_id", "agent_id", "epoch_timestamp", "duration_sec",
        F.col("metadata.call_type").alias("call_type"), F.size("transcript_segments").alias("n_segments"),
    )


CALLS_SQL = RC.sql("call_rows call_events", f"""
    SELECT {CALL}, CASE WHEN has_segments = 1 THEN 2 END AS n_segments FROM call_events""")


@query("src_6_json_lines", CALLS_SQL)
def src_6(spark, sf):
    return call_columns(S.read_calls(spark, call_json(spark, sf)))


@query("src_7_json_file_stream", CALLS_SQL)
def src_7(spark, sf):
    base = scratch_path(spark, "bronze-calls")
    SI.ingest_calls(spark, call_json(spark, sf), f"{base}/table", f"{base}/checkpoint", max_files=2)
    return call_columns(spark.read.parquet(f"{base}/table"))


@query("src_8_csv_file_stream", RC.sql("changes", "SELECT * FROM changes"))
def src_8(spark, sf):
    base = scratch_path(spark, "bronze-changes")
    landing = land(A.customer_changes(spark, sf), "changes", "csv", header=True)
    SI.ingest_changes(spark, landing, f"{base}/table", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/table").drop("source_file", "ingestion_timestamp")


@query(
    "src_9_lineage_columns",
    RC.sql("call_rows call_events", """
        SELECT call_id, agent_id, epoch_timestamp, 'json' AS file_kind, true AS in_landing, true AS read_now FROM call_events"""),
)
def src_9(spark, sf):
    landing = call_json(spark, sf)
    rows = S.with_lineage(S.read_calls(spark, landing))
    return rows.select(
        "call_id", "agent_id", "epoch_timestamp", F.regexp_extract("source_file", r"\.(\w+)$", 1).alias("file_kind"),
        F.col("source_file").contains(landing.rsplit("/", 1)[-1]).alias("in_landing"),
        (F.abs(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("ingestion_timestamp")) < 60).alias("read_now"),
    )


@query(
    "src_10_drift_report",
    RC.sql("call_rows call_events", """
        SELECT 'priority' AS key, count(*) AS n_rows, 'undeclared' AS finding FROM call_events
        UNION ALL SELECT 'agent_id', count(*), 'known' FROM call_events
        UNION ALL SELECT 'metadata', count(*), 'known' FROM call_events
        UNION ALL SELECT 'call_id', count(call_id), 'known' FROM call_events
        UNION ALL SELECT 'customer_id', count(customer_id), 'known' FROM call_events
        UNION ALL SELECT 'epoch_timestamp', count(epoch_timestamp), 'known' FROM call_events
        UNION ALL SELECT 'transcript_segments', count(has_segments), 'known' FROM call_events
        UNION ALL SELECT '_injection_type', count(*) FILTER (call_id IS NULL), 'known' FROM call_events
        UNION ALL SELECT 'duration_sec', 0, 'never_seen'"""),
)
def src_10(spark, sf):
    rows = A.calls(spark, sf).drop("duration_sec").withColumn("priority", F.lit("high"))
    return S.drift_report(spark, land(rows, "drift", "json"), CALLS)


@query(
    "src_10_rescued_values",
    RC.sql("call_rows call_events", """
        SELECT 'priority' AS path, 'undeclared' AS finding, 'STRING' AS kind, '"high"' AS value, count(*) AS n_rows FROM call_events
        UNION ALL SELECT 'metadata.zone', 'undeclared', 'OBJECT', '{"code":"' || channel || '"}', count(*) FROM call_events GROUP BY channel
        UNION ALL SELECT 'duration_sec', 'type_change', 'STRING', '"' || duration_sec || '"', count(*) FROM call_events
                  WHERE duration_sec >= 0 GROUP BY duration_sec
        UNION ALL SELECT 'duration_sec', 'uncastable', 'STRING', '"none"', count(*) FROM call_events WHERE duration_sec < 0
        UNION ALL SELECT 'transcript_segments[].mood', 'undeclared', 'STRING', '"calm"', 2 * count(has_segments) FROM call_events"""),
)
def src_10_rescued(spark, sf):
    """Keys that the schema does not know, at three depths, and durations as text, are all found again in _rescued."""
    zone = F.col("metadata").withField("zone", F.struct(F.col("metadata.channel").alias("code")))
    duration = F.when(F.col("duration_sec") >= 0, F.col("duration_sec").cast("string")).otherwise("none")
    moods = F.transform("transcript_segments", lambda x: x.withField("mood", F.lit("calm")))
    rows = A.calls(spark, sf).withColumns({"priority": F.lit("high"), "metadata": zone, "duration_sec": duration, "transcript_segments": moods})
    path = scratch_path(spark, "rescued")
    S.read_rescued(spark, land(rows, "drift", "json"), CALLS).write.parquet(path)
    found = spark.read.parquet(path).select(F.explode(S.RESCUED).alias("x"))
    return found.groupBy("x.path", "x.finding", "x.kind", F.to_json("x.value").alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("src_11_named_table", "SELECT r_regionkey, r_name, count(*) AS nations FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1, 2")
def src_11(spark, sf):
    A.table(spark, sf, "nation").createOrReplaceTempView("nation")
    A.table(spark, sf, "region").createOrReplaceTempView("region")
    nations = spark.table("nation").groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.count(F.lit(1)).alias("nations"))
    return spark.table("region").join(nations, "r_regionkey")


@query("src_12_head", "SELECT event_id, ts, user_id FROM events ORDER BY event_id LIMIT 10")
def src_12_head(spark, sf):
    return S.sample_rows(A.table(spark, sf, "events").select("event_id", "ts", "user_id"), 10, ["event_id"])


@query("src_12_tail", "SELECT event_id, ts, user_id FROM events ORDER BY event_id DESC LIMIT 10")
def src_12_tail(spark, sf):
    return S.sample_rows(A.table(spark, sf, "events").select("event_id", "ts", "user_id"), 10, ["event_id"], last=True)


# ---- sinks


@query("snk_1_partitioned_parquet", sql("ord", "SELECT status, count(*) AS n FROM ord GROUP BY 1"))
def snk_1(spark, sf):
    path = scratch_path(spark, "orders-by-status")
    K.write_partitioned(A.orders(spark, sf), path, ["status"])
    return spark.read.parquet(path).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def bucketed_shop(spark, sf, buckets=8):
    """Orders and items as tables in buckets of the order id: `buckets`, or more if their tasks would get too many items."""
    base = scratch_path(spark, "shop")
    buckets = tasks_for(A.order_items(spark, sf), buckets)
    mark = base.rsplit("-", 1)[-1]
    orders = K.write_bucketed(A.orders(spark, sf), f"orders_{mark}", f"{base}/orders", "order_id", buckets)
    return orders, K.write_bucketed(A.order_items(spark, sf), f"items_{mark}", f"{base}/items", "order_id", buckets)


@query("snk_1_report_on_buckets", ORACLES["rpt_1_revenue_by_category"])
def snk_1_buckets(spark, sf):
    orders, items = bucketed_shop(spark, sf)
    return R.revenue_by_category(orders, items, A.products(spark, sf), dealt=True)


@query("jn_1_join_on_buckets", sql("ord items", """
    SELECT o.order_id, status, line_number, quantity FROM ord o JOIN items i ON i.order_id = o.order_id"""))
def jn_1_buckets(spark, sf):
    orders, items = bucketed_shop(spark, sf)
    return orders.join(items, "order_id").select("order_id", "status", "line_number", "quantity")


@query("snk_1_reloaded_partition", sql("ord", """
    SELECT order_id, customer_id, total_amount, payment_method, status = 'Shipped' AS reloaded FROM ord"""))
def snk_1_reload(spark, sf):
    """All statuses are written and one is loaded again; the others' files stay."""
    path, orders = scratch_path(spark, "orders-by-status"), A.orders(spark, sf).withColumn("reloaded", F.lit(False))
    K.write_partitioned(orders, path, ["status"])
    K.reload_partitions(orders.where("status = 'Shipped'").withColumn("reloaded", F.lit(True)), path, ["status"])
    return spark.read.parquet(path).select("order_id", "customer_id", "total_amount", "payment_method", "reloaded")


@query("snk_2_single_csv", sql("ord", "SELECT payment_method, count(*) AS total_orders FROM ord GROUP BY 1"))
def snk_2(spark, sf):
    path = scratch_path(spark, "summary")
    summary = A.orders(spark, sf).groupBy("payment_method").agg(F.count(F.lit(1)).alias("total_orders"))
    K.write_single_csv(summary, path)
    return S.read_csv(spark, path, summary.schema)


# The label and the measure of each exported report, and the label's and the measure's SQL.
EXPORTED = {
    "revenue-by-category": (["category"], "revenue"),
    "monthly-trend": (["order_month"], "revenue"),
    "top-customers": (["customer_name"], "lifetime_value"),
    "cohort-retention": (["cohort_month", "month_number"], "retention_pct"),
    "segments": (["segment"], "avg_spend"),
}


def exported_sql():
    """The lines of all report files: where they stand, what they are about and one measure."""
    queries = {
        "revenue-by-category": ("rpt_1_revenue_by_category", "revenue DESC, category"),
        "monthly-trend": ("rpt_2_monthly_trend", "order_month"),
        "top-customers": ("rpt_8_lifetime_value", "lifetime_value DESC, customer_id"),
        "cohort-retention": ("rpt_7_cohort_retention", "cohort_month, month_number"),
        "segments": ("rpt_6_segment_summary", "total_spend DESC, segment"),
    }
    return " UNION ALL ".join(
        f"""SELECT '{report}' AS report, row_number() OVER (ORDER BY {order}) AS line,
                   concat_ws('/', {', '.join(f'CAST({c} AS VARCHAR)' for c in EXPORTED[report][0])}) AS label,
                   {EXPORTED[report][1]} AS measure FROM ({ORACLES[name]})"""
        for report, (name, order) in queries.items()
    )


@query("snk_3_report_export", exported_sql())
def snk_3(spark, sf):
    """Every report is one small file, so the number of a line is its place in the only task that reads it."""
    tables = {
        "orders": A.orders(spark, sf), "items": A.order_items(spark, sf), "products": A.products(spark, sf),
        "customers": A.customers(spark, sf, with_place=False),
    }
    tables = R.stored_values(tables)
    reports = {name: report(tables) for name, report in R.REPORTS.items()}
    paths = K.export_reports(reports, scratch_path(spark, "reports"), R.REPORT_ORDER)
    parts = []
    for name, (label, measure) in EXPORTED.items():
        rows = S.read_csv(spark, paths[name], reports[name].schema)
        parts.append(rows.select(
            F.lit(name).alias("report"), (F.monotonically_increasing_id() + 1).alias("line"),
            F.concat_ws("/", *[F.col(c).cast("string") for c in label]).alias("label"), F.col(measure).alias("measure"),
        ))
    return reduce(DataFrame.unionByName, parts)


@query("snk_4_streaming_append", RC.sql(RC.SILVER, "SELECT * FROM silver"))
def snk_4(spark, sf):
    return str_7_stream(spark, sf)


@query("snk_5_copy_dataset", "SELECT 'source' AS side, count(*) AS n_rows, 3 AS n_columns FROM nation JOIN customer ON c_nationkey = n_nationkey UNION ALL SELECT 'target', count(*), 3 FROM nation JOIN customer ON c_nationkey = n_nationkey")
def snk_5(spark, sf):
    rows = A.table(spark, sf, "nation").join(A.table(spark, sf, "customer"), F.col("c_nationkey") == F.col("n_nationkey"))
    source = land(rows.select("n_nationkey", "n_name", "c_custkey"), "copy-source", "parquet")
    before, after = K.copy_dataset(spark, source, scratch_path(spark, "copy-target"))
    sides = [("source", before.n_rows, len(before.columns)), ("target", after.n_rows, len(after.columns))]
    return spark.createDataFrame(sides, "side string, n_rows long, n_columns int")


@query("snk_5_copied_rows", "SELECT * FROM lineitem")
def snk_5_rows(spark, sf):
    """The copy itself, made in steps of two files."""
    source, target = scratch_path(spark, "copy-source"), scratch_path(spark, "copy-target")
    A.table(spark, sf, "lineitem").repartition(5).write.parquet(source)
    K.copy_dataset(spark, source, target, step=2)
    return spark.read.schema(TABLES["lineitem"]).parquet(target)


WIDE_ORDER = ("order_date", "order_id", "line_number")


def split(spark, sf):
    return K.split_sales(A.sales(spark, sf, ("order", "place", "product")), WIDE_ORDER)


@query("snk_6_normalised_customers", sql("sales", "SELECT DISTINCT customer_id, customer_name, segment, city, region FROM sales"))
def snk_6_customers(spark, sf):
    return K.snapshot(split(spark, sf)["customers"], scratch_path(spark, "dim-customers"))


@query("snk_6_normalised_products", sql("sales", "SELECT DISTINCT product_id, product_name, category, sub_category FROM sales"))
def snk_6_products(spark, sf):
    return K.snapshot(split(spark, sf)["products"], scratch_path(spark, "dim-products"))


@query(
    "snk_6_normalised_orders",
    sql("sales", """
        SELECT order_id, line_number, product_id, customer_id, order_date, quantity, CAST(sales AS DOUBLE) AS sales
        FROM sales"""),
)
def snk_6_orders(spark, sf):
    facts = split(spark, sf)["orders"].withColumn("sales", F.col("sales").cast("double"))
    kept = facts.select("order_id", "line_number", "product_id", "customer_id", "order_date", "quantity", "sales")
    return K.snapshot(kept, scratch_path(spark, "fact-orders"))


@query("snk_7_snapshot", "SELECT * FROM supplier")
def snk_7(spark, sf):
    return K.snapshot(A.table(spark, sf, "supplier"), scratch_path(spark, "snapshot"))


@query(
    "snk_8_literal_rows",
    """SELECT * FROM supplier
       UNION ALL SELECT * FROM (VALUES (-1, 'Supplier#new', 3, 12.5), (-2, 'Supplier#other', 4, NULL))""",
)
def snk_8(spark, sf):
    rows = [(-1, "Supplier#new", 3, 12.5), (-2, "Supplier#other", 4, None)]
    return K.insert_rows(A.table(spark, sf, "supplier"), rows)


# ---- streams


@query("str_1_stream_with_watermark", RC.sql(RC.SILVER, "SELECT speaker, sentiment_label, count(*) AS n FROM silver GROUP BY 1, 2"))
def str_1(spark, sf):
    return str_7_stream(spark, sf).groupBy("speaker", "sentiment_label").agg(F.count(F.lit(1)).alias("n"))


@query("str_2_stream_dedup", RC.sql(RC.SILVER, "SELECT call_id, event_ts, count(*) AS n_segments FROM silver GROUP BY 1, 2"))
def str_2(spark, sf):
    return str_7_stream(spark, sf).groupBy("call_id", "event_ts").agg(F.count(F.lit(1)).alias("n_segments"))


@query("str_2_batch_dedup", RC.sql("call_rows call_events timed_calls", "SELECT call_id, event_ts FROM timed_calls"))
def str_2_batch(spark, sf):
    rows = P.expect_or_drop(P.with_event_time(A.calls(spark, sf)), P.silver_call_rules())
    return rows.dropDuplicates(["call_id", "event_ts"]).select("call_id", "event_ts")


@query("str_7_stream_silver_calls", RC.sql(RC.SILVER, "SELECT * FROM silver"))
def str_7_stream(spark, sf):
    """All files in one micro-batch, so that no row is late and the table equals the batch result."""
    base = scratch_path(spark, "silver-calls")
    SI.stream_silver_calls(spark, call_json(spark, sf), f"{base}/table", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/table")


@query("cdc_6_history_from_stream", RC.sql(RC.HISTORY, "SELECT * FROM history"))
def cdc_6(spark, sf):
    """The later half of the changes arrives first."""
    base, landing = scratch_path(spark, "history"), scratch_path(spark, "change-files")
    changes = A.customer_changes(spark, sf)
    late = F.coalesce(F.col("update_ts") >= "2024-01-15", F.lit(False))
    for part in (changes.filter(late), changes.filter(~late)):
        part.coalesce(8).write.mode("append").option("header", True).csv(landing)
        SH.follow_changes(spark, landing, base, f"{base}/checkpoint", buckets=16)
    return SH.read_history(spark, base)


@query("cdc_6_history_in_many_batches", RC.sql(RC.HISTORY, "SELECT * FROM history"))
def cdc_6_many(spark, sf):
    """Four batches in which every change is late to some other, and a fifth that delivers a part again; compacted between."""
    base, landing = scratch_path(spark, "history"), scratch_path(spark, "change-files")
    changes = A.customer_changes(spark, sf)
    part = F.pmod(F.xxhash64(*changes.columns), F.lit(8))
    for i, held in enumerate((part < 4, part.between(4, 5), part == 6, part == 7, part.isin(2, 6))):
        changes.where(held).write.option("header", True).csv(f"{landing}/{i}")
        SH.follow_changes(spark, f"{landing}/*", base, f"{base}/checkpoint", buckets=4, compact_rows=1000)
    return SH.read_history(spark, base)


# Four deliveries of eight days each; the calls of ten agents arrive three days late, so those of a delivery's last days
# come with the next one.
DELIVERED = RC.CTES | {
    "delivered": """
        SELECT *, CAST(TIMESTAMP '1970-01-01' + to_seconds(epoch_timestamp) AS TIMESTAMP) AS event_ts,
               least((epoch_timestamp + CASE WHEN CAST(agent_id[2:] AS INTEGER) BETWEEN 30 AND 39 THEN 259200 ELSE 0 END
                      - 1704067200) // 691200, 3) AS part
        FROM call_events WHERE duration_sec >= 0 AND epoch_timestamp IS NOT NULL AND call_id IS NOT NULL""",
    "limits": """
        SELECT part, max(max(event_ts)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
               - INTERVAL 30 MINUTES AS watermark
        FROM delivered GROUP BY part""",
    "judged": "SELECT *, coalesce(event_ts <= watermark, false) AS is_late FROM delivered JOIN limits USING (part)",
}
JUDGED = "call_rows call_events delivered limits judged"


def late_calls(spark, sf):
    """The four deliveries taken up one after another; gives the folder and the rows of state held after the last."""
    base, landing = scratch_path(spark, "late-calls"), scratch_path(spark, "deliveries")
    calls = A.calls(spark, sf)
    agent = F.substring("agent_id", 2, 9).cast("int")
    arrival = F.col("epoch_timestamp") + F.when(agent.between(30, 39), 259200).otherwise(0)
    part = F.coalesce(F.least(F.floor((arrival - 1704067200) / 691200), F.lit(3)), F.lit(0))
    held = 0
    for i in range(4):
        calls.where(part == i).write.json(f"{landing}/{i}")
        held = SL.follow_calls(spark, f"{landing}/*", base)
    return base, held


@query("str_3_late_rows", with_tables(DELIVERED, JUDGED, """
    SELECT call_id, event_ts, watermark, count(*) AS n_rows FROM judged WHERE is_late GROUP BY ALL"""))
def str_3_late(spark, sf):
    base, _ = late_calls(spark, sf)
    late = spark.read.parquet(f"{base}/late")
    return late.groupBy("call_id", "event_ts", "watermark").agg(F.count(F.lit(1)).alias("n_rows"))


@query("str_2_bounded_state", with_tables(DELIVERED, JUDGED, """
    SELECT (SELECT count(*) FROM judged WHERE is_late) AS n_late,
           count(*) AS n_kept, count(DISTINCT call_id) AS n_calls,
           count(*) FILTER (event_ts + INTERVAL 30 MINUTES > newest - INTERVAL 30 MINUTES) AS n_state
    FROM (SELECT *, max(event_ts) OVER () AS newest FROM (SELECT DISTINCT call_id, event_ts FROM judged WHERE NOT is_late))"""))
def str_2_state(spark, sf):
    base, held = late_calls(spark, sf)
    late = spark.read.parquet(f"{base}/late").agg(F.count(F.lit(1)).alias("n_late"))
    kept = spark.read.parquet(f"{base}/kept").agg(F.count(F.lit(1)).alias("n_kept"), F.count_distinct("call_id").alias("n_calls"))
    return late.crossJoin(kept).withColumn("n_state", F.lit(held).cast("long"))


def expectation_batches(spark, sf, rows, kind, ingest, rules):
    """The rows in eight files, two a micro-batch, and what the batches have counted in all."""
    base = scratch_path(spark, "expectations")
    rows.repartition(8).write.option("header", True).format(kind).save(f"{base}/landing")
    ingest(spark, f"{base}/landing", f"{base}/table", f"{base}/metrics", f"{base}/checkpoint", rules, max_files=2)
    return SE.totals(spark, f"{base}/metrics")


@query("dq_6_stream_of_calls", ORACLES["dq_6_bronze_calls"])
def dq_6_stream_calls(spark, sf):
    return expectation_batches(spark, sf, A.calls(spark, sf), "json", SE.ingest_calls_counted, P.bronze_call_rules())


@query("dq_11_stream_of_changes", ORACLES["dq_6_bronze_changes"])
def dq_11_stream_changes(spark, sf):
    return expectation_batches(spark, sf, A.customer_changes(spark, sf), "csv", SE.ingest_changes_counted, P.bronze_change_rules())


def kpi_stream(name):
    """A KPI after three batches of calls, the later two with a part delivered again."""

    def run(spark, sf):
        base, landing = scratch_path(spark, "kpis"), scratch_path(spark, "call-files")
        calls = A.calls(spark, sf)
        customers = None
        if name in ("region_sentiment", "subscription_sentiment"):
            customers = freeze(H.current(RC.history(spark, sf)).select("customer_id", "city", "subscription_type"))
        part = F.pmod(F.xxhash64("epoch_timestamp", "agent_id", "duration_sec"), F.lit(6))
        for i, held in enumerate((part < 3, part.between(2, 4), part.isin(0, 5))):
            calls.where(held).write.json(f"{landing}/{i}")
            SK.follow_calls(spark, f"{landing}/*", base, customers)
        return SK.read_kpi(spark, base, name)

    return run


for _id, _table, _oracle in (
    ("kpi_1", "sentiment_daily", "kpi_1_sentiment_daily"), ("kpi_2", "call_volume_daily", "kpi_2_call_volume_daily"),
    ("kpi_4", "region_sentiment", "kpi_4_region_sentiment"), ("kpi_5", "subscription_sentiment", "kpi_5_subscription_sentiment"),
):
    query(f"{_id}_stream_{_table}", ORACLES[_oracle])(kpi_stream(_table))
