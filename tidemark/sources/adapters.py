"""The tables the reports expect, derived from the given star schema.

Each function has a twin of the same meaning in registry/tables.py, written as SQL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import TABLES

MONEY = "decimal(18,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def twice_where(rows: DataFrame, condition: Column, changed: Mapping[str, Column] | None = None) -> DataFrame:
    """All rows, and a copy of those that meet the condition with some columns changed, in one pass over them."""
    copies = F.when(condition, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    out = rows.withColumn("_copy", F.explode(copies))
    for name, value in (changed or {}).items():
        out = out.withColumn(name, F.when(F.col("_copy"), value).otherwise(F.col(name)))
    return out.drop("_copy")


def money(name: str) -> Column:
    return F.col(name).cast(MONEY)


def order_status() -> Column:
    code = F.col("o_orderstatus")
    return (
        F.when(code == "F", "Delivered")
        .when(code == "O", "Shipped")
        .when(F.col("o_totalprice") < 100000, "Returned")
        .otherwise("Cancelled")
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        order_status().alias("status"),
        F.col("o_orderpriority").alias("payment_method"),
        money("o_totalprice").alias("total_amount"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("unit_price_at_purchase"),
        (F.col("l_discount").cast("decimal(5,2)") * 100).cast("decimal(5,2)").alias("discount_pct"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        money("p_retailprice").alias("unit_price"),
        (F.col("p_size") * 20).alias("stock_qty"),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City and region of each nation; the tables have a fixed handful of rows."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey"), F.col("n_name").alias("city"), F.col("r_name").alias("region")
    )


def customers(spark: SparkSession, sf_dir: str, with_place: bool = True) -> DataFrame:
    base = table(spark, sf_dir, "customer")
    signup = F.date_add(F.lit("1995-01-01").cast("date"), F.floor(F.abs("c_acctbal") / 10).cast("int"))
    number = F.split("c_name", "#")
    out = base.select(
        F.col("c_custkey").alias("customer_id"),
        number[0].alias("first_name"),
        number[1].alias("last_name"),
        F.concat(F.lower(number[0]), F.lit("."), number[1], F.lit("@example.com")).alias("email"),
        F.col("c_mktsegment").alias("segment"),
        signup.alias("signup_date"),
        F.col("c_nationkey").alias("n_nationkey"),
    )
    if with_place:
        out = out.join(places(spark, sf_dir), "n_nationkey", "left")
    return out.drop("n_nationkey")


def sales(spark: SparkSession, sf_dir: str, dims: tuple[str, ...] = ()) -> DataFrame:
    """Wide sales rows. Only the dimensions asked for are joined: order, product, customer, place."""
    line = table(spark, sf_dir, "lineitem")
    price = money("l_extendedprice")
    out = line.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        price.alias("sales"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount"),
        (price * (F.lit("0.05").cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)"))).alias("profit"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
    )
    if {"order", "customer", "place"} & set(dims):
        head = table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_orderpriority").alias("ship_mode"),
        )
        out = out.join(head, "order_id")
    if {"customer", "place"} & set(dims):
        who = customers(spark, sf_dir, with_place="place" in dims)
        who = who.withColumn("customer_name", F.concat("first_name", F.lit(" "), "last_name"))
        out = out.join(who.drop("first_name", "last_name", "email", "signup_date"), "customer_id")
    if "product" in dims:
        what = products(spark, sf_dir).select(
            "product_id", "product_name", "category", F.col("brand").alias("sub_category")
        )
        out = out.join(what, "product_id")
    return out


def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number stored in their props, {"k": 12}, as a column k."""
    number = F.translate("props", '{}"k: ', "").cast("int")
    return table(spark, sf_dir, "events").withColumn("k", number)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point-of-sale rows with missing prices, e-mails and names and with exact duplicates."""
    k, value = F.col("k"), F.col("value")
    rows = numbered_events(spark, sf_dir).select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("user_id"),
        F.col("ts").cast("date").alias("transaction_date"),
        F.when(k < 25, "North").when(k < 50, "South").when(k < 75, "East").otherwise("West").alias("region"),
        F.col("event_type").alias("product_category"),
        value.cast(MONEY).alias("sale_amount"),
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise("Active").alias("status"),
        F.when(k < 2, "Seattle").when(k < 40, "Austin").when(k < 70, "Chicago").otherwise("New York").alias("city"),
        k.alias("age"),
        F.when(value < 20, "Basic").when(value < 60, "Premium").otherwise("Pro").alias("subscription"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("raw_timestamp"),
        F.when(k >= 10, F.concat(F.lit("user"), k.cast("string"), F.lit("@example.com"))).alias("email"),
        F.when(value < 5, "").otherwise(F.concat(F.lit("user_"), F.col("user_id").cast("string"))).alias("username"),
        F.when(value >= 4, value.cast(MONEY)).alias("price"),
        F.concat(F.lit("S"), F.floor(k / 2).cast("string")).alias("store_id"),
    )
    return twice_where(rows, F.col("sale_amount") > 100)


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staff rows as a text extract delivers them: join date as text, salary sometimes missing."""
    balance = F.col("c_acctbal")
    joined = F.date_add(F.lit("2010-01-01").cast("date"), F.floor(F.abs(balance) / 3).cast("int"))
    rows = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return rows.select(
        F.concat(F.lit("E"), F.col("c_custkey").cast("string")).alias("employee_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("department"),
        F.when(balance >= 0, balance * 20).alias("salary"),
        F.col("n_name").alias("city"),
        F.date_format(joined, "yyyy-MM-dd").alias("join_date"),
        F.floor(F.abs(balance) / 400).cast("int").alias("years_exp"),
        F.when(F.col("c_nationkey") < 15, "Active").otherwise("Inactive").alias("status"),
    )


def sales_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with gaps in price, quantity, region and ship mode, and with exact duplicates."""
    line, head = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    wide = line.join(head, line.l_orderkey == head.o_orderkey).join(
        table(spark, sf_dir, "part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")
    )
    rows = wide.select(
        F.when(F.col("o_totalprice") >= 10000, F.col("l_orderkey")).alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.when(F.col("l_linestatus") == "O", F.lit("West")).when(F.col("l_tax") > 0.02, "East").alias("region"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("ship_mode"),
        F.when(F.col("l_discount") < 0.09, money("l_extendedprice")).alias("price"),
        F.when(F.col("l_tax") < 0.07, F.col("l_quantity").cast("int")).alias("quantity"),
    )
    return twice_where(rows, F.col("price") > 100000)


def utc_seconds(name: str) -> Column:
    """Epoch seconds of a zone-free time read as UTC, whatever the session zone is."""
    days = F.datediff(F.col(name).cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(name) * 3600 + F.minute(name) * 60 + F.second(name)


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested call events, with missing ids, negative durations, missing times and re-delivered copies."""
    k, value, kind = F.col("k"), F.col("value"), F.col("event_type")
    said = (
        F.when(kind == "error", "I am extremely frustrated, this is a terrible problem. It never works!")
        .when(kind == "purchase", "Great service, very happy and thanks for the quick help")
        .when(kind == "view", "I have a question about my bill")
        .when((kind == "signup") & (k < 50), "absolutely brilliant onboarding, totally easy")
        .when(kind == "signup", "my refund is delayed")
        .otherwise("the issue was fixed but it is very very slow")
    )
    reply = F.when(k < 50, "How can I help you today").otherwise("Glad we solved it")

    def segment(speaker: str, text: Column, start: float) -> Column:
        return F.struct(
            F.lit(speaker).alias("speaker"), text.alias("text"), F.lit(start).cast("double").alias("start_sec")
        )

    rows = numbered_events(spark, sf_dir).select(
        F.when(value >= 0.5, F.concat(F.lit("C"), F.col("event_id").cast("string"))).alias("call_id"),
        F.when(k != 7, F.col("user_id").cast("int")).alias("customer_id"),
        F.concat(F.lit("A"), k.cast("string")).alias("agent_id"),
        F.when((k != 13) | (value > 3), utc_seconds("ts")).alias("epoch_timestamp"),
        F.when(value < 1, -1 - F.floor(value * 10)).otherwise(F.floor(value * 10)).cast("int").alias("duration_sec"),
        F.when(k != 17, F.array(segment("agent", reply, 0.0), segment("customer", said, 4.5)))
        .alias("transcript_segments"),
        F.struct(
            kind.alias("call_type"),
            F.when(k < 60, "phone").otherwise("chat").alias("channel"),
            F.when(k < 30, "Delhi").otherwise("Pune").alias("region"),
        ).alias("metadata"),
        F.when(value < 0.5, "malformed_missing_call_id").alias("_injection_type"),
    )
    return twice_where(rows, F.col("duration_sec") > 800)


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log as text, with null and uncastable keys, bad operations and missing times."""
    k, value, kind = F.col("k"), F.col("value"), F.col("event_type")
    user = F.col("user_id").cast("string")
    return numbered_events(spark, sf_dir).select(
        F.when(k == 99, F.lit(None)).when(k == 98, F.concat(F.lit("x"), user)).otherwise(user).alias("customer_id"),
        F.when(k < 20, "Delhi").when(k < 40, "Mumbai").when(k < 60, "Chennai").when(k < 80, "Pune")
        .otherwise("Jaipur").alias("city"),
        F.when(value > 20, "Premium").otherwise("Basic").alias("subscription_type"),
        k.cast("string").alias("age"),
        F.when(k == 50, "soon").otherwise("2023-05-17").alias("signup_date"),
        F.when(k == 97, "UPSERT").when(k == 96, F.lit(None)).when(kind == "signup", "INSERT")
        .when(kind == "error", "DELETE").otherwise("UPDATE").alias("operation"),
        F.when(k == 95, F.lit(None)).when(k == 94, "yesterday")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("update_ts"),
    )
