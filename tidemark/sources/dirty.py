"""Dirty text extracts derived from the star schema, for the cleaning jobs.

Which rows are damaged, and how, follows from their own attributes. The SQL twins are in registry/cleaning.py.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.clean_retail import Retail
from tidemark.sources.adapters import money, places, table, twice_where

LATER = 1_000_000_000_000


def _text(c: Column) -> Column:
    return c.cast("string")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "customer")
    base = base.join(places(spark, sf_dir), base.c_nationkey == F.col("n_nationkey"))
    segment, balance, number = F.col("c_mktsegment"), F.col("c_acctbal"), F.split("c_name", "#")[1]
    day = F.date_add(F.lit("1995-01-01").cast("date"), F.floor(F.abs(balance) / 10).cast("int"))
    email = (
        F.when(segment == "HOUSEHOLD", F.concat(F.lit("  CUSTOMER."), number, F.lit("@EXAMPLE.COM ")))
        .when(segment == "BUILDING", F.concat(F.lit("customer."), number, F.lit("@example.con")))
        .when(segment == "FURNITURE", "not-an-address")
        .when(segment != "MACHINERY", F.concat(F.lit("customer."), number, F.lit("@example.com")))
    )
    rows = base.select(
        F.when(balance < -900, "").when(balance < -850, "\t").otherwise(F.concat(F.lit("C"), _text(F.col("c_custkey")))).alias("customer_id"),
        F.when(segment == "MACHINERY", " o'brien mary-jane").otherwise("  cUSTOMER ").alias("first_name"),
        F.concat(F.lit("no"), number).alias("last_name"),
        email.alias("email"),
        F.concat(F.upper("city"), F.lit(" ")).alias("city"),
        F.lower("region").alias("state"),
        F.when(balance.between(100, 300), "unknown")
        .when(segment == "AUTOMOBILE", F.date_format(day, "dd/MM/yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
        .alias("signup_date"),
        F.col("c_custkey").alias("_seq"),
        balance.alias("_balance"),
    )
    later = {"_seq": F.col("_seq") + LATER, "city": F.lit("Elsewhere")}
    return twice_where(rows, F.col("_balance") > 9500, later).drop("_balance")


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, price = F.col("p_size"), _text(money("p_retailprice"))
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), _text(F.col("p_partkey"))).alias("product_id"),
        F.concat(F.col("p_name"), F.lit(" #"), _text(F.col("p_partkey"))).alias("product_name"),
        F.col("p_type").alias("category"),
        F.when(size == 1, "").when(size == 2, "abc").when(size == 3, F.concat(F.lit("-"), price)).otherwise(price)
        .alias("unit_price"),
        F.when(size == 4, "").when(size == 5, "yes").when(size == 6, "0").when(size == 7, "0.0")
        .when(size == 8, "1e12").otherwise("1").alias("active"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    total, code, method, day = (F.col(c) for c in ("o_totalprice", "o_orderstatus", "o_orderpriority", "o_orderdate"))
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("O"), _text(F.col("o_orderkey"))).alias("order_id"),
        F.when(total < 3000, "C-unknown").when(total < 4000, "")
        .otherwise(F.concat(F.lit("C"), _text(F.col("o_custkey")))).alias("customer_id"),
        F.when(total.between(5000, 8000), "n/a")
        .when(method == "1-URGENT", F.date_format(day, "dd/MM/yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd")).alias("order_date"),
        F.when(code == "F", "delivered").when(code == "O", " SHIPPED ").otherwise("Cancelled").alias("status"),
        F.when(method == "1-URGENT", "upi").when(method == "2-HIGH", "Cash On Delivery")
        .when(method == "3-MEDIUM", " Cash on Delivery ").when(method == "5-LOW", "COD").otherwise("Credit Card")
        .alias("payment_method"),
        F.col("o_orderkey").alias("_seq"),
        total.alias("_total"),
    )
    later = {"_seq": F.col("_seq") + LATER, "status": F.lit("returned")}
    return twice_where(rows, F.col("_total") > 480000, later).drop("_total")


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity, key, part = F.col("l_quantity"), _text(F.col("l_orderkey")), _text(F.col("l_partkey"))
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", F.lit("I"), key, _text(F.col("l_linenumber")), part).alias("order_item_id"),
        F.when((F.col("l_tax") > 0.07) & (quantity < 5), "O-unknown").otherwise(F.concat(F.lit("O"), key))
        .alias("order_id"),
        F.when((F.col("l_discount") > 0.09) & (quantity > 45), "P-unknown").otherwise(F.concat(F.lit("P"), part))
        .alias("product_id"),
        F.when(quantity == 1, "-1").when(quantity == 2, "abc").when(quantity == 3, "0").when(quantity == 4, "0.5")
        .when(quantity == 5, "12d").when(quantity == 6, "1e12")
        .otherwise(_text(quantity.cast("int"))).alias("quantity"),
        F.lit("").alias("unit_price_at_purchase"),
    )


def raw_retail(spark: SparkSession, sf_dir: str) -> Retail:
    return Retail(
        raw_customers(spark, sf_dir), raw_products(spark, sf_dir), raw_orders(spark, sf_dir), raw_items(spark, sf_dir)
    )
