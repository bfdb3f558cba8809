"""From dirty retail extracts to consistent tables, with a log of what was changed or dropped.

All raw columns are text. Where the first copy of a row wins, _seq gives the order of arrival.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import try_number, whole_or
from tidemark.functions.text import EMAIL, is_blank, mapped, parsed_date, repaired_email, strip, title_case
from tidemark.operators.cleaning import dedup_first, drop_missing_key, fill_group_median, repair_negative
from tidemark.operators.joins import known_only, looked_up, orphans
from tidemark.operators.quality import require
from tidemark.session import freeze

# Exact labels that are replaced.
PAYMENT_LABELS = {"upi": "UPI", "Cash On Delivery": "COD", "Cash on Delivery": "COD"}


@dataclass(frozen=True)
class Retail:
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    items: DataFrame


def clean_customers(raw: DataFrame) -> DataFrame:
    first = dedup_first(drop_missing_key(raw, "customer_id"), ["customer_id"], ["_seq"])
    tidy = first.select(
        "customer_id",
        title_case(strip(F.col("first_name"))).alias("first_name"),
        title_case(strip(F.col("last_name"))).alias("last_name"),
        repaired_email(F.col("email")).alias("email"),
        title_case(strip(F.col("city"))).alias("city"),
        F.upper(strip(F.col("state"))).alias("state"),
        parsed_date(F.col("signup_date")).alias("signup_date"),
    )
    # written once, so that looking up the earliest date does not deduplicate a second time
    stored = freeze(tidy)
    earliest = stored.agg(F.min("signup_date").alias("_earliest"))
    return (
        stored.crossJoin(F.broadcast(earliest))
        .withColumn("signup_date", F.coalesce("signup_date", "_earliest"))
        .drop("_earliest")
    )


def clean_products(raw: DataFrame) -> DataFrame:
    """The median that fills a gap is taken over the prices as delivered, negative ones included."""
    typed = raw.withColumn("unit_price", try_number(F.col("unit_price")))
    filled = fill_group_median(typed, "unit_price", "category")
    active = whole_or(F.col("active"), 1)
    return filled.select(
        "product_id", "product_name", "category", repair_negative("unit_price").alias("unit_price"), active.alias("active")
    )


def clean_orders(raw: DataFrame, customers: DataFrame) -> DataFrame:
    # mended before the first copy is taken: after that, the filter and the result would each parse the date
    tidy = raw.select(
        "order_id",
        "customer_id",
        parsed_date(F.col("order_date")).alias("order_date"),
        title_case(strip(F.col("status"))).alias("status"),
        mapped(strip(F.col("payment_method")), PAYMENT_LABELS).alias("payment_method"),
        "_seq",
    )
    first = dedup_first(tidy, ["order_id"], ["_seq"]).filter(F.col("order_date").isNotNull())
    return known_only(first, "customer_id", customers).drop("_seq")


def clean_items(raw: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """The price of an item is the cleaned catalogue price; its quantity stays the number it is."""
    quantity = try_number(F.col("quantity"))
    usable = raw.withColumn("quantity", quantity).filter(F.col("quantity") > 0)
    kept = known_only(usable, "order_id", orders)
    prices = products.select("product_id", F.col("unit_price").alias("unit_price_at_purchase"))
    return kept.drop("unit_price_at_purchase").join(prices, "product_id").select(
        "order_item_id", "order_id", "product_id", "quantity", "unit_price_at_purchase"
    )


def clean_retail(raw: Retail) -> Retail:
    customers = clean_customers(raw.customers)
    products = clean_products(raw.products)
    orders = clean_orders(raw.orders, customers)
    return Retail(customers, products, orders, clean_items(raw.items, orders, products))


def integrity_report(t: Retail) -> DataFrame:
    checks = {
        "orphaned_orders": orphans(t.orders, "customer_id", t.customers),
        "orphaned_items": orphans(t.items, "order_id", looked_up(t.orders)),
        "bad_quantity": t.items.filter(F.col("quantity") <= 0),
        "negative_price": t.products.filter(F.col("unit_price") < 0),
    }
    counted = [
        rows.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("constraint"), "violations")
        for name, rows in checks.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def assert_clean(t: Retail) -> None:
    require(integrity_report(t))


def cleaning_log(raw: Retail, clean: Retail) -> DataFrame:
    """Rows per table and rule: what was dropped, filled or mended. Every raw table is read once.

    clean should be stored tables; only their keys are looked up.
    """

    def lines(table: str, counted: DataFrame) -> DataFrame:
        pairs = F.array(
            *[F.struct(F.lit(c).alias("rule"), F.coalesce(F.col(c), F.lit(0)).cast("long").alias("n_rows"))
              for c in counted.columns]
        )
        return counted.select(F.lit(table).alias("table_name"), F.inline(pairs))

    def marked(df: DataFrame, key: str, parent: DataFrame, name: str) -> DataFrame:
        keys = parent.select(key).withColumn(name, F.lit(True))
        return df.join(keys, key, "left").withColumn(name, F.col(name).isNotNull())

    repeats = F.col("_copies") - 1

    # rows without an id form one group of their own
    nameless = F.when(~is_blank(F.col("customer_id")), F.col("customer_id"))
    first = dedup_first(raw.customers.withColumn("customer_id", nameless), ["customer_id"], ["_seq"], copies="_copies")
    named = F.col("customer_id").isNotNull()
    mended = F.regexp_replace(F.lower(strip(F.coalesce("email", F.lit("")))), r"\.con$", ".com")
    customers = first.agg(
        F.sum(F.when(~named, F.col("_copies"))).alias("missing_customer_id"),
        F.sum(F.when(named, repeats)).alias("duplicate_customer_id"),
        F.count_if(named & ~mended.rlike(EMAIL) & (mended != "")).alias("malformed_email"),
        F.count_if(named & parsed_date(F.col("signup_date")).isNull()).alias("unparsable_signup_date"),
    )
    price = try_number(F.col("unit_price"))
    products = raw.products.agg(
        F.count_if(price.isNull()).alias("missing_price"), F.count_if(price < 0).alias("negative_price")
    )
    once = dedup_first(raw.orders, ["order_id"], ["_seq"], copies="_copies")
    known = F.col("_known")
    orders = marked(once, "customer_id", clean.customers, "_known").agg(
        F.sum(repeats).alias("duplicate_order_id"),
        F.count_if(~known).alias("unknown_customer"),
        F.count_if(known & parsed_date(F.col("order_date")).isNull()).alias("unparsable_order_date"),
    )
    placed = marked(raw.items, "order_id", looked_up(clean.orders), "_order")
    placed = marked(placed, "product_id", looked_up(clean.products), "_product")
    positive = F.coalesce(try_number(F.col("quantity")) > 0, F.lit(False))
    items = placed.agg(
        F.count_if(~F.col("_order")).alias("unknown_order"),
        F.count_if(F.col("_order") & ~F.col("_product")).alias("unknown_product"),
        F.count_if(F.col("_order") & F.col("_product") & ~positive).alias("bad_quantity"),
    )
    parts = {"customers": customers, "products": products, "orders": orders, "order_items": items}
    return reduce(DataFrame.unionByName, [lines(table, counted) for table, counted in parts.items()])
