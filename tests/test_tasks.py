"""Rows of one task, and joins that need no sort."""

import datetime

from pyspark.sql import functions as F

from tidemark.functions.text import parsed_date, title_case
from tidemark.operators import joins
from tidemark.plans import clean_retail, jobs, retail

DAY = datetime.date(2024, 5, 1)


def shop(spark):
    orders = spark.createDataFrame(
        [(i, i % 7, DAY, "Cancelled" if i % 5 == 0 else "Delivered") for i in range(60)] + [(None, 1, DAY, "Delivered")],
        "order_id long, customer_id long, order_date date, status string",
    )
    items = spark.createDataFrame(
        [(i % 70, i % 3, i % 4) for i in range(400)] + [(None, 1, 1)], "order_id long, product_id long, quantity int"
    ).withColumn("unit_price_at_purchase", F.lit("2.50").cast("decimal(18,2)"))
    customers = spark.createDataFrame([(i, f"c{i}", "x", DAY) for i in range(7)], "customer_id long, first_name string, last_name string, signup_date date")
    products = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(3)], "product_id long, category string")
    return {"orders": orders, "items": items, "customers": customers, "products": products}


def test_items_are_dealt_by_order_before_they_are_summed(spark, plan_of, monkeypatch):
    items = shop(spark)["items"]
    for rows, tasks in ((joins.TASK_ROWS, 4), (10, 41)):
        monkeypatch.setattr(joins, "TASK_ROWS", rows)
        totals = retail.order_totals(items)
        plan = plan_of(totals, "simple")
        assert plan.count("Exchange ") == 1 and f"hashpartitioning(order_id#{items_id(plan)}, {tasks})" in plan
        assert plan.rindex("HashAggregate") < plan.index("Exchange ")
        got = {r.order_id: float(r.order_total) for r in totals.collect()}
        assert got == {r.order_id: 2.5 * r.n for r in items.groupBy("order_id").agg(F.sum("quantity").alias("n")).collect()}


def items_id(plan):
    return plan.split("hashpartitioning(order_id#")[1].split(",")[0]


def test_reports_start_from_order_values_that_are_stored_once(spark, plan_of):
    tables = retail.stored_values(shop(spark))
    orders, items, customers = (tables[n] for n in ("orders", "items", "customers"))
    expected = {
        "monthly-trend": retail.monthly_trend(orders, items),
        "top-customers": retail.lifetime_value(customers, orders, items),
        "segments": retail.segment_summary(retail.rfm_segments(orders, items)),
    }
    for name, df in expected.items():
        report = retail.REPORTS[name](tables)
        assert report.schema == df.schema and sorted(report.collect()) == sorted(df.collect()) != []
    assert "product_id" not in plan_of(retail.REPORTS["monthly-trend"](tables))


def dirty(spark):
    customers = spark.createDataFrame(
        [(f"C{i}", "a", "b", "a@b.de", "x y", "z", "2024-01-05", i) for i in range(6)] + [(None, "a", "b", None, None, "z", "soon", 9)],
        "customer_id string, first_name string, last_name string, email string, city string, state string, signup_date string, _seq long",
    )
    products = spark.createDataFrame([(f"P{i}", "p", "k", "2.50", "1") for i in range(4)], "product_id string, product_name string, category string, unit_price string, active string")
    dates = ["2024-1-5", "5/1/2024", "n/a", None, "2024-02-31"]
    orders = spark.createDataFrame(
        [(f"O{i}", f"C{i % 8}", dates[i % 5], "o'brien x", " upi ", i) for i in range(40)] + [("O1", "C1", "2025-1-1", "late", "COD", 99)],
        "order_id string, customer_id string, order_date string, status string, payment_method string, _seq long",
    )
    numbers = ["1", "-1", "12d", " 2 ", None]
    items = spark.createDataFrame(
        [(f"I{i}", f"O{i % 44}" if i % 9 else None, f"P{i % 5}", numbers[i % 5], "") for i in range(200)],
        "order_item_id string, order_id string, product_id string, quantity string, unit_price_at_purchase string",
    )
    return clean_retail.Retail(customers, products, orders, items)


def test_stored_keys_are_looked_up_without_a_sort(spark, plan_of, tmp_path, monkeypatch):
    raw = dirty(spark)
    clean = jobs.load_retail(raw, str(tmp_path / "a"))
    plain = clean_retail.cleaning_log(raw, clean)
    monkeypatch.setattr(joins, "BROADCAST", 2)
    again = jobs.load_retail(raw, str(tmp_path / "b"))
    hashed = clean_retail.cleaning_log(raw, again)
    assert plan_of(hashed).count("ShuffledHashJoin") > plan_of(plain).count("ShuffledHashJoin")
    assert sorted(hashed.collect()) == sorted(plain.collect())
    for name in ("orders", "items"):
        assert sorted(map(str, getattr(again, name).collect())) == sorted(map(str, getattr(clean, name).collect())) != []
    first = {r.order_id: r for r in clean.orders.collect()}
    assert first["O1"].status == "O'Brien X" and str(first["O1"].order_date) == "2024-01-05" and "O2" not in first
    assert first["O0"].payment_method == "UPI"
    # a table too large for the hash tables of all tasks is left to Spark
    monkeypatch.setattr(joins, "HASHED", 0)
    assert "shuffle_hash" not in plan_of(joins.looked_up(clean.orders), "extended")


def test_a_date_is_parsed_by_the_pattern_of_its_shape_only(spark, plan_of):
    texts = ["2024-0005-01", "+12024-1-5", "02024-1-5", "1/02/2024", " 1/2/2024", "2024-1/5", "2024--5-1", "n/a", "2024-1-5 ", "٢٠٢٤-1-5", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.coalesce(F.try_to_date("t", "yyyy-M-d"), F.try_to_date("t", "d/M/yyyy"))
    rows = df.select(parsed_date(F.col("t")).cast("string").alias("got"), plain.cast("string").alias("expected"))
    assert [r.got for r in rows.collect()] == [r.expected for r in rows.collect()]
    assert "RLIKE" in plan_of(df.select(parsed_date(F.col("t"))))


def test_plain_words_are_titled_like_others(spark):
    texts = ["no00x1", "NO001 -x", "no-é", "aBC\n", "ab\u0085", "a b", "Ⓐb", "straße", "x", "x1", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    runs = F.regexp_extract_all(F.lower("t"), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    plain = F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.left(r, F.lit(1))), F.substr(r, F.lit(2)))), "")
    rows = df.select(title_case(F.col("t")).alias("got"), plain.alias("expected")).collect()
    assert [r.got for r in rows] == [r.expected for r in rows]
