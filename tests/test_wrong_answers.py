"""Small cases that the given tables do not hold."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.numbers import try_number, whole_or
from tidemark.operators import cleaning, joins
from tidemark.operators import quality as Q
from tidemark.plans import calls as P
from tidemark.plans import clean_retail as C
from tidemark.plans import jobs
from tidemark.plans import retail as R
from tidemark.sinks.files import export_reports
from tidemark.sources import adapters as A


def test_unknown_spenders_take_no_place_in_the_list(spark):
    day = dt.date(2024, 1, 1)
    orders = spark.createDataFrame([(i, i, day, "Delivered") for i in (1, 2, 3)], "order_id int, customer_id int, order_date date, status string")
    items = spark.createDataFrame([(1, 9), (2, 5), (3, 4)], "order_id int, quantity int").withColumn(
        "unit_price_at_purchase", F.lit(1).cast("decimal(18,2)")
    )
    customers = spark.createDataFrame([(2, "a", "b"), (3, "c", "d")], "customer_id int, first_name string, last_name string")
    got = R.lifetime_value(customers, orders, items, 2).orderBy("value_rank").collect()
    assert [(r.customer_id, r.value_rank) for r in got] == [(2, 1), (3, 2)]


def test_numbers_in_text(spark):
    texts = {"12": 12.0, " -1.5e2\t": -150.0, ".5": 0.5, "5.": 5.0, "12d": None, "1f": None, "NaN": None, "Infinity": None, "": None, None: None, "1 2": None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.n for r in df.select("t", try_number(F.col("t")).alias("n")).collect()} == texts
    whole = {"0.0": 0, "0": 0, "2.9": 2, "yes": 1, "": 1, None: 1, "1e12": 1}
    df = spark.createDataFrame([(t,) for t in whole], "t string")
    assert {r.t: r.n for r in df.select("t", whole_or(F.col("t"), 1).alias("n")).collect()} == whole


def test_quantities_stay_what_they_are(spark):
    raw = spark.createDataFrame(
        [("a", "o", "p", q, "") for q in ("0.5", "1e12", "3", "0", "-1", "12d", None)],
        "order_item_id string, order_id string, product_id string, quantity string, unit_price_at_purchase string",
    )
    got = C.clean_items(raw, spark.createDataFrame([("o",)], "order_id string"), spark.createDataFrame([("p", 2.0)], "product_id string, unit_price double"))
    assert sorted(r.quantity for r in got.collect()) == [0.5, 3.0, 1e12]


def test_a_key_of_white_space_is_missing(spark):
    df = spark.createDataFrame([("\t",), (" \n",), ("",), (None,), (" x ",)], "k string")
    assert [r.k for r in cleaning.drop_missing_key(df, "k").collect()] == [" x "]


def test_the_label_follows_the_unrounded_mean(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [("c", 1, 5, at, 0.1)] * 299 + [("c", 1, 5, at, 0.1001)]
    silver = spark.createDataFrame(rows, "call_id string, customer_id int, duration_sec int, event_ts timestamp_ntz, sentiment_score double")
    got = P.call_level(silver).first()
    assert got.call_sentiment_score == 0.1 and got.call_label == "positive"


def test_calls_after_the_stated_moment_do_not_count(spark):
    rows = [(str(i), 1, dt.datetime(2024, 1, d), "negative", -0.5) for i, d in enumerate((2, 4, 5, 9, 10, 20, 21, 22))]
    calls = spark.createDataFrame(rows, "call_id string, customer_id int, event_ts timestamp_ntz, call_label string, call_sentiment_score double")
    customers = spark.createDataFrame([(1, "Pune", "Basic", 30)], "customer_id int, city string, subscription_type string, age int")
    at = F.lit("2024-01-10").cast("timestamp_ntz")
    assert P.high_risk_customers(calls, customers, as_of=at).first().negative_call_count_7d == 4
    assert P.high_risk_customers(calls, customers).first().negative_call_count_7d == 3


@pytest.mark.parametrize("join", [lambda a, b: joins.one_to_many_left(a, b, "k"), lambda a, b: joins.orphans(a, "k", b), lambda a, b: joins.full_outer(a, b, "k")])
def test_anti_joins_meet_one_row_per_key(spark, plan_of, join):
    """Below the exchange of an anti join's right side the keys are already combined."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one, many = spark.range(50).select(F.col("id").alias("k")), spark.range(1000).select((F.col("id") % 3).alias("k"))
        tree = plan_of(join(one, many), "simple").split("\n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for i, line in enumerate(tree):
        if "LeftAnti" in line:
            assert sum("HashAggregate" in x for x in tree[i:]) >= 2


def test_checks_share_one_scan(spark, sf, plan_of):
    rows = A.table(spark, sf, "lineitem")
    checks = [Q.not_null("l_orderkey"), Q.Check("q", F.col("l_quantity") < 50), Q.Check("d", F.col("l_discount") >= 0)]
    assert plan_of(Q.validate(rows, checks), "simple").count("FileScan") == 1


def test_copies_are_made_in_one_pass(spark, sf, plan_of):
    assert plan_of(A.sales_sample(spark, sf), "simple").count("FileScan") == 3
    assert plan_of(A.calls(spark, sf), "simple").count("FileScan") == 1


def test_the_call_job_keeps_raw_rows_with_their_origin(spark, sf, tmp_path):
    tables = jobs.calls_job(A.calls(spark, sf), A.customer_changes(spark, sf), str(tmp_path))
    assert tables["bronze_calls"].count() == A.calls(spark, sf).count()
    assert tables["bronze_changes"].filter("ingestion_timestamp IS NULL").count() == 0
    assert tables["bronze_warnings"].filter("failed > 0").count() >= 3


def test_exported_reports_are_sorted(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 2.0)], "category string, revenue double").repartition(3)
    path = export_reports({"r": df}, str(tmp_path), {"r": ["-revenue"]})["r"]
    assert [r[0] for r in spark.read.option("header", True).csv(path).collect()] == ["b", "c", "a"]
