"""A third of all rows on one key: joins are split at run time, results stay whole."""

import contextlib
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins
from tidemark.plans import retail as R
from tidemark.plans import wide_sales as W
from tidemark.registry import QUERIES
from tidemark.registry.files import bucketed_shop
from tidemark.sources import adapters as A


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def small_limits(spark):
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="2KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )


def hot(df, column, value):
    """A third of the rows, spread over all of them, on one value."""
    third = F.xxhash64(*df.columns) < -(2**63) + 2**64 // 3
    return df.withColumn(column, F.when(third, F.lit(value).cast(df.schema[column].dataType)).otherwise(F.col(column)))


def in_files(df, path):
    """Several files, so that several tasks write the shuffle and a partition can be split."""
    df.repartition(6).write.parquet(str(path))
    return df.sparkSession.read.schema(df.schema).parquet(str(path))


def executed(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_busy_product_is_split(spark, sf, tmp_path):
    items = in_files(hot(A.order_items(spark, sf), "product_id", 5), tmp_path / "items")
    tables = (A.orders(spark, sf), items, A.products(spark, sf))
    want = sorted(R.revenue_by_category(*tables).collect())
    with small_limits(spark):
        got, plan = executed(R.revenue_by_category(*tables))
    assert sorted(got) == want
    assert "skew=true" in plan


def test_tasks_grow_with_the_items(spark, sf, monkeypatch, plan_of):
    """A task gets so many rows at most, whatever the number of shuffle partitions."""
    tables = (A.orders(spark, sf), A.order_items(spark, sf), A.products(spark, sf))
    want = sorted(R.revenue_by_category(*tables).collect())
    monkeypatch.setattr(joins, "TASK_ROWS", 500)
    n = -(-tables[1].count() // 500)
    dealt = R.revenue_by_category(*tables)
    assert sorted(dealt.collect()) == want and f"hashpartitioning(order_id, {n})" in re.sub(r"#\d+L?", "", plan_of(dealt, "simple"))
    assert sum(f.startswith("part-") for f in set(re.findall(r"part-\d+", " ".join(bucketed_shop(spark, sf)[1].inputFiles())))) == n
    assert sorted(QUERIES["snk_1_report_on_buckets"](spark, sf).collect()) == want
    monkeypatch.undo()
    assert len(bucketed_shop(spark, sf)[1].inputFiles()) == 8


@pytest.mark.parametrize("how", ["inner part of a left join", "orphans"])
def test_busy_customer_in_row_joins(spark, sf, tmp_path, how):
    orders = in_files(hot(A.orders(spark, sf), "customer_id", 3), tmp_path / "orders")
    customers = A.customers(spark, sf, with_place=False)

    def run():
        if how == "orphans":
            return joins.orphans(orders, "customer_id", customers.filter(F.col("segment") != "MACHINERY"))
        return joins.one_to_many_left(customers.select("customer_id", "segment"), orders, "customer_id")

    want = sorted(map(repr, run().collect()))
    with small_limits(spark):
        got, plan = executed(run())
    assert sorted(map(repr, got)) == want
    assert "skew=true" in plan


def test_busy_customer_is_one_row_after_summing(spark, sf):
    """Totals per customer equal plain SQL although one customer holds a third of the orders."""
    orders = hot(A.orders(spark, sf), "customer_id", 3)
    lines = A.sales(spark, sf)
    got = W.customer_lines(lines, orders).groupBy("customer_id").agg(F.sum("sales").alias("s"))
    plain = lines.join(orders, "order_id").groupBy("customer_id").agg(F.sum("sales").alias("s"))
    assert sorted(got.collect()) == sorted(plain.collect())
