"""What the plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.plans import retail as R
from tidemark.registry import files as RF
from tidemark.sources import adapters as A
from tidemark.sources import files as S
from tidemark.sinks import files as K

LAZY = [
    "rpt_1_revenue_by_category", "rpt_2_monthly_trend", "rpt_4_top_products_per_category", "rpt_7_cohort_retention",
    "rpt_8_lifetime_value", "rpt_11_new_vs_returning_revenue", "str_7_silver_calls", "kpi_1_sentiment_daily",
    "kpi_3_high_risk_customers", "cln_18_clean_customers", "cdc_2_scd2_history",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_rows_and_no_cartesian(spark, sf, plan_of, name):
    text = plan_of(entry.queries()[name](spark, sf))
    assert "EvalPython" not in text and "CartesianProduct" not in text


def test_filters_and_columns_reach_the_scan(spark, sf, plan_of):
    text = plan_of(entry.queries()["flt_6_half_open_year"](spark, sf))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    text = plan_of(entry.queries()["rpt_2_monthly_trend"](spark, sf))
    assert "l_discount" not in text and "o_orderpriority" not in text


def test_partition_filter_skips_folders(spark, sf, tmp_path, plan_of):
    K.write_partitioned(A.employees(spark, sf), str(tmp_path / "e"), ["department"])
    text = plan_of(S.read_parquet(spark, str(tmp_path / "e"), F.col("department") == "MACHINERY"))
    assert "PartitionFilters: [isnotnull(department" in text


def test_top_lists_do_not_sort_everything(spark, sf, plan_of):
    assert "TakeOrderedAndProject" in plan_of(entry.queries()["rpt_23_highest_value_orders"](spark, sf))
    assert "WindowGroupLimit" in plan_of(entry.queries()["rpt_4_top_products_per_category"](spark, sf))


def test_sales_joins_only_what_is_asked_for(spark, sf, plan_of):
    assert "Join" not in plan_of(A.sales(spark, sf))
    assert "part.parquet" not in plan_of(A.sales(spark, sf, ("order",)))


def test_reports_agree_with_each_other(spark, sf):
    orders, items, products = A.orders(spark, sf), A.order_items(spark, sf), A.products(spark, sf)
    customers = A.customers(spark, sf, with_place=False)

    def total(df, column):
        return round(df.agg(F.sum(F.col(column).cast("decimal(18,2)"))).first()[0], 2)

    segments = R.rfm_segments(orders, items).cache()
    months = R.monthly_trend(orders, items)
    assert total(months, "revenue") == total(R.revenue_by_category(orders, items, products), "revenue")
    assert total(months, "revenue") == total(segments, "monetary")
    assert total(months, "revenue") == total(R.new_vs_returning_revenue(orders, items), "revenue")
    assert total(months, "revenue") == R.cumulative_revenue(orders, items).agg(F.max("cumulative_revenue").cast("decimal(18,2)")).first()[0]
    assert segments.count() == R.segment_summary(segments).agg(F.sum("customers")).first()[0]
    cohorts = R.cohort_retention(customers, orders)
    assert cohorts.filter("retention_pct > 100 or active_customers > cohort_customers or month_number < 0").count() == 0
    first = months.orderBy("order_month").first()
    assert first["prev_month_revenue"] is None and first["mom_growth_pct"] is None


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    from tidemark import session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())


def test_landing_files_lie_in_the_shared_folder(spark, sf):
    from tidemark.session import shared_dir

    assert RF.employee_csv(spark, sf).startswith(shared_dir(spark).rstrip("/"))


def test_intermediates_can_be_deleted(spark):
    from tidemark.session import freeze, release

    stored = freeze(spark.range(5))
    assert stored.count() == 5
    path = stored.inputFiles()[0].removeprefix("file://")
    import os

    assert os.path.exists(path) and release(spark) >= 1 and not os.path.exists(path)


def test_tables_in_buckets_join_without_a_shuffle(spark, sf, plan_of):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders, items = RF.bucketed_shop(spark, sf, buckets=4)
        text = plan_of(orders.join(items, "order_id").select("status", "quantity"))
        assert "SortMergeJoin" in text and "Exchange" not in text
        # in the report only the products, and the totals by category, are shuffled
        kept = items.join(R.earning(orders).select("order_id"), "order_id")
        assert "Exchange" not in plan_of(kept)
        assert plan_of(kept.groupBy("order_id").count()).count("Exchange") == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_reloading_a_partition_leaves_the_others(spark, tmp_path):
    rows = spark.range(30).select("id", (F.col("id") % 3).alias("p"))
    K.write_partitioned(rows, str(tmp_path / "t"), ["p"])
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").glob("p=*/*.parquet")}
    K.reload_partitions(spark.createDataFrame([(100, 1)], "id long, p long"), str(tmp_path / "t"), ["p"])
    now = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").glob("p=*/*.parquet")}
    assert {f for f in before if "p=1" not in str(f)} == {f for f in now if before.get(f) == now[f]}
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [*(i for i in range(30) if i % 3 != 1), 100]
