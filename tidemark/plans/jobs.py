"""Whole jobs: tables in, tables written below one folder, in a fixed order.

What several results need is written once and read back, so no step is computed twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators.history import current
from tidemark.operators.joins import looked_up
from tidemark.operators.quality import warn
from tidemark.plans import calls as P
from tidemark.plans import clean_retail as C
from tidemark.plans import retail as R
from tidemark.plans import workforce as W
from tidemark.sinks.files import export_reports, snapshot, write_partitioned, write_single_csv
from tidemark.sources.files import read_parquet

ORIGIN = ("source_file", "ingestion_timestamp")


def told_origin(rows: DataFrame) -> DataFrame:
    """Rows with both lineage columns: from their files, else the time alone."""
    if set(ORIGIN) <= set(rows.columns):
        return rows
    return rows.withColumns({"source_file": F.lit(None).cast("string"), "ingestion_timestamp": F.current_timestamp()})


def calls_job(calls: DataFrame, changes: DataFrame, out: str) -> dict[str, DataFrame]:
    """Raw calls and customer changes to stored raw tables, scored segments, history, rejects and the KPI tables.

    The raw tables keep every row, with the file it came from and when it was read where the source has files, and the
    number of rows that break each expectation, counted while they are written.
    """
    told = {"bronze_calls": (calls, P.bronze_call_rules()), "bronze_changes": (changes, P.bronze_change_rules())}
    tables, counts = {}, []
    for name, (rows, rules) in told.items():
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        tables[name] = snapshot(warn(told_origin(rows), rules, seen), f"{out}/{name}")
        counts += [(name, rule, n) for rule, n in seen.get.items()]
    warnings = calls.sparkSession.createDataFrame(counts, "table_name string, rule string, failed long")
    tables["bronze_warnings"] = snapshot(warnings, f"{out}/bronze_warnings")
    calls, changes = (tables[name].drop(*ORIGIN) for name in told)
    valid, rejects = P.split_changes(changes)
    tables |= {
        "silver_calls": snapshot(P.silver_calls(calls), f"{out}/silver_calls"),
        "customer_rejects": snapshot(rejects, f"{out}/customer_rejects"),
        "customer_history": snapshot(P.customer_history(valid), f"{out}/customer_history"),
    }
    customers = current(tables["customer_history"])
    level = snapshot(P.call_level(tables["silver_calls"]), f"{out}/call_level")
    enriched = P.with_current_customer(level, customers)
    kpis = {
        "sentiment_daily": P.sentiment_daily(level),
        "call_volume_daily": P.call_volume_daily(tables["silver_calls"]),
        "high_risk_customers": P.high_risk_customers(level, customers),
        "region_sentiment": P.region_sentiment(enriched),
        "subscription_sentiment": P.subscription_sentiment(enriched),
    }
    for name, df in kpis.items():
        tables[name] = snapshot(df, f"{out}/{name}")
    return tables


def load_retail(raw: C.Retail, out: str) -> C.Retail:
    """Clean tables, each stored before the next one looks its keys up."""
    customers = snapshot(C.clean_customers(raw.customers), f"{out}/customers")
    products = snapshot(C.clean_products(raw.products), f"{out}/products")
    orders = snapshot(C.clean_orders(raw.orders, customers), f"{out}/orders")
    items = snapshot(C.clean_items(raw.items, looked_up(orders), looked_up(products)), f"{out}/items")
    return C.Retail(customers, products, orders, items)


def retail_job(raw: C.Retail, out: str) -> dict[str, str]:
    """Dirty extracts to clean tables, an integrity check that must pass, and the exported reports."""
    loaded = load_retail(raw, out)
    C.assert_clean(loaded)
    snapshot(C.cleaning_log(raw, loaded), f"{out}/cleaning_log")
    # exact sums: prices have cents, quantities three places at most in the reports
    priced = loaded.items.withColumns({
        "unit_price_at_purchase": F.col("unit_price_at_purchase").cast("decimal(18,2)"),
        "quantity": F.col("quantity").try_cast("decimal(18,3)"),
    })
    tables = {"customers": loaded.customers, "products": loaded.products, "orders": loaded.orders, "items": priced}
    tables = R.stored_values(tables)
    return export_reports({name: report(tables) for name, report in R.REPORTS.items()}, f"{out}/reports", R.REPORT_ORDER)


def workforce_job(employees: DataFrame, as_of: str, out: str) -> DataFrame:
    """Enriched staff by department folder, a department summary as CSV, and one department read back."""
    staff = W.enrich(W.paid_active(employees), as_of)
    write_partitioned(staff, f"{out}/employees", ["department"])
    stored = read_parquet(employees.sparkSession, f"{out}/employees")
    write_single_csv(W.department_stats(stored).orderBy(F.col("avg_salary").desc(), "department"), f"{out}/summary")
    return stored
