"""KPIs of a stream against those of a whole table, after every batch."""

import random

from test_streaming import NOON

from tidemark.plans import calls as P
from tidemark.schemas import CALLS
from tidemark.streaming import kpis as K

SAID = ["very good and great", "a terrible problem", "it is so", "extremely frustrated", "thanks, very happy"]


def delivered(seed, batches=5, n=60):
    """Calls over some days; calls come again, under other times, customers and durations too."""
    r, out, all_ = random.Random(seed), [], []
    for b in range(batches):
        rows = []
        for i in range(n):
            at = NOON + 86_400 * r.randint(0, 3) + r.randint(0, 20_000) if r.random() > 0.05 else None
            rows.append((f"c{r.randint(0, 150)}" if r.random() > 0.03 else None, r.choice([1, 2, 3, 4, None]), "A", at, r.randint(-2, 90),
                         [("customer", r.choice(SAID), 0.0)] * r.randint(0, 2), None, None))
        rows += r.sample(all_, min(len(all_), 15)) + r.sample(rows, 5)
        all_ += rows
        out.append(rows)
    # of two rows with one call and time the first delivered counts; make them alike but for the delivery
    kept = {}
    return [[kept.setdefault((x[0], x[3]), x) for x in rows] for rows in out]


def same(a, b):
    columns = sorted(b.columns)
    assert sorted(map(str, a.select(columns).collect())) == sorted(map(str, b.select(columns).collect()))


def test_kpis_equal_those_of_all_calls_after_every_batch(spark, tmp_path):
    base, so_far = str(tmp_path), []
    customers = spark.createDataFrame([(1, "Pune", "Basic", 3), (2, "Delhi", "Basic", 4), (3, "Pune", "Premium", 5)],
                                      "customer_id int, city string, subscription_type string, age int")
    for i, rows in enumerate(delivered(3)):
        so_far += rows
        K.apply_calls(spark.createDataFrame(rows, CALLS), i, base, customers)
        silver = P.silver_calls(spark.createDataFrame(so_far, CALLS))
        level = P.call_level(silver)
        enriched = P.with_current_customer(level, customers)
        same(K.read_kpi(spark, base, "sentiment_daily"), P.sentiment_daily(level))
        same(K.read_kpi(spark, base, "call_volume_daily"), P.call_volume_daily(silver))
        same(K.read_kpi(spark, base, "region_sentiment"), P.region_sentiment(enriched))
        same(K.read_kpi(spark, base, "subscription_sentiment"), P.subscription_sentiment(enriched))
    want = sorted(map(str, K.read_kpi(spark, base, "sentiment_daily").collect()))
    K.apply_calls(spark.createDataFrame(rows, CALLS), i, base, customers)
    assert sorted(map(str, K.read_kpi(spark, base, "sentiment_daily").collect())) == want


def test_a_batch_reads_the_days_it_touches_only(spark, tmp_path, plan_of):
    base = str(tmp_path)
    day = lambda d, name: [(name, 1, "A", NOON + 86_400 * d, 5, [("customer", SAID[0], 0.0)], None, None)]
    for i in range(3):
        K.apply_calls(spark.createDataFrame(day(i, f"c{i}"), CALLS), i, base)
    for i in range(2):  # folders of other days can't be read any more, and need not be
        for path in tmp_path.glob(f"s*/batch={i}/date=*/*.parquet"):
            path.write_bytes(b"broken")
    K.apply_calls(spark.createDataFrame(day(2, "d"), CALLS), 3, base)
    assert sorted(r.total_calls for r in K.read_kpi(spark, base, "sentiment_daily").collect()) == [1, 1, 2]


def test_a_batch_without_valid_calls(spark, tmp_path):
    base = str(tmp_path)
    K.apply_calls(spark.createDataFrame([(None, 1, "A", None, 5, None, None, None)], CALLS), 0, base)
    assert K.committed(spark, base) == 0
