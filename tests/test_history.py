"""Version history: the worked cases, then random logs against a row-by-row restatement."""

import datetime as dt
import random
import shutil

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ordering
from tidemark.operators.history import as_of, current, scd2
from tidemark.plans.calls import customer_history, split_changes
from tidemark.schemas import CHANGES, HISTORY
from tidemark.streaming import history as store
from tidemark.streaming.history import apply_changes, read_history, work_log

SCHEMA = "k int, city string, plan string, age int, op string, at timestamp_ntz"


def t(text):
    return dt.datetime.fromisoformat(text)


def history(spark, data):
    df = spark.createDataFrame([(*r[:5], t(r[5])) for r in data], SCHEMA)
    return scd2(df, ["k"], "at", ["city", "plan"], F.col("op") == "DELETE", ["op"])


def versions(df):
    return sorted((r["k"], r["__start_at"], r["city"], r["plan"], r["age"], r["__end_at"]) for r in df.collect())


def by_hand(data):
    out = []
    for k in {r[0] for r in data}:
        moments = {}
        for r in data:
            if r[0] == k:
                rank = (r[4] == "DELETE", r[1], r[2], r[3])
                if r[5] not in moments or rank > moments[r[5]]:
                    moments[r[5]] = rank
        open_ = None
        for at in sorted(moments):
            gone, city, plan, age = moments[at]
            if open_ and not gone and (open_[2], open_[3]) == (city, plan):
                open_[4] = age
                continue
            if open_:
                open_[5] = t(at)
                out.append(tuple(open_))
            open_ = None if gone else [k, t(at), city, plan, age, None]
        if open_:
            out.append(tuple(open_))
    return sorted(out, key=lambda v: v[:2])


EXAMPLE = [
    (18, "Delhi", "Premium", 40, "INSERT", "2026-04-01T21:15"),
    (18, "Chennai", "Basic", 40, "UPDATE", "2026-04-05T13:00"),
    (18, "Chennai", "Premium", 41, "UPDATE", "2026-04-06T02:12"),
]


def test_worked_example_in_any_order(spark):
    want = [
        (18, t("2026-04-01T21:15"), "Delhi", "Premium", 40, t("2026-04-05T13:00")),
        (18, t("2026-04-05T13:00"), "Chennai", "Basic", 40, t("2026-04-06T02:12")),
        (18, t("2026-04-06T02:12"), "Chennai", "Premium", 41, None),
    ]
    assert versions(history(spark, EXAMPLE)) == want
    assert versions(history(spark, EXAMPLE[::-1])) == want


def test_delete_leaves_a_gap_and_untracked_changes_update_in_place(spark):
    data = [
        (1, "A", "x", 30, "INSERT", "2024-01-01T10:00"),
        (1, "A", "x", 31, "UPDATE", "2024-01-02T10:00"),
        (1, "A", "x", 31, "DELETE", "2024-01-03T10:00"),
        (1, "A", "x", 33, "INSERT", "2024-01-09T10:00"),
        (2, "B", "x", 20, "DELETE", "2024-01-01T10:00"),
    ]
    got = history(spark, data)
    assert versions(got) == [
        (1, t("2024-01-01T10:00"), "A", "x", 31, t("2024-01-03T10:00")),
        (1, t("2024-01-09T10:00"), "A", "x", 33, None),
    ]
    assert [r["age"] for r in current(got).collect()] == [33]
    inside = as_of(got, F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"))
    assert inside.count() == 0


@pytest.mark.parametrize("seed,hot", [(1, 10**6), (2, 10**6), (2, 50), (3, 5), (4, 0)])
def test_random_logs(spark, seed, hot, monkeypatch):
    """Also with some or all keys cut into ranges."""
    monkeypatch.setattr(ordering, "HOT", hot)
    r = random.Random(seed)
    data = []
    for _ in range(400):
        k = 1 if r.random() < 0.4 else r.randint(2, 12)
        at = dt.datetime(2024, 1, 1) + dt.timedelta(hours=r.randint(0, 24 * 12))
        op = r.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"])
        data.append((k, r.choice("AB"), r.choice("xy"), r.randint(1, 99), op, at.isoformat()))
    got = versions(history(spark, data))
    assert sorted(got, key=lambda v: v[:2]) == by_hand(data)


def changes(spark, data):
    return spark.createDataFrame(data, CHANGES)


def test_repeated_batches_change_nothing(spark, tmp_path):
    base = str(tmp_path)
    first = changes(spark, [("1", "A", "x", "30", "2023-01-01", "INSERT", "2024-01-05 10:00:00"),
                            ("2", "B", "x", "30", "2023-01-01", "INSERT", "2024-01-01 10:00:00")])
    # an earlier change of customer 1 arrives later, with a reject beside it
    second = changes(spark, [("1", "C", "x", "30", "2023-01-01", "INSERT", "2024-01-02 10:00:00"),
                             ("z", "C", "x", "30", "2023-01-01", "INSERT", "2024-01-02 10:00:00")])
    apply_changes(first, 0, base, 4)
    apply_changes(second, 1, base, 4)
    want = read_history(spark, base).collect()
    apply_changes(second, 1, base, 4)
    assert sorted(read_history(spark, base).collect()) == sorted(want)
    assert sorted((r["customer_id"], r["city"], r["__end_at"] is None) for r in want) == [
        (1, "A", True), (1, "C", False), (2, "B", True),
    ]
    assert [r["reject_reason"] for r in spark.read.parquet(f"{base}/rejects").collect()] == ["uncastable_customer_id"]


def test_a_sequence_of_numbers(spark):
    data = [(1, "A", 3), (1, "A", 1), (1, "B", 2), (2, "A", 10), (1, "B", 20), (2, "A", 9)]
    df = spark.createDataFrame(data, "k int, city string, n int")
    got = scd2(df, ["k"], "n", ["city"], F.lit(False))
    assert sorted((r.k, r.city, r["__start_at"], r["__end_at"]) for r in got.collect()) == [
        (1, "A", 1, 2), (1, "A", 3, 20), (1, "B", 2, 3), (1, "B", 20, None), (2, "A", 9, None),
    ]


def test_a_third_of_all_rows_on_one_key_and_day_spread_over_ranges(spark, monkeypatch):
    """And two thousand busy keys beside it: the rows of the hot key reach several ranges."""
    from tidemark.operators.ordering import RANGE, in_key_ranges, in_ranges

    monkeypatch.setattr(ordering, "HOT", 1000)
    data = [(1, "AB"[i // 3 % 2], "x", i, "UPDATE", f"2024-01-01T{i // 3600:02}:{i // 60 % 60:02}:{i % 60:02}") for i in range(4000)]
    data += [(k, "AB"[i % 2], "x", i, "UPDATE", f"2024-01-0{i + 1}T10:00") for k in range(2, 2002) for i in range(4)]
    assert sorted(versions(history(spark, data)), key=lambda v: v[:2]) == by_hand(data)
    rows = in_ranges(spark.createDataFrame([(r[0], r[5]) for r in data], "k int, at string"), [F.col("k"), F.col("at")])
    assert rows.filter("k = 1").select(RANGE).distinct().count() > 1
    log = spark.createDataFrame([(r[0], r[5]) for r in data], "k int, at string")
    cut = in_key_ranges(log, ["k"], [F.col("at")], ordering.hot_keys(log, ["k"]))
    found = {r.hot: (r.n, r.m) for r in cut.groupBy((F.col("k") == 1).alias("hot")).agg(F.count_distinct(RANGE).alias("n"), F.count(F.lit(1)).alias("m")).collect()}
    assert found[True][0] > 1 and found[True][1] == 4000 and found[False] == (1, 8000)


def test_null_keys_and_sequences(spark):
    data = [(None, "A", 1), (None, "B", 2), (1, "A", None), (1, "A", 5), (1, "B", 6)]
    got = scd2(spark.createDataFrame(data, "k int, city string, n int"), ["k"], "n", ["city"], F.lit(False))
    assert {(r.k, r.city, r["__start_at"], r["__end_at"]) for r in got.collect()} >= {
        (None, "A", 1, 2), (None, "B", 2, None), (1, "B", 6, None)
    }


def batches(n, rows, seed, keys=30):
    """Raw batches over a year: most changes in order, some late, some delivered again, and a third on one customer."""
    r, out, at = random.Random(seed), [], dt.datetime(2024, 1, 1)
    for i in range(n):
        batch = []
        for _ in range(rows):
            at += dt.timedelta(hours=r.randint(0, 24 * 300 // (n * rows)) + 1)
            k = 1 if r.random() < 0.33 else r.randint(2, keys)
            op = r.choice(["INSERT", "UPDATE", "UPDATE", "UPDATE", "DELETE"])
            batch.append((str(k), r.choice("AB"), r.choice("xy"), str(r.randint(1, 99)), "2023-01-01", op, at.isoformat(" ")))
        if i % 3 == 2:
            late = dt.datetime(2024, 1, 1) + (at - dt.datetime(2024, 1, 1)) * r.random()
            batch += [(str(r.randint(1, keys)), r.choice("AB"), "x", "7", "2023-01-01", r.choice(["UPDATE", "DELETE"]),
                       (late + dt.timedelta(minutes=m)).isoformat(" ")) for m in range(3)]
            batch += r.sample(out[-1], 5)  # delivered again
            batch += [(*b[:3], "50", *b[4:]) for b in r.sample(out[r.randrange(len(out))], 3)]  # and with another value
        out.append(batch)
    return out


def test_twenty_batches_equal_the_whole_log_and_read_what_they_touch(spark, tmp_path):
    base, log = str(tmp_path), []
    for i, batch in enumerate(batches(20, 25, 4)):
        log += batch
        apply_changes(changes(spark, batch), i, base, buckets=4, compact_rows=40)
        if i % 6 == 5:
            apply_changes(changes(spark, batch), i, base, buckets=4)
            assert sorted(read_history(spark, base).collect(), key=str) == sorted(
                customer_history(split_changes(changes(spark, log))[0]).select(*HISTORY.names).collect(), key=str)
    work = {r.batch: r for r in work_log(spark, base).collect()}
    assert len(work) == 20 and spark.read.parquet(f"{base}/compacted").count() > 4
    in_order = [work[i] for i in range(20) if i % 3 != 2]
    assert all(w.versions_read == w.moments_read == 0 for w in in_order)
    # heads of 30 customers in the bases and in a few deltas, as many at the end as in the middle of the log
    assert max(w.heads_read for w in in_order) < 30 * 6
    assert max(w.moments_read for w in work.values()) < len(log)


def test_a_late_change_reads_months_from_its_version_on(spark, tmp_path):
    base = str(tmp_path)
    for i in range(12):
        batch = [(str(k), "AB"[(i + d) % 2], "x", "30", "2023-01-01", "UPDATE", f"2024-{i + 1:02}-{d + 1:02} 10:00:00") for k in range(4) for d in range(5)]
        apply_changes(changes(spark, batch), i, base, buckets=2, compact_rows=20)
    apply_changes(changes(spark, [("1", "C", "y", "30", "2023-01-01", "UPDATE", "2024-11-02 12:00:00")]), 12, base, buckets=2)
    last = [r for r in work_log(spark, base).collect() if r.batch == 12][0]
    # the two months from the late change on, of the customers in its bucket
    assert 0 < last.moments_read <= 2 * 5 * 4 + 1 and last.versions_read <= 60
    one = read_history(spark, base).where("customer_id = 1 AND city = 'C'").collect()
    assert [(r["__start_at"], r["__end_at"]) for r in one] == [(t("2024-11-02T12:00"), t("2024-11-03T10:00"))]


def test_broken_off_batches_and_compactions_are_not_seen(spark, tmp_path, monkeypatch):
    base, log = str(tmp_path), batches(4, 20, 5)
    for i in range(3):
        apply_changes(changes(spark, log[i]), i, base, buckets=2, compact_rows=10**9)
    want = sorted(read_history(spark, base).collect(), key=str)
    made = store.Store.write

    def fails(self, rows, name, batch_id):
        made(self, rows, name, batch_id)
        if name == "cuts":
            raise RuntimeError("lost")

    monkeypatch.setattr(store.Store, "write", fails)
    with pytest.raises(RuntimeError):
        apply_changes(changes(spark, log[3]), 3, base, buckets=2)
    assert sorted(read_history(spark, base).collect(), key=str) == want
    monkeypatch.undo()
    # a compaction that ends before its mark
    shutil.copytree(f"{base}/delta/versions/batch=0", f"{base}/base/versions/upto=2", dirs_exist_ok=True)
    assert sorted(read_history(spark, base).collect(), key=str) == want
    assert sorted(store.compact(spark, base)) == [0, 1]
    assert sorted(read_history(spark, base).collect(), key=str) == want
    apply_changes(changes(spark, log[3]), 3, base, buckets=2)
    assert sorted(read_history(spark, base).collect(), key=str) == sorted(
        customer_history(split_changes(changes(spark, sum(log, [])))[0]).select(*HISTORY.names).collect(), key=str)
