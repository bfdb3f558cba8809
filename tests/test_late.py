"""Late rows as a table, and state that ends with the watermark."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_streaming import NOON, call, put

from tidemark.streaming import late as L


def names(spark, path):
    return sorted(r.call_id for r in spark.read.parquet(path).select("call_id").collect())


def test_late_rows_are_told_apart_and_state_ends(spark, tmp_path):
    landing, base = tmp_path / "in", str(tmp_path / "out")
    put(landing, "1.json", [call("a", NOON), call("a", NOON), call("b", NOON - 7200), call("none", None)])
    assert L.follow_calls(spark, str(landing), base) == 1  # b's key has left the state already
    put(landing, "2.json", [call("c", NOON + 3600), call("a", NOON), call("edge", NOON - 1800), call("in", NOON - 1799)])
    assert L.follow_calls(spark, str(landing), base) == 1
    put(landing, "3.json", [call("late", NOON + 1800), call("c", NOON + 3600), call("d", NOON + 3601), call("e", NOON + 1801)])
    assert L.follow_calls(spark, str(landing), base) == 3
    assert names(spark, f"{base}/kept") == ["a", "b", "c", "d", "e", "in"]
    assert names(spark, f"{base}/late") == ["edge", "late"]
    first = spark.read.parquet(f"{base}/late").where("call_id = 'edge'").first()
    assert first.watermark == first.event_ts == dt.datetime(2023, 11, 14, 22, 13, 20) - dt.timedelta(minutes=30)


def test_no_row_is_lost_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    base = str(tmp_path)
    schema = "k int, at timestamp_ntz"
    day = dt.datetime(2024, 1, 1)
    batches = [[(i, day + dt.timedelta(minutes=(i * 7919) % 600 + 90 * b)) for i in range(b * 100, b * 100 + 100)] for b in range(4)]
    for b, rows in enumerate(batches):
        L.route(spark.createDataFrame(rows, schema), b, base, "at")
    def tables():
        return {t: sorted(map(tuple, spark.read.parquet(f"{base}/{t}").select("k", "at").collect())) for t in ("accepted", "late")}

    want = tables()
    newest = None
    for b, rows in enumerate(batches):
        for r in rows:
            assert r in want["late" if newest and r[1] <= newest - dt.timedelta(minutes=30) else "accepted"]
        newest = max([*(r[1] for r in rows), *([newest] if newest else [])])
    assert want["late"] and sum(map(len, want.values())) == 400
    L.route(spark.createDataFrame(batches[2], schema), 2, base, "at")
    assert tables() == want


def test_empty_batches_and_keys_without_time(spark, tmp_path):
    base = str(tmp_path)
    L.route(spark.createDataFrame([], "k int, at timestamp_ntz"), 0, base, "at")
    L.route(spark.createDataFrame([(1, None)], "k int, at timestamp_ntz"), 1, base, "at")
    assert spark.read.schema("k int, at timestamp_ntz").parquet(f"{base}/accepted").where(F.col("k").isNotNull()).count() == 0
    with pytest.raises(ValueError):
        L.keep_first(spark, spark.range(0).schema, base, ["id"], "at")
