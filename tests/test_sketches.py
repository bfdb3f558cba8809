"""Profiles and distinct counts, exact and from sketches."""

import math
import statistics

from pyspark.sql import functions as F

from tidemark.operators import aggregates as agg

ROWS = [(1, "a", 2.5, None), (2, "b", None, None), (2, "a", 7.25, None), (3, None, -1.0, None), (None, "b", 2.5, None)]
SCHEMA = "i int, s string, x double, empty string"


def test_profile_reads_its_table_once(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.schema(SCHEMA).parquet(str(tmp_path / "t"))
    got = {r.column_name: r for r in agg.profile(stored).collect()}
    assert sorted(got) == ["empty", "i", "s", "x"]
    assert (got["i"].n_values, got["i"].n_unique, got["i"].top, got["i"].freq, got["i"].mean) == (4, 3, "2", 2, 2.0)
    assert (got["s"].top, got["s"].freq, got["s"].mean, got["s"].q50) == ("a", 2, None, None)  # a tie goes to the smaller
    assert got["x"].std == round(statistics.stdev([2.5, 7.25, -1.0, 2.5]), 4) and got["x"].q50 == 2.5 and got["x"].top == "2.5"
    assert tuple(got["empty"])[1:] == (0, 0, *[None] * 9)
    # what is left of the plan reads the stored histogram only
    assert str(tmp_path) not in agg.profile(stored)._jdf.queryExecution().executedPlan().toString()


def test_profile_from_sketches(spark):
    df = spark.range(20_000).select(F.col("id").alias("i"), (F.col("id") % 7).cast("string").alias("s"), F.lit(None).cast("int").alias("empty"))
    got = {r.column_name: r for r in agg.approximate_profile(df).collect()}
    assert abs(got["i"].q50 - 10_000) < 200 and abs(got["i"].n_unique - 20_000) < 400 and (got["i"].min, got["i"].max) == (0, 19_999)
    assert (got["s"].n_values, got["s"].n_unique, got["s"].top in set("012345"), got["s"].freq) == (20_000, 7, True, math.ceil(20_000 / 7))
    assert (got["empty"].n_values, got["empty"].top, got["empty"].q25) == (0, None, None)
    text = agg.approximate_profile(df)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") <= 1
    assert {r.n_values for r in agg.approximate_profile(df.limit(0)).collect()} == {0}


def test_stored_sketches_merge(spark, tmp_path):
    days = spark.range(60_000).select((F.col("id") % 6).alias("day"), (F.col("id") % 9_000).alias("user"), F.lit("x").alias("kind"))
    agg.distinct_sketches(days, "user", ["day", "kind"]).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    one = agg.distinct_estimates(stored, ["kind"], "n").first()
    assert one.n_low <= 9_000 <= one.n_high and abs(one.n - 9_000) <= 180
    assert {r.day: abs(r.n - 1_500) <= 30 for r in agg.distinct_estimates(stored, ["day"], "n").collect()} == {d: True for d in range(6)}
    assert stored.agg(F.max(F.length("sketch"))).first()[0] <= 2**16 + 100
