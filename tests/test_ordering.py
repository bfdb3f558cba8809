"""The range-based ranks, tiles and quantiles against Spark's own windows on awkward data."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import ordering
from tidemark.operators.ordering import exact_median, exact_quantiles, number_by_day, numbered, ranked, with_ntile, with_ntiles, with_rank

SHAPES = {
    "unique": lambda r, i: float(i),
    "few values": lambda r, i: float(r.randint(1, 3)),
    "a third alike": lambda r, i: 7.0 if r.random() < 0.34 else float(r.randint(0, 500)),
    "one value": lambda r, i: 1.0,
    "with gaps": lambda r, i: None if r.random() < 0.2 else float(r.randint(0, 20)),
}


def rows(spark, shape, n=997):
    r = random.Random(5)
    data = [(i, SHAPES[shape](r, i), "hot" if r.random() < 0.4 else f"g{r.randint(0, 9)}") for i in range(n)]
    return spark.createDataFrame(data, "id long, v double, g string").repartition(7)


def collected(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("descending", [False, True])
def test_positions_equal_the_plain_windows(spark, shape, descending):
    df = rows(spark, shape)
    by = F.col("v").desc() if descending else F.col("v").asc()
    plain = (
        df.withColumn("_rn", F.row_number().over(Window.orderBy(by, "id")))
        .withColumn("_rank", F.rank().over(Window.orderBy(by)))
        .withColumn("_dense", F.dense_rank().over(Window.orderBy(by)))
        .withColumn("_total", F.count(F.lit(1)).over(Window.partitionBy()))
    )
    names = ("id", "_rn", "_rank", "_dense", "_total")
    assert collected(ranked(df, "v", ["id"], descending), *names) == collected(plain, *names)


@pytest.mark.parametrize("tiles", [1, 4, 7, 2000])
def test_ntile_equals_the_plain_window(spark, tiles):
    df = rows(spark, "few values")
    plain = df.withColumn("t", F.ntile(tiles).over(Window.orderBy("v", "id")))
    assert collected(with_ntile(df, tiles, "v", ["id"], "t"), "id", "t") == collected(plain, "id", "t")


def test_several_ntiles_at_once(spark):
    df = rows(spark, "with gaps").fillna(0.0).withColumn("w", F.col("id") % 5)
    plain = df
    for name, c in (("a", F.col("v")), ("b", -F.col("w"))):
        plain = plain.withColumn(name, F.ntile(4).over(Window.orderBy(c, "id")))
    got = with_ntiles(df, 4, "id", {"a": F.col("v"), "b": -F.col("w")})
    assert collected(got, "id", "a", "b", "g") == collected(plain, "id", "a", "b", "g")


@pytest.mark.parametrize("group", [[], ["g"]])
def test_numbers_in_a_busy_group(spark, group):
    df = rows(spark, "with gaps")
    plain = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*group).orderBy("v", "id"))).withColumn(
        "_size", F.count(F.lit(1)).over(Window.partitionBy(*group))
    )
    got = numbered(df, [F.col("v"), F.col("id")], group)
    assert collected(got, "id", "_rn", "_size") == collected(plain, "id", "_rn", "_size")


def test_rank_of_text(spark):
    df = rows(spark, "unique")
    plain = df.withColumn("r", F.rank().over(Window.orderBy(F.col("g").desc())))
    assert collected(with_rank(df, "g", ["id"], "r"), "id", "r") == collected(plain, "id", "r")


def test_empty_table(spark):
    df = rows(spark, "unique").filter("id < 0")
    assert ranked(df, "v", ["id"]).count() == 0
    assert exact_median(df, "v").count() == 0


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("group", [[], ["g"]])
def test_quantiles_are_exact(spark, shape, group):
    df = rows(spark, shape, 500)
    at = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    plain = df.groupBy(*group).agg(*[F.percentile("v", F.lit(q)).alias(n) for n, q in at.items()])
    got = {r[0] if group else 0: r[-5:] for r in exact_quantiles(df, "v", at, group).collect()}
    for r in plain.collect():
        assert got[r[0] if group else 0] == pytest.approx(tuple(r[-5:]))


@pytest.mark.parametrize("hot", [10**6, 100])
def test_numbering_by_day(spark, hot, monkeypatch):
    monkeypatch.setattr(ordering, "HOT", hot)
    r = random.Random(3)
    keys = lambda: "hot" if r.random() < 0.5 else r.choice([None, "k1", "k2", "k3"])
    data = [(keys(), r.randint(1, 9), i) for i in range(800)]
    start = F.lit("2024-01-01").cast("date")
    df = spark.createDataFrame(data, "k string, d int, id long").withColumn("day", F.date_add(start, F.col("d")))
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("day", "id")))
    got = number_by_day(df, ["k"], "day", ["id"], "n")
    assert collected(got, "id", "n") == collected(plain, "id", "n")
