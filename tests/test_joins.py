"""Skew-safe outer joins and point-in-time joins against the plain forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins, ordering


def tables(spark):
    r = random.Random(4)
    one = spark.createDataFrame([(i, f"n{i}") for i in range(20)] + [(None, "none")], "k int, name string")
    many = spark.createDataFrame(
        [(3 if r.random() < 0.4 else r.choice([None, *range(5, 30)]), i) for i in range(200)], "k int, v int"
    )
    return one, many


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.mark.parametrize("how, ours", [("left", joins.one_to_many_left), ("full", joins.full_outer)])
def test_outer_joins(spark, how, ours):
    one, many = tables(spark)
    assert rows(ours(one, many, "k"), "k", "name", "v") == rows(one.join(many, "k", how), "k", "name", "v")


def test_known_and_orphans_split_the_rows(spark):
    one, many = tables(spark)
    known, lost = joins.known_only(many, "k", one), joins.orphans(many, "k", one)
    assert rows(known.unionByName(lost), "k", "v") == rows(many, "k", "v")
    assert lost.filter(F.col("k").between(0, 19)).count() == 0


@pytest.mark.parametrize("hot", [10**6, 1, 0])
def test_point_in_time(spark, hot, monkeypatch):
    monkeypatch.setattr(ordering, "HOT", hot)
    day = dt.datetime(2024, 1, 1)
    versions, r = [], random.Random(9)
    for k in range(6):
        at = day + dt.timedelta(hours=r.randint(0, 40))
        for i in range(15):
            end = at + dt.timedelta(hours=r.randint(1, 30))
            versions.append((k, f"{k}-{i}", at, end if i < 14 else None))
            at = end + dt.timedelta(hours=r.choice([0, 0, 5]))
    facts = [(i, r.choice([None, 0, 0, 0, 1, 2, 3, 4, 5, 6]), day + dt.timedelta(hours=r.randint(0, 400))) for i in range(500)]
    facts += [(900 + i, v[0], v[2]) for i, v in enumerate(versions)] + [(2000, 1, None)]
    f = spark.createDataFrame(facts, "id int, k int, t timestamp_ntz")
    v = spark.createDataFrame(versions, "k int, name string, __start_at timestamp_ntz, __end_at timestamp_ntz")
    got = {r["id"]: r["name"] for r in joins.point_in_time(f, v, "k", "t").collect()}
    want = {
        i: next((n for vk, n, s, e in versions if vk == k and t is not None and s <= t and (e is None or t < e)), None)
        for i, k, t in facts
    }
    assert got == want
