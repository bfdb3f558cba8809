"""Joins that stay whole and spread out when one key holds a large share of the rows.

No side is forced to be broadcast: Spark does so below its own size limit and otherwise shuffles, splitting
oversized partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import RANGE, cell_of, hot_keys, in_key_ranges
from tidemark.session import freeze


#: Rows of one task where a step holds all of its rows, as a sort or a count of distinct keys does.
TASK_ROWS = 500_000

#: Rows of one task that a join may hold in a hash table, and rows up to which Spark may prefer to broadcast them.
HASHED, BROADCAST = 5_000_000, 2_000_000


def tasks_for(df: DataFrame, least: int, most_rows: int | None = None) -> int:
    """Tasks that df has to be dealt to so that each gets about TASK_ROWS rows; at least `least`. The rows are counted."""
    return max(least, -(-df.count() // (most_rows or TASK_ROWS)))


def spread(df: DataFrame, key: str, always: bool = False) -> DataFrame:
    """df dealt by a key of few rows each, such as an order's id, to as many tasks as its size asks for.

    A fixed number of shuffle partitions lets the memory of a task grow with the table. Where that number is enough, df stays as it
    is, and a join on it can be split at run time; or, with always, is dealt to it.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = tasks_for(df, least)
    if n > least:
        return df.repartition(n, key)
    return df.repartition(key) if always else df


def looked_up(df: DataFrame) -> DataFrame:
    """A table that is cheap to count, with one row per key, as a hash table in every task of a join on the key: the other side needs no sort.

    A hash table stays in memory, so this is left to Spark, which sorts both sides, where a task would get more than HASHED
    rows; and for tables that it may broadcast. The other side can still be split at run time. The rows are counted.
    """
    n, tasks = df.count(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.hint("shuffle_hash") if BROADCAST < n <= tasks * HASHED else df


def known_only(df: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Rows whose key exists in the parent table."""
    keys = parent.select(F.col(parent_key or key).alias(key))
    return df.join(keys, key, "left_semi")


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Rows whose key is NULL or missing in the parent table.

    Spark splits only the left side of such a join, so the parent's keys are reduced to one row each before. They are
    wrapped after that: joined as they are, they would share the aggregate's shuffle and the left side stayed whole.
    """
    name = parent_key or key
    keys = parent.select(F.col(name).alias("_key")).filter("_key IS NOT NULL").distinct().select(F.struct("_key").alias("_cell"))
    return df.join(keys, F.struct(F.col(key).alias("_key")) == F.col("_cell"), "left_anti")


def one_to_many_left(one: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """one LEFT JOIN many, built so that a key with very many rows on the right can be split.

    Spark cannot split the right side of a left join, so matched rows come from an inner join and the
    unmatched rows are added with NULLs. These are found against one row per key.
    """
    matched = one.join(many, key)
    alone = orphans(one, key, many)
    return matched.unionByName(alone, allowMissingColumns=True)


def full_outer(one: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """FULL OUTER JOIN as matched rows plus the unmatched rows of either side, for the same reason."""
    stray = orphans(many, key, one)
    return one_to_many_left(one, many, key).unionByName(stray, allowMissingColumns=True)


def point_in_time(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    start: str = "__start_at",
    end: str = "__end_at",
) -> DataFrame:
    """Left join to the version valid at the fact's time: start <= at < end, open end = still valid.

    Versions of one key do not overlap, so a fact matches once at most. Facts and version starts of a key are put in one order
    of time, in which a fact sees the last version that started; work does not grow with facts times versions. Keys with
    very many rows are cut into ranges of time, and the version still open at a range's end is handed on, so no key or day
    is left to one task. Facts without key or time match nothing.
    """
    keep = [c for c in versions.columns if c != key]
    placeable = F.col(key).isNotNull() & F.col(at).isNotNull()
    version_type = versions.select(F.struct(*keep).alias("v")).schema["v"].dataType
    fact_type = facts.select(F.struct(*facts.columns).alias("f")).schema["f"].dataType
    fact_rows = facts.filter(placeable).select(
        F.col(key).alias("_key"), F.col(at).alias("_t"), F.lit(1).alias("_kind"), F.struct(*facts.columns).alias("_fact"),
        F.lit(None).cast(version_type).alias("_version"),
    )
    # a version that starts at the very time of a fact comes first
    version_rows = versions.filter(F.col(key).isNotNull() & F.col(start).isNotNull()).select(
        F.col(key).alias("_key"), F.col(start).alias("_t"), F.lit(0).alias("_kind"), F.lit(None).cast(fact_type).alias("_fact"),
        F.struct(*keep).alias("_version"),
    )
    # stored, so that counting its keys does not evaluate it again
    rows = freeze(fact_rows.unionByName(version_rows))
    hot = hot_keys(rows, ["_key"])
    by = ["_key"] if hot is None else ["_key", RANGE]
    if hot is not None:
        rows = in_key_ranges(rows, ["_key"], [F.col("_t"), F.col("_kind")], hot)
    rows = rows.withColumn("_cell", cell_of(by))
    so_far = Window.partitionBy("_cell").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("_now", F.last("_version", ignorenulls=True).over(so_far)).filter(F.col("_kind") == 1)
    if hot is not None:
        earlier = Window.partitionBy("_key").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
        started = F.when(F.col("_kind") == 0, F.col("_t"))
        # a row per key and range
        handed = rows.groupBy(*by).agg(F.max_by("_version", started).alias("_last")).select(
            cell_of(by).alias("_cell"), F.last("_last", ignorenulls=True).over(earlier).alias("_handed")
        )
        found = found.join(handed, "_cell").withColumn("_now", F.coalesce("_now", "_handed"))
    open_ = F.col(f"_now.{end}").isNull() | (F.col("_t") < F.col(f"_now.{end}"))
    matched = found.select("_fact.*", *[F.when(open_, F.col(f"_now.{c}")).alias(c) for c in keep])
    return matched.unionByName(facts.filter(~placeable), allowMissingColumns=True)
