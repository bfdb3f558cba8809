"""Ranks, tiles and exact quantiles over a whole table without a one-task window.

Rows are range-partitioned on the ordering, numbered inside each range, and shifted by offsets that come
from a table with one row per range. That table has at most spark.sql.shuffle.partitions rows, which is
the bound for the broadcast and for the un-partitioned windows below.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import freeze

RANGE = "_range"

#: Rows of a key that one task may put in order. Keys with more are cut into ranges.
HOT = 1_000_000


def hot_keys(df: DataFrame, keys: Sequence[str], most: int | None = None) -> DataFrame | None:
    """The keys that more than `most` rows have, as one column _hot, or None without any.

    Counts are combined before the shuffle and read no other columns. There are fewer such keys than rows / most.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > (HOT if most is None else most))
    # most tables have none, and then nothing is stored
    return None if counts.isEmpty() else freeze(counts.select(cell_of(keys).alias("_hot")))


def in_key_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[Column], hot: DataFrame) -> DataFrame:
    """df, stored, with RANGE: hot keys cut into ranges of their order, all others in a range of their own, -1."""
    rows, key = freeze(df), cell_of(keys)
    ranged = in_ranges(rows.join(hot, key == F.col("_hot"), "left_semi"), [*[F.col(c) for c in keys], *order])
    return rows.join(hot, key == F.col("_hot"), "left_anti").withColumn(RANGE, F.lit(-1)).unionByName(ranged)


def in_ranges(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range-partition on the ordering and remember the range number in the column RANGE.

    Spark samples its input to find the range bounds. A second evaluation may cut elsewhere, so the numbers are stored:
    two reads of the result agree, also after an executor is lost, and what df costs is paid once.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn(RANGE, F.spark_partition_id())
    return freeze(ranged)


def _per_range(rows: DataFrame, group: Sequence[str], weight: Column) -> DataFrame:
    """For every group and range it touches: rows in the group's earlier ranges, and in the whole group.

    A group touches no more ranges than there are, which bounds the windows.
    """
    in_group = Window.partitionBy(*group)
    earlier = in_group.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(*group, RANGE).agg(F.sum(weight).alias("_rows"))
    return parts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).withColumn(
        "_size", F.sum("_rows").over(in_group)
    )


def cell_of(keys: Sequence[str]) -> Column:
    """Several keys as one. Two such values are equal also where a key is NULL in both."""
    return F.struct(*[F.col(c) for c in keys])


def numbered(df: DataFrame, order: Sequence[Column], group: Sequence[str] = (), most: int = 0) -> DataFrame:
    """Add _rn, the row's number in its group's order, and _size, the rows of the group.

    order must be unique inside a group. The rows are numbered by ranges, so a group that fills many is numbered by all of
    their tasks. Groups of at most `most` rows are numbered in one task each, which saves the ranges.
    """
    if group and most:
        hot = hot_keys(df, group, most)
        if hot is None:
            inside = Window.partitionBy(*group)
            return df.withColumn("_rn", F.row_number().over(inside.orderBy(*order)).cast("long")).withColumn("_size", F.count(F.lit(1)).over(inside))
    keys = [*group, RANGE]
    rows = in_ranges(df, [*[F.col(c) for c in group], *order]).withColumn("_cell", cell_of(keys))
    parts = _per_range(rows, group, F.lit(1)).select(cell_of(keys).alias("_cell"), "_before", "_size")
    inside = F.row_number().over(Window.partitionBy("_cell").orderBy(*order))
    return (
        rows.withColumn("_inside", inside)
        .join(parts if group else F.broadcast(parts), "_cell")
        .withColumn("_rn", F.col("_before") + F.col("_inside"))
        .drop("_inside", "_before", "_cell", RANGE)
    )


def _tile(tiles: int) -> Column:
    """NTILE from _rn and _size: the first (size mod tiles) tiles hold one row more."""
    size = F.floor(F.col("_size") / tiles)
    larger = F.col("_size") % tiles
    edge = larger * (size + 1)
    later = larger + F.ceil((F.col("_rn") - edge) / F.greatest(size, F.lit(1)))
    return F.when(F.col("_rn") <= edge, F.ceil(F.col("_rn") / (size + 1))).otherwise(later).cast("int")


def ranked(
    df: DataFrame,
    by: str,
    tie: Sequence[str],
    descending: bool = False,
) -> DataFrame:
    """Add _rn, _rank, _dense and _total of every row in the order (by, tie)."""
    direction = F.col(by).desc() if descending else F.col(by).asc()
    ties = [F.col(c) for c in tie]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = in_ranges(df, [direction, *ties]).repartition(n, RANGE)
    inside = Window.partitionBy(RANGE).orderBy(direction, *ties)
    peers = Window.partitionBy(RANGE).orderBy(direction)
    local = (
        rows.withColumn("_lrn", F.row_number().over(inside))
        .withColumn("_lrank", F.rank().over(peers))
        .withColumn("_ldense", F.dense_rank().over(peers))
    )
    edges = local.groupBy(RANGE).agg(
        F.min(F.struct(F.col("_lrn"), F.col(by).alias("v")))["v"].alias("_first"),
        F.max(F.struct("_lrn", "_lrank", "_ldense", F.col(by).alias("v"))).alias("_end"),
    )
    by_range = Window.orderBy(RANGE)
    so_far = by_range.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        edges.withColumn("_rows", F.coalesce(F.sum("_end._lrn").over(so_far), F.lit(0)))
        .withColumn("_joined", F.coalesce(F.lag("_end.v").over(by_range).eqNullSafe(F.col("_first")), F.lit(False)))
        .withColumn("_joined", F.when(F.lag("_rows").over(by_range).isNull(), False).otherwise(F.col("_joined")))
        .withColumn("_begin", F.min(F.col("_rows") + F.col("_end._lrank")).over(Window.partitionBy("_end.v")))
        .withColumn("_peer_rank", F.when(F.col("_joined"), F.lag("_begin").over(by_range)))
        .withColumn(
            "_values",
            F.coalesce(F.sum("_end._ldense").over(so_far), F.lit(0))
            - F.sum(F.col("_joined").cast("int")).over(by_range.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .withColumn("_total", F.sum("_end._lrn").over(Window.partitionBy()))
        .select(RANGE, "_first", "_rows", "_peer_rank", "_values", "_total")
    )
    continued = F.col("_peer_rank").isNotNull() & F.col(by).eqNullSafe(F.col("_first"))
    return (
        local.join(F.broadcast(offsets), RANGE)
        .withColumn("_rn", F.col("_rows") + F.col("_lrn"))
        .withColumn("_rank", F.when(continued, F.col("_peer_rank")).otherwise(F.col("_rows") + F.col("_lrank")))
        .withColumn("_dense", F.col("_values") + F.col("_ldense"))
        .drop(RANGE, "_lrn", "_lrank", "_ldense", "_first", "_rows", "_peer_rank", "_values")
    )


def with_rank(df: DataFrame, by: str, tie: Sequence[str], name: str, dense: bool = False) -> DataFrame:
    """RANK or DENSE_RANK of by, highest first, over the whole table."""
    source = "_dense" if dense else "_rank"
    out = ranked(df, by, tie, descending=True).withColumn(name, F.col(source).cast("long"))
    return out.drop("_rn", "_rank", "_dense", "_total")


def with_ntile(
    df: DataFrame, tiles: int, by: str, tie: Sequence[str], name: str, descending: bool = False
) -> DataFrame:
    """NTILE(tiles) over the whole table."""
    direction = F.col(by).desc() if descending else F.col(by).asc()
    out = numbered(df, [direction, *[F.col(c) for c in tie]])
    return out.withColumn(name, _tile(tiles)).drop("_rn", "_size")


def with_ntiles(df: DataFrame, tiles: int, key: str, measures: Mapping[str, Column]) -> DataFrame:
    """NTILE(tiles) of several numbers at once, ties split by the unique key.

    measures maps a new column to the number it tiles, in ascending order. The numbers are ranked side by
    side as one long table, so there is one shuffle for all of them.
    """
    rest = [c for c in df.columns if c != key]
    empty = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in rest]
    rows = []
    for i, (name, value) in enumerate(measures.items()):
        # the other columns travel with the first number only
        carried = [F.col(c) for c in rest] if i == 0 else empty
        rows.append(F.struct(F.lit(name).alias("_m"), value.cast("decimal(38,6)").alias("_v"), *carried))
    long = numbered(df.select(key, F.inline(F.array(*rows))), [F.col("_v"), F.col(key)], ["_m"])
    tiled = long.withColumn("_tile", _tile(tiles))
    return tiled.groupBy(key).agg(
        *[F.max(c).alias(c) for c in rest],
        *[F.max(F.when(F.col("_m") == name, F.col("_tile"))).alias(name) for name in measures],
    )


def number_by_day(df: DataFrame, key: Sequence[str], day: str, tie: Sequence[str], name: str) -> DataFrame:
    """ROW_NUMBER per key in the order (day, tie), which must be unique.

    If a key has very many rows, all are numbered by ranges, so neither a busy key nor a busy day of one key ends in one task.
    """
    out = numbered(df, [F.col(day), *[F.col(c) for c in tie]], key, HOT)
    return out.withColumnRenamed("_rn", name).drop("_size")


def exact_quantiles(
    df: DataFrame, value: str, at: dict[str, float], group: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group; NULL values are left out.

    weight, if given, tells how often a row's value stands for.

    Works on the histogram of distinct values, range-partitioned by group and value. Counts per range tell
    which range holds a wanted position, and only the rows of those ranges are put in order.
    """
    present = df.filter(F.col(value).isNotNull())
    hist = present.groupBy(*group, value).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"))
    rows = in_ranges(hist, [*[F.col(c) for c in group], F.col(value)])

    parts = _per_range(rows, group, F.col("_n"))

    def position(q: float) -> Column:
        return (F.col("_size") - 1) * F.lit(float(q))

    def holds(pos: Column, count: str) -> Column:
        return (F.col("_before") <= pos) & (pos < F.col("_before") + F.col(count))

    wanted = F.lit(False)
    for q in at.values():
        wanted = wanted | holds(F.floor(position(q)), "_rows") | holds(F.ceil(position(q)), "_rows")
    keys = [*group, RANGE]
    target = parts.filter(wanted).select(cell_of(keys).alias("_cell"), "_before", "_size")
    inside = Window.partitionBy("_cell").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        rows.withColumn("_cell", cell_of(keys))
        .join(target if group else F.broadcast(target), "_cell")
        .withColumn("_before", F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    )
    number = F.col(value).cast("double")
    picks = []
    for name, q in at.items():
        for end, pos in (("lo", F.floor(position(q))), ("hi", F.ceil(position(q)))):
            picks.append(F.max(F.when(holds(pos, "_n"), number)).alias(f"_{end}_{name}"))
    picked = placed.groupBy(*group, "_size").agg(*picks)
    out = []
    for name, q in at.items():
        low, high, pos = F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), position(q)
        out.append((low + (high - low) * (pos - F.floor(pos))).alias(name))
    return picked.select(*group, *out)


def exact_median(df: DataFrame, value: str, group: Sequence[str] = (), name: str = "median") -> DataFrame:
    return exact_quantiles(df, value, {name: 0.5}, group)
