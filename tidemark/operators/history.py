"""Change logs to version history (slowly changing dimension, type 2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import RANGE, cell_of, hot_keys, in_key_ranges

START, END = "__start_at", "__end_at"


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    seq: str,
    track: Sequence[str],
    delete_when: Column,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Version history of a change log.

    A new version begins when a tracked column changes, at the first row of a key and after a delete.
    Other columns are updated in place. A delete closes the open version. Rows may arrive in any order; of
    several rows with the same key and sequence one counts: a delete first, else the largest values.
    Versions are half open [__start_at, __end_at); an open end is the current version. The sequence may be of
    any type that can be ordered.

    The changes of a key are put in order by one task, unless there are very many. Such keys are cut into ranges of their
    sequence and worked on inside a range. What one range hands to the next about a key is one row: its last state, the start of
    the version still open and the next start. So neither a busy key nor a busy day of one key ends in one task.
    """
    others = [c for c in changes.columns if c not in {*keys, seq, *track, *exclude}]
    marked = changes.withColumn("_gone", F.coalesce(delete_when, F.lit(False)))
    best = F.max(F.struct("_gone", *track, *others)).alias("_best")
    once = marked.groupBy(*keys, seq).agg(best).select(*keys, seq, "_best.*")

    hot = hot_keys(changes, keys)
    cut = hot is not None
    rows = in_key_ranges(once, keys, [F.col(seq)], hot) if cut else once
    by = [*keys, RANGE] if cut else [*keys]
    rows = rows.withColumn("_cell", cell_of(by))
    inside = Window.partitionBy("_cell").orderBy(seq)
    ranges = Window.partitionBy(*keys).orderBy(RANGE)

    opened = rows.withColumn("_prev", F.lag(F.struct("_gone", *track)).over(inside))
    if cut:
        # a row per key and range
        last = rows.groupBy(*by).agg(F.max(F.struct(F.col(seq).alias("_at"), "_gone", *track)).alias("_state"))
        handed = last.select(cell_of(by).alias("_cell"), F.lag("_state").over(ranges).alias("_handed"))
        names = ("_gone", *track)
        before = F.when(F.col("_handed").isNotNull(), F.struct(*[F.col(f"_handed.{c}").alias(c) for c in names]))
        opened = (
            opened.withColumn("_first", F.row_number().over(inside) == 1)
            .join(handed, "_cell")
            .withColumn("_prev", F.when(F.col("_first"), before).otherwise(F.col("_prev")))
            .drop("_handed", "_first")
        )
    opened = opened.withColumn("_opened", F.when(_is_new(F.col("_prev"), track), F.col(seq))).drop("_prev")
    up_to_here = inside.rowsBetween(Window.unboundedPreceding, 0)
    if cut:
        ahead = inside.rowsBetween(1, Window.unboundedFollowing)
        bounds = opened.groupBy(*by).agg(F.min("_opened").alias("_first"), F.max("_opened").alias("_last"))
        across = bounds.select(
            cell_of(by).alias("_cell"),
            F.max("_last").over(ranges.rowsBetween(Window.unboundedPreceding, -1)).alias("_open_start"),
            F.min("_first").over(ranges.rowsBetween(1, Window.unboundedFollowing)).alias("_next_start"),
        )
        placed = (
            opened.withColumn(START, F.max("_opened").over(up_to_here))
            .withColumn(END, F.min("_opened").over(ahead))
            .join(across, "_cell")
            .withColumn(START, F.coalesce(START, "_open_start"))
            .withColumn(END, F.coalesce(END, "_next_start"))
        )
        final = placed.groupBy(*keys, START, END).agg(
            F.max(F.struct(F.col(seq).alias("_at"), "_gone", *track, *others)).alias("_v")
        )
    else:
        # all in the partitions of the window: versions are gathered by their start, and the next start is their end
        placed = opened.withColumn(START, F.max("_opened").over(up_to_here))
        final = placed.groupBy("_cell", *keys, START).agg(
            F.max(F.struct(F.col(seq).alias("_at"), "_gone", *track, *others)).alias("_v")
        ).withColumn(END, F.lead(START).over(Window.partitionBy("_cell").orderBy(START)))
    return final.filter(~F.col("_v._gone")).select(*keys, *[F.col(f"_v.{c}") for c in (*track, *others)], START, END)


def _is_new(prev: Column, track: Sequence[str]) -> Column:
    """Whether a row begins a version (or is a delete), given the state of the row before it."""
    same = F.lit(True)
    for c in track:
        same = same & F.col(c).eqNullSafe(prev[c])
    return prev.isNull() | prev["_gone"] | F.col("_gone") | ~same


def current(history: DataFrame) -> DataFrame:
    return history.filter(F.col(END).isNull())


def as_of(history: DataFrame, moment: Column) -> DataFrame:
    """The versions valid at a moment."""
    return history.filter((F.col(START) <= moment) & (F.col(END).isNull() | (moment < F.col(END))))
