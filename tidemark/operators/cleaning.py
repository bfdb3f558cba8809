"""Row repair: deduplication, filling gaps, dropping unusable rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import try_number
from tidemark.functions.text import is_blank
from tidemark.operators.ordering import exact_median


def full_row_dedup(df: DataFrame) -> DataFrame:
    """Drop exact copies; copies are combined inside each task before the shuffle."""
    return df.dropDuplicates()


def dedup_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropDuplicates(list(keys))


def dedup_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = False, copies: str | None = None
) -> DataFrame:
    """Keep the first (or last) row per key in the given order; copies names a column for the rows per key.

    An aggregate rather than a window: a key with a great many copies is reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    counted = [F.count(F.lit(1)).alias(copies)] if copies else []
    kept = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"), *counted)
    names = [F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    return kept.select(*names, *([copies] if copies else []))


def drop_missing_key(df: DataFrame, key: str) -> DataFrame:
    """Drop rows whose key is NULL or white space of any kind."""
    return df.filter(~is_blank(F.col(key).cast("string")))


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(columns) if columns else None)


def fill_values(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Replace NULL by a constant, keeping each column's type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in values.items()})


def fill_medians(df: DataFrame, columns: Mapping[str, bool]) -> DataFrame:
    """Fill gaps of number columns with their exact medians, all found in one pass.

    columns maps a column to whether the result is rounded to whole numbers, half to even.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in columns])
    found = exact_median(df.select(F.inline(pairs)), "v", ["c"], "m")
    # one row with a column per median; NULL where every value is missing
    middle = found.agg(*[F.max(F.when(F.col("c") == c, F.col("m"))).alias(f"_{c}") for c in columns])
    out = df.crossJoin(F.broadcast(middle))
    for c, whole in columns.items():
        filled = F.coalesce(F.col(c).cast("double"), F.col(f"_{c}"))
        out = out.withColumn(c, F.bround(filled).cast("int") if whole else filled)
    return out.drop(*[f"_{c}" for c in columns])


def fill_median(df: DataFrame, column: str, to_whole: bool = False) -> DataFrame:
    return fill_medians(df, {column: to_whole})


def fill_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill gaps of text columns with their most frequent value (the smallest on ties), in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in columns])
    counts = (
        df.select(F.inline(pairs)).filter(F.col("v").isNotNull()).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    )
    order = F.struct(-F.col("n"), F.col("v"))
    top = counts.agg(
        *[F.min_by(F.when(F.col("c") == c, F.col("v")), F.when(F.col("c") == c, order)).alias(f"_{c}") for c in columns]
    )
    out = df.crossJoin(F.broadcast(top))
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in columns}).drop(*[f"_{c}" for c in columns])


def fill_mode(df: DataFrame, column: str) -> DataFrame:
    return fill_modes(df, [column])


def fill_group_median(df: DataFrame, column: str, group: str) -> DataFrame:
    """Fill gaps with the median of the row's group."""
    middle = exact_median(df, column, [group], "_median")
    filled = F.coalesce(F.col(column).cast("double"), F.col("_median"))
    return df.join(middle, group, "left").withColumn(column, filled).drop("_median")


def repair_negative(column: str, places: int = 2) -> Column:
    return F.round(F.abs(F.col(column)), places)


def drop_non_positive(df: DataFrame, column: str) -> DataFrame:
    """Keep rows whose value is a number above zero; text that is no number, as try_number() reads it, is dropped too."""
    number = try_number(F.col(column).cast("string"))
    return df.withColumn(column, number).filter(F.col(column) > 0)
