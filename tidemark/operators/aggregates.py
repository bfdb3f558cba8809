"""Grouped totals, best-of lists, shares, modes and column profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordering import exact_quantiles
from tidemark.session import freeze


def total_by(df: DataFrame, by: Sequence[str], totals: Mapping[str, str]) -> DataFrame:
    """Sum columns per group: totals maps the result name to the summed column."""
    return df.groupBy(*by).agg(*[F.sum(column).alias(name) for name, column in totals.items()])


def total_by_attribute(
    facts: DataFrame, key: str, dimension: DataFrame, by: Sequence[str], totals: Mapping[str, str]
) -> DataFrame:
    """Sum facts per attribute of a dimension.

    The facts are summed per key before the join, so a key with many facts meets the dimension as one row.
    """
    per_key = total_by(facts.filter(F.col(key).isNotNull()), [key], totals)
    return total_by(per_key.join(dimension.select(key, *by), key), by, {n: n for n in totals})


def above_average(df: DataFrame, value: str) -> DataFrame:
    """Rows whose value is strictly above the mean, compared without rounding."""
    mean = df.agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    return df.crossJoin(F.broadcast(mean)).filter(F.col(value) * F.col("_n") > F.col("_sum")).drop("_sum", "_n")


def rows_with_group_max(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows that hold their group's maximum; ties return every such row.

    The join uses key and value together, so the rows of one busy group spread over many tasks.
    """
    best = df.groupBy(key).agg(F.max(value).alias(value))
    return df.join(best, [key, value], "left_semi")


def top_k(df: DataFrame, value: str, k: int, tie: Sequence[str], ascending: bool = False) -> DataFrame:
    first = F.col(value).asc() if ascending else F.col(value).desc()
    return df.orderBy(first, *[F.col(c) for c in tie]).limit(k)


def mode_of(df: DataFrame, value: str, name: str = "mode") -> DataFrame:
    """The most frequent value, the smallest one on ties; NULL is not counted."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    return top_k(counts, "_n", 1, [value]).select(F.col(value).alias(name))


def tier(value: Column, edges: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """CASE of conditions checked in order; NULL input falls to the last label."""
    chosen = None
    for condition, label in edges:
        chosen = F.when(condition, label) if chosen is None else chosen.when(condition, label)
    return chosen.otherwise(otherwise)


def multi_stats(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.min(value).alias(f"min_{value}"),
        F.max(value).alias(f"max_{value}"),
        (F.sum(value).cast("double") / F.count(value)).alias(f"mean_{value}"),
    )


def exact_mean(column: str, digits: int) -> Column:
    """Mean of numbers with at most digits decimals, summed exactly so that the order of summing does not matter."""
    return F.sum(F.col(column).cast(f"decimal(30,{digits})")).cast("double") / F.count(column)


STATISTICS = {
    "rows": lambda column, digits: F.count(F.lit(1)),
    "least": lambda column, digits: F.min(column),
    "most": lambda column, digits: F.max(column),
    "mean": lambda column, digits: F.round(F.avg(column), digits),
    "exact mean": lambda column, digits: F.round(exact_mean(column, digits), digits),
}


def grouped_stats(df: DataFrame, by: str, wanted: Mapping[str, tuple]) -> DataFrame:
    """One row per group; wanted maps a result to its statistic and, where it takes them, a column and decimals."""
    measures = []
    for name, (statistic, *arguments) in wanted.items():
        column, digits = (*arguments, None, None)[:2]
        measures.append(STATISTICS[statistic](column, digits).alias(name))
    return df.groupBy(by).agg(*measures)


def distinct_sketches(df: DataFrame, value: str, by: Sequence[str], precision: int = 16) -> DataFrame:
    """A sketch of the distinct values of each group, to be stored and merged later: by and sketch.

    A sketch takes at most 2^precision bytes however many values there are; NULL counts as none.
    """
    return df.groupBy(*by).agg(F.hll_sketch_agg(value, F.lit(precision)).alias("sketch"))


def distinct_estimates(sketches: DataFrame, by: Sequence[str], name: str, precision: int = 16) -> DataFrame:
    """Distinct values of coarser groups from stored sketches, with the interval that holds the truth in 99.7 % of cases.

    The standard error of a sketch is 1.04 / sqrt(2^precision): 0.4 % for 16.
    """
    merged = sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
    off = 3 * 1.04 / 2 ** (precision / 2)
    return merged.withColumns({
        f"{name}_low": F.floor(F.col(name) * (1 - off)).cast("long"), f"{name}_high": F.ceil(F.col(name) * (1 + off)).cast("long"),
    })


def _numeric(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def profile(df: DataFrame) -> DataFrame:
    """One row per column: count, distinct values, most frequent value, spread and exact quartiles.

    The table is read once, whatever its columns: every row becomes one pair of column and value each, and those are counted as
    one histogram, combined before the shuffle. All else is taken from the histogram, which is stored. Numbers also get
    mean, sample deviation and quartiles.
    """
    nothing = F.lit(None).cast("decimal(38,6)")
    pairs = F.array(*[
        F.struct(
            F.lit(f.name).alias("c"), F.col(f.name).cast("string").alias("v"),
            (F.col(f.name).cast("double") if _numeric(f.dataType) else F.lit(None).cast("double")).alias("x"),
            (F.col(f.name).cast("decimal(38,6)") if _numeric(f.dataType) else nothing).alias("d"),
        ) for f in df.schema.fields
    ])
    hist = freeze(df.select(F.inline(pairs)).where("v IS NOT NULL").groupBy("c", "v", "x", "d").agg(F.count(F.lit(1)).alias("n")))
    # the most frequent value, smallest on ties, without sorting the histogram
    base = hist.groupBy("c").agg(
        F.sum("n").alias("n_values"), F.count(F.lit(1)).alias("n_unique"), F.min_by("v", F.struct(-F.col("n"), F.col("x"), F.col("v"))).alias("top"),
        F.max("n").alias("freq"), (F.sum(F.col("d") * F.col("n")).cast("double") / F.sum("n")).alias("mean"),
        F.min("x").alias("min"), F.max("x").alias("max"),
    )
    base = freeze(base)  # a row for each column
    numbers = hist.where("x IS NOT NULL").select("c", "x", "n")
    away = numbers.join(F.broadcast(base.select("c", F.col("mean").alias("_mean"))), "c")
    spread = away.groupBy("c").agg((F.sum(F.col("n") * (F.col("x") - F.col("_mean")) ** 2)).alias("_squares"))
    quartiles = exact_quantiles(numbers, "x", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ["c"], weight="n")
    names = df.sparkSession.createDataFrame([(f.name, i) for i, f in enumerate(df.schema.fields)], "column_name string, i int")
    found = base.join(F.broadcast(spread), "c", "left").join(F.broadcast(quartiles), "c", "left")
    std = F.when(F.col("n_values") > 1, F.sqrt(F.col("_squares") / (F.col("n_values") - 1)))
    return names.join(F.broadcast(found), F.col("column_name") == F.col("c"), "left").select(
        "column_name", F.coalesce("n_values", F.lit(0)).alias("n_values"), F.coalesce("n_unique", F.lit(0)).alias("n_unique"), "top", "freq",
        F.round("mean", 4).alias("mean"), F.round(std, 4).alias("std"), "min", "q25", "q50", "q75", "max",
    )


def approximate_profile(df: DataFrame, precision: int = 16, k: int = 400) -> DataFrame:
    """The profile from sketches: one pass, one row per task to the shuffle, however many values a column has.

    Counts, mean, deviation, min and max are exact. Distinct values are estimated as in distinct_estimates(); quartiles by KLL
    sketches of rank error below 1 % for the k given; the most frequent value and its count are those of a sketch of
    10,000 items, which is exact while a column has no more values.
    """
    parts = []
    for f in df.schema.fields:
        c, text = F.col(f.name), F.col(f.name).cast("string")
        number = c.cast("double") if _numeric(f.dataType) else F.lit(None).cast("double")
        sketch = F.expr(f"kll_sketch_agg_double(CAST(`{f.name}` AS DOUBLE), {k})") if _numeric(f.dataType) else F.lit(None).cast("binary")
        parts.append(F.struct(
            F.lit(f.name).alias("column_name"), F.count(c).alias("n_values"),
            F.hll_sketch_estimate(F.hll_sketch_agg(text, F.lit(precision))).alias("n_unique"),
            F.expr(f"approx_top_k(CAST(`{f.name}` AS STRING), 2, 10000)").alias("common"),
            F.avg(number).alias("mean"), F.stddev_samp(number).alias("std"), F.min(number).alias("min"), F.max(number).alias("max"),
            sketch.alias("sketch"),
        ))
    rows = df.agg(F.array(*parts).alias("x")).select(F.inline("x"))
    at = lambda q: F.when(F.col("n_values") > 0, F.expr(f"kll_sketch_get_quantile_double(sketch, {q}D)"))
    first = F.try_element_at(F.filter("common", lambda x: x["item"].isNotNull()), F.lit(1))
    return rows.withColumn("_top", first).select(
        "column_name", "n_values", "n_unique", F.col("_top.item").alias("top"), F.col("_top.count").alias("freq"),
        F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min", at(0.25).alias("q25"), at(0.5).alias("q50"),
        at(0.75).alias("q75"), "max",
    )
