"""Reports on data quality: gaps, copies, broken constraints, expectations and quarantine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators.joins import orphans


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values of every column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def missing_summary(df: DataFrame) -> DataFrame:
    """Columns with gaps, their number of gaps and the share in percent."""
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing_count")) for c in df.columns])
    share = F.round(F.col("missing_count") * F.lit(100.0) / F.col("_rows"), 2)
    return (
        counted.select("_rows", F.inline(pairs))
        .filter(F.col("missing_count") > 0)
        .select("column_name", "missing_count", share.alias("missing_pct"))
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def extra_copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows repeat an earlier one."""
    extra = F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0))
    return duplicate_keys(df, keys).agg(extra.alias("n_duplicates"))


def column_listing(df: DataFrame) -> DataFrame:
    """Name, position and type of every column, with the number of rows read."""
    listing = F.array(
        *[
            F.struct(F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("data_type"))
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.inline(listing), "n_rows")


# ---- constraints


@dataclass(frozen=True)
class Unique:
    """Primary key or unique column; a primary key must not be NULL either."""

    name: str
    columns: tuple[str, ...]
    not_null: bool = True

    def violations(self, df: DataFrame) -> DataFrame:
        """Rows beyond the first of each key; gaps() are counted in the pass over the rows."""
        return duplicate_keys(df, self.columns).agg(F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).alias("n"))

    def gaps(self) -> Column:
        return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in self.columns]) if self.not_null else F.lit(False)


@dataclass(frozen=True)
class Check:
    """A condition every row must meet; as in SQL a NULL result passes."""

    name: str
    condition: Column


@dataclass(frozen=True)
class ForeignKey:
    """A key that must exist in the parent; NULL passes."""

    name: str
    column: str
    parent: DataFrame
    parent_column: str

    def violations(self, df: DataFrame) -> DataFrame:
        given = df.filter(F.col(self.column).isNotNull())
        return orphans(given, self.column, self.parent, self.parent_column).agg(F.count(F.lit(1)).alias("n"))


def not_null(column: str) -> Check:
    return Check(f"{column}_not_null", F.col(column).isNotNull())


def validate(df: DataFrame, constraints: Sequence[Unique | Check | ForeignKey]) -> DataFrame:
    """One row per constraint with its number of violations.

    All conditions on rows, those of keys that must not be NULL among them, are counted in one pass.
    """
    parts = [
        c.violations(df).select(F.lit(c.name).alias("constraint"), F.col("n").alias("violations"))
        for c in constraints if not isinstance(c, Check)
    ]
    broken = {c.name: ~c.condition for c in constraints if isinstance(c, Check)}
    broken |= {c.name: c.gaps() for c in constraints if isinstance(c, Unique) and c.not_null}
    if broken:
        counted = df.agg(*[F.count_if(bad).alias(name) for name, bad in broken.items()])
        pairs = [F.struct(F.lit(n).alias("constraint"), F.col(f"`{n}`").alias("violations")) for n in broken]
        parts.append(counted.select(F.inline(F.array(*pairs))))
    # a row or two per constraint
    return reduce(DataFrame.unionByName, parts).groupBy("constraint").agg(F.sum("violations").alias("violations"))


class IntegrityError(ValueError):
    """Raised when a loaded table breaks a constraint."""


def require(report: DataFrame) -> None:
    """Raise if a report of violations (one row per check) holds any."""
    broken = report.filter(F.col("violations") > 0).collect()
    if broken:
        raise IntegrityError(", ".join(f"{r['constraint']}: {r['violations']}" for r in broken))


# ---- expectations


def passes(condition: Column) -> Column:
    """An expectation holds only if it is true; NULL counts as broken."""
    return F.coalesce(condition, F.lit(False))


def expectation_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows kept and rows breaking each rule, in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(~passes(c)).alias(n) for n, c in rules.items()]
    )
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("failed")) for n in rules])
    return counted.select("_rows", F.inline(pairs)).select("rule", (F.col("_rows") - F.col("failed")).alias("passed"), "failed")


def warn(df: DataFrame, rules: Mapping[str, Column], observation: Observation) -> DataFrame:
    """Keep all rows and count violations while they pass by; the counts are in observation.get."""
    return df.observe(observation, *[F.count_if(~passes(c)).alias(n) for n, c in rules.items()])


def expect_or_drop(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [passes(c) for c in rules.values()]))


def quarantine(df: DataFrame, reasons: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split into valid rows and rejects; a reject carries the first reason that applies.

    reasons maps a reason to the condition under which a row is bad. Every row is in exactly one part.
    """
    reason = None
    for name, bad in reasons.items():
        bad = F.coalesce(bad, F.lit(False))
        reason = F.when(bad, name) if reason is None else reason.when(bad, name)
    marked = df.withColumn("reject_reason", reason)
    valid = marked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return valid, marked.filter(F.col("reject_reason").isNotNull())
