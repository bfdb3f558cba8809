"""Line dedup by site-relative frequency, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh
from tidemark.session import freeze

RATIO = 0.05
MIN_PAGES = 3


def _key(line: Column) -> Column:
    """128 bits of hash; a second column in xxhash64 is hashed with the first one's value as its seed."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b"))


def boilerplate(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES,
                host: str = "source", text: str = "text") -> DataFrame:
    """One row per host: the keys of its boilerplate lines as an array, and how many pages it has.

    A line is boilerplate where more than ratio of the host's pages hold it, and min_pages of them at least. A host
    whose pages have k different lines on average has fewer than k / ratio of those, however large it is, so the
    arrays stay short. Only line hashes are shuffled, counted before the shuffle; the hot host is no exception.
    """
    lines = docs.select(F.col(host).alias("host"), F.explode(F.array_distinct(F.split(text, "\n"))).alias("line"))
    counts = (
        lines.where(F.trim("line") != "").groupBy("host", _key(F.col("line")).alias("key"))
        .agg(F.count(F.lit(1)).alias("pages"))
        .where(F.col("pages") >= min_pages)
    )
    totals = docs.groupBy(F.col(host).alias("site")).agg(F.count(F.lit(1)).alias("total"))
    return (
        counts.join(totals, F.col("host").eqNullSafe(F.col("site")))
        .where(F.col("pages") / F.col("total") > ratio)
        .groupBy("host").agg(F.collect_set("key").alias("keys"))
    )


def drop_boilerplate(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES,
                     host: str = "source", text: str = "text") -> DataFrame:
    """All rows of docs, their text without the host's boilerplate lines, and the columns n_lines and n_dropped.

    Lines end at a line feed and count as equal if all their characters are. A page that repeats a line holds it once.
    Lines of blanks only are always kept. A null host is a host like any other. A null text stays null and has no
    lines; an empty text has one, empty, line. Repeated rows are pages of their own. Input columns named n_lines or
    n_dropped are replaced.
    """
    found = freeze(boilerplate(docs, ratio, min_pages, host, text))
    keys, site, lines, kept = (fresh(docs, f"_{n}") for n in ("keys", "site", "lines", "kept"))
    found = found.select(F.col("host").alias(site), F.col("keys").alias(keys))
    out = docs.join(found, docs[host].eqNullSafe(found[site]), "left").withColumn(lines, F.split(text, "\n"))
    out = out.withColumn(kept, F.when(F.col(keys).isNull(), F.col(lines)).otherwise(
        F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col(keys), _key(x)))
    ))
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    n_lines = F.when(F.col(lines).isNull(), F.lit(0)).otherwise(size(lines)).cast("long")
    n_kept = F.when(F.col(kept).isNull(), F.lit(0)).otherwise(size(kept)).cast("long")
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return out.select(
        *(F.array_join(kept, "\n").alias(text) if c == text else F.col(c) for c in names),
        n_lines.alias("n_lines"), (n_lines - n_kept).alias("n_dropped"),
    )
