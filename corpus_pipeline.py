"""The corpus pipeline: documents to token ids, each stage working on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, ordinal, simhash, site_lines
from tidemark.llm.common import table
from tidemark.llm.queries import vocabulary
from tidemark.session import freeze


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the rated ones among them, selects. Texts without words go."""
    model = ordinal.fit(docs, ordinal.grades_of(table(spark, sf_dir, "labels")))
    return ordinal.score(docs, model).where("selected").select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their site's boilerplate lines, n_chars counted anew; every document stays."""
    return site_lines.drop_boilerplate(docs).select(docs.columns).withColumn("n_chars", F.char_length("text").cast("long"))


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near-duplicates, or one row of a group without any doc_id."""
    return simhash.keep_first(docs, keep_unnamed=False)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the ids of the text's tokens, and digests of the ids and of what they decode to."""
    words = vocabulary()
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), words).drop("text")
    return bpe.decode(encoded, words).select("doc_id", "lang", "source", "ids", *bpe.digests(encoded))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", keep_first),
    ("benchmark decontamination", drop_leaks),
    ("byte-level BPE", tokens),
]

#: SQL can express neither the classifier nor the merges; the tests hold run() against a plain restatement.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = freeze(stage(spark, docs, sf_dir))
    return docs
