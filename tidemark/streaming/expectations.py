"""Expectations counted on a stream while its rows pass by, as a table of (batch, rule, passed, failed).

The counts are observed in the micro-batch that appends the rows, so the stream is read once. A listener of the query writes
them to a folder for each batch. A batch that is repeated after a failure reports again and overwrites its folder, so each
counts once.
"""

from __future__ import annotations

import threading
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.operators.quality import passes
from tidemark.sources.files import stream_calls, stream_changes, with_lineage
from tidemark.streaming.ingest import append_available
from tidemark.streaming.late import made

METRICS = T.StructType([
    T.StructField("rule", T.StringType()), T.StructField("passed", T.LongType()), T.StructField("failed", T.LongType()),
])
NAME, ROWS = "expectations", "n_rows_"


def counted(stream: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The stream with the violations of each rule observed; all rows stay."""
    return stream.observe(NAME, F.count(F.lit(1)).alias(ROWS), *[F.count_if(~passes(c)).alias(n) for n, c in rules.items()])


class ExpectationLog(StreamingQueryListener):
    """Writes what counted() observes, one folder for each micro-batch."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self.error = spark, path, None
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(NAME)
        if row is None or self.error is not None:
            return
        try:
            found = row.asDict()
            n = found.pop(ROWS)
            rows = [(rule, n - failed, failed) for rule, failed in found.items()]
            self.spark.createDataFrame(rows, METRICS).coalesce(1).write.mode("overwrite").parquet(
                f"{self.path}/batch={event.progress.batchId}"
            )
        except Exception as e:  # an exception here would vanish in the listener's thread; append_counted() raises it
            self.error = e

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


def append_counted(stream: DataFrame, rules: Mapping[str, Column], out: str, metrics: str, checkpoint: str, wait: float = 600) -> None:
    """Append what has arrived and write the counts of every micro-batch; returns once the last are written."""
    spark = stream.sparkSession
    log = ExpectationLog(spark, made(spark, metrics))
    spark.streams.addListener(log)
    try:
        append_available(counted(stream, rules), out, checkpoint)
        if not log.ended.wait(wait):
            raise TimeoutError(f"the stream's last counts were not written within {wait} seconds")
    finally:
        spark.streams.removeListener(log)
    if log.error is not None:
        raise log.error


def read_metrics(spark: SparkSession, metrics: str) -> DataFrame:
    """batch, rule, passed and failed."""
    fields = [*METRICS.fields, T.StructField("batch", T.LongType())]
    return spark.read.schema(T.StructType(fields)).parquet(made(spark, metrics)).select("batch", *METRICS.names)


def totals(spark: SparkSession, metrics: str) -> DataFrame:
    """rule, passed and failed over all batches."""
    return read_metrics(spark, metrics).groupBy("rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


def ingest_calls_counted(
    spark: SparkSession, landing: str, out: str, metrics: str, checkpoint: str, rules: Mapping[str, Column], max_files: int | None = None
) -> None:
    append_counted(with_lineage(stream_calls(spark, landing, max_files)), rules, out, metrics, checkpoint)


def ingest_changes_counted(
    spark: SparkSession, landing: str, out: str, metrics: str, checkpoint: str, rules: Mapping[str, Column], max_files: int | None = None
) -> None:
    append_counted(with_lineage(stream_changes(spark, landing, max_files)), rules, out, metrics, checkpoint)
