"""Streams of arriving files to append-only tables, run until everything present is taken."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.calls import silver_calls
from tidemark.sources.files import stream_calls, stream_changes, with_lineage

LATE = "30 minutes"


def append_available(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived as Parquet and stop; the checkpoint makes each file count once."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return query


def ingest_calls(spark: SparkSession, landing: str, out: str, checkpoint: str, max_files: int | None = None) -> None:
    """Raw call events with their origin, unchanged otherwise."""
    append_available(with_lineage(stream_calls(spark, landing, max_files)), out, checkpoint)


def ingest_changes(spark: SparkSession, landing: str, out: str, checkpoint: str, max_files: int | None = None) -> None:
    append_available(with_lineage(stream_changes(spark, landing, max_files)), out, checkpoint)


def stream_silver_calls(
    spark: SparkSession, landing: str, out: str, checkpoint: str, max_files: int | None = None, late: str = LATE
) -> None:
    """Scored call segments from arriving files; later than `late` behind the newest call is dropped."""
    append_available(silver_calls(stream_calls(spark, landing, max_files), watermark=late), out, checkpoint)
