"""Streams whose late rows are a result of their own, and whose state stays bounded.

Structured Streaming drops what is later than its watermark without a trace. Here a router goes first. It judges each micro-batch by
the newest event time of all batches before it:

    accepted/batch=N    rows in time
    late/batch=N        rows at or below the watermark, which is beside them
    progress/batch=N    the newest event time so far; written last, and read by the batches after it

A batch that is repeated after a failure overwrites its own folders. The deduplicating stream takes the accepted rows up; its
own watermark never runs ahead of the router's, so it drops none of them, and its state holds a key only until no copy can
be accepted any more.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.calls import silver_call_rules, with_event_time
from tidemark.operators.quality import expect_or_drop
from tidemark.sources.files import stream_calls
from tidemark.streaming.ingest import LATE, append_available

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
NEWEST = T.StructType([T.StructField("newest", T.TimestampNTZType()), T.StructField("batch", T.LongType())])


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for as long as a stream is started; a dot is written as two underscores."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def made(spark: SparkSession, path: str) -> str:
    """The path of a folder, made where it is missing, so that a table without rows can be read."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    return path


def newest_before(spark: SparkSession, base: str, batch_id: int):
    """The newest event time of the batches before one, None before the first."""
    progress = spark.read.schema(NEWEST).parquet(made(spark, f"{base}/progress"))
    return progress.where(F.col("batch") < batch_id).agg(F.max("newest")).first()[0]


def route(rows: DataFrame, batch_id: int, base: str, time: str, late: str = LATE) -> None:
    """Write the rows of one micro-batch to the accepted or to the late ones. Rows without a time are left out.

    The input is evaluated once: both parts are written from one stored copy, told apart by the column of its folders.
    """
    spark = rows.sparkSession
    newest = newest_before(spark, base, batch_id)
    limit = F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {late}")
    judged = rows.where(F.col(time).isNotNull()).withColumn("watermark", limit)
    judged = judged.withColumn("is_late", F.coalesce(F.col(time) <= F.col("watermark"), F.lit(False)))
    both = f"{base}/judged/batch={batch_id}"
    judged.write.mode("overwrite").partitionBy("is_late").parquet(both)
    stored = spark.read.schema(judged.schema).parquet(both)
    stored.where("NOT is_late").drop("is_late", "watermark").write.mode("overwrite").parquet(f"{base}/accepted/batch={batch_id}")
    stored.where("is_late").drop("is_late").write.mode("overwrite").parquet(f"{base}/late/batch={batch_id}")
    mark = stored.agg(F.max(time).alias("newest")).select(F.greatest("newest", F.lit(newest).cast("timestamp_ntz")).alias("newest"))
    mark.write.mode("overwrite").parquet(f"{base}/progress/batch={batch_id}")


def follow(stream: DataFrame, base: str, time: str, late: str = LATE) -> None:
    """Route all that has arrived."""
    query = (
        stream.writeStream.foreachBatch(lambda df, batch_id: route(df, batch_id, base, time, late))
        .option("checkpointLocation", f"{base}/checkpoint-route")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def keep_first(spark: SparkSession, schema: T.StructType, base: str, keys: Sequence[str], time: str, late: str = LATE) -> int:
    """Append the first of the accepted rows with equal keys to kept/, and give the rows of state that are held afterwards.

    The time must be one of the keys: a copy then is in time exactly as long as the state still holds its key. All that is
    waiting is one micro-batch, so no batch of the router is cut in two.
    """
    if time not in keys:
        raise ValueError(f"{time} must be one of the keys")
    rows = spark.readStream.schema(schema).parquet(made(spark, f"{base}/accepted")).drop("batch")
    # a watermark needs a time with zone
    once = rows.withColumn("_moment", F.col(time).cast("timestamp")).withWatermark("_moment", late)
    once = once.dropDuplicatesWithinWatermark([c for c in keys if c != time] + ["_moment"]).drop("_moment")
    with settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKS):
        query = append_available(once, f"{base}/kept", f"{base}/checkpoint-keep")
    progress = query.lastProgress
    return sum(op["numRowsTotal"] for op in progress["stateOperators"]) if progress else 0


def follow_calls(spark: SparkSession, landing: str, base: str, max_files: int | None = None, late: str = LATE) -> int:
    """Valid calls from arriving files: in time and once under kept/, too late under late/; gives the rows of state held."""
    stream = expect_or_drop(with_event_time(stream_calls(spark, landing, max_files)), silver_call_rules())
    follow(stream, base, "event_ts", late)
    return keep_first(spark, stream.schema, base, ["call_id", "event_ts"], "event_ts", late)
