"""Daily call KPIs kept up to date from a stream.

Every micro-batch leaves partial sums that can be added up, and makes the KPI rows of the days it touches anew from them. Parquet
below the base folder:

    seen/batch=N/date=D         the batch's new calls: a number for each call of a day, and its longest duration so far
    scores/batch=N/date=D       by customer: calls by label, the sum of scores, and the numbers of the customer's calls
    durations/batch=N/date=D    how many calls have which duration; a call that grows longer leaves its old one
    gold-<kpi>/batch=N          the KPI rows of the days that the batch touched
    manifest/batch=N            those days; written last, so it marks the batch as complete

A call is known by its id and time. One that is delivered again is left out, by the calls seen on its day. No batch reads
more than the touched days, and of those the partial sums and the narrow list of calls, never the segments. Distinct calls of
a city or subscription are counted with bitmaps of the day's call numbers, so they are exact whichever customers share a call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ordering import cell_of, numbered
from tidemark.plans.calls import call_level, silver_calls
from tidemark.session import freeze
from tidemark.sources.files import stream_calls
from tidemark.streaming.late import made

LABELS = ("positive", "negative", "neutral")
SEEN = "call_id string, event_ts timestamp_ntz, number long, duration_sec int, batch long, date date"
SCORES = "customer_id int, positive long, negative long, neutral long, total decimal(30,6), n long, calls array<long>, batch long, date date"
DURATIONS = "duration_sec int, n long, batch long, date date"
MANIFEST = "date date, batch long"


def _read(spark: SparkSession, base: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(made(spark, f"{base}/{name}"))


def committed(spark: SparkSession, base: str) -> int:
    newest = _read(spark, base, "manifest", MANIFEST).agg(F.max("batch")).first()[0]
    return -1 if newest is None else newest


def apply_calls(calls: DataFrame, batch_id: int, base: str, customers: DataFrame | None = None) -> None:
    """Add one batch of raw calls and bring the KPIs of its days up to date.

    customers (customer_id, city, subscription_type) are those of now; without them only the daily KPIs are kept. A batch
    that is complete already is skipped; batches come in order.
    """
    spark = calls.sparkSession
    if batch_id <= committed(spark, base):
        return
    level = freeze(call_level(silver_calls(calls)))
    days = [r.date for r in level.select("date").distinct().collect()]  # the days of one batch
    old = _read(spark, base, "seen", SEEN).where((F.col("batch") < batch_id) & F.col("date").isin(days))
    known = old.select(F.struct("call_id", "event_ts").alias("_cell")).distinct()
    new = freeze(level.join(known, F.struct("call_id", "event_ts") == F.col("_cell"), "left_anti"))

    # the calls of a day by number, and how long they were known to be
    per_call = old.groupBy("date", "call_id").agg(F.max("number").alias("number"), F.max("duration_sec").alias("was"))
    per_call = per_call.select(F.struct("date", "call_id").alias("_cell"), "number", "was")
    grown = new.groupBy("date", "call_id").agg(F.max("duration_sec").alias("duration_sec"))
    grown = freeze(grown.join(per_call, F.struct("date", "call_id") == F.col("_cell"), "left").drop("_cell"))
    first = numbered(grown.where("number IS NULL").drop("number"), [F.col("call_id")], ["date"])
    taken = old.groupBy("date").agg(F.max("number").alias("taken")).select(cell_of(["date"]).alias("_cell"), "taken")
    first = first.join(taken, cell_of(["date"]) == F.col("_cell"), "left").withColumn("number", F.coalesce("taken", F.lit(0)) + F.col("_rn"))
    now = freeze(grown.where("number IS NOT NULL").unionByName(first.select(*grown.columns)))
    numbers = now.select(F.struct("date", "call_id").alias("_cell"), "number")
    placed = freeze(new.join(numbers, F.struct("date", "call_id") == F.col("_cell")).drop("_cell"))

    def write(rows: DataFrame, name: str) -> None:
        rows.write.mode("overwrite").partitionBy("date").parquet(f"{base}/{name}/batch={batch_id}")

    score = F.col("call_sentiment_score").cast("decimal(12,6)")
    write(placed.select("call_id", "event_ts", "number", "duration_sec", "date"), "seen")
    write(placed.groupBy("date", "customer_id").agg(
        *[F.count_if(F.col("call_label") == x).alias(x) for x in LABELS],
        F.sum(score).cast("decimal(30,6)").alias("total"), F.count(score).alias("n"), F.collect_set("number").alias("calls"),
    ), "scores")
    longer = F.greatest("duration_sec", "was")
    moved = now.where("was IS NULL OR duration_sec > was").select("date", F.inline(F.filter(F.array(
        F.struct(longer.alias("duration_sec"), F.lit(1).alias("n")), F.struct(F.col("was").alias("duration_sec"), F.lit(-1).alias("n")),
    ), lambda x: x["duration_sec"].isNotNull())))
    write(moved.groupBy("date", "duration_sec").agg(F.sum("n").alias("n")), "durations")

    for name, rows in gold(spark, base, batch_id, days, customers).items():
        rows.write.mode("overwrite").parquet(f"{base}/gold-{name}/batch={batch_id}")
    marks = spark.createDataFrame([(d,) for d in days] or [(None,)], "date date")
    marks.coalesce(1).write.mode("overwrite").parquet(f"{base}/manifest/batch={batch_id}")


def _sentiment(sums: DataFrame, by: list[str]) -> DataFrame:
    """The sentiment KPI from partial sums by customer and day."""
    totals = sums.groupBy(*by).agg(*[F.sum(x).alias(f"{x}_calls") for x in LABELS], F.sum("total").alias("total"), F.sum("n").alias("n"))
    numbers = sums.select(*by, F.explode("calls").alias("number"))
    maps = numbers.groupBy(*by, F.bitmap_bucket_number("number").alias("part")).agg(
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("number"))).alias("m")
    )
    distinct = maps.groupBy(*by).agg(F.sum("m").alias("total_calls")).select(cell_of(by).alias("_cell"), "total_calls")
    found = totals.join(distinct, cell_of(by) == F.col("_cell"))
    return found.select(
        *by, "total_calls", *[f"{x}_calls" for x in LABELS], F.round(F.col("total").cast("double") / F.col("n"), 4).alias("avg_sentiment_score"),
        F.round(F.col("positive_calls") / F.col("total_calls").cast("double"), 4).alias("sentiment_ratio"),
    )


def gold(spark: SparkSession, base: str, batch_id: int, days: list, customers: DataFrame | None) -> dict[str, DataFrame]:
    """The KPI rows of some days from the partial sums of all batches up to one."""
    here: Callable[[DataFrame], DataFrame] = lambda df: df.where((F.col("batch") <= batch_id) & F.col("date").isin(days))
    sums = here(_read(spark, base, "scores", SCORES))
    long = here(_read(spark, base, "durations", DURATIONS)).groupBy("date", "duration_sec").agg(F.sum("n").alias("n")).where("n > 0")
    seconds = F.sum(F.col("duration_sec") * F.col("n")).cast("double")
    out = {
        "sentiment_daily": _sentiment(sums, ["date"]),
        "call_volume_daily": long.groupBy("date").agg(
            F.sum("n").alias("total_calls"), F.round(seconds / F.sum("n"), 1).alias("avg_duration_sec"),
            F.max("duration_sec").alias("max_duration_sec"), F.min("duration_sec").alias("min_duration_sec"),
        ),
    }
    if customers is not None:
        told = sums.join(customers.select("customer_id", "city", "subscription_type"), "customer_id", "left")
        out["region_sentiment"] = _sentiment(told, ["city", "date"])
        out["subscription_sentiment"] = _sentiment(told, ["subscription_type", "date"])
    return out


def read_kpi(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A KPI as of the newest complete batch: each day from the last batch that touched it."""
    newest = _read(spark, base, "manifest", MANIFEST).where("date IS NOT NULL").groupBy("date").agg(F.max("batch").alias("batch"))
    rows = spark.read.option("basePath", f"{base}/gold-{name}").parquet(f"{base}/gold-{name}")
    # one row a day
    return rows.join(F.broadcast(newest), ["date", "batch"]).drop("batch")


def follow_calls(
    spark: SparkSession, landing: str, base: str, customers: DataFrame | None = None, max_files: int | None = None
) -> None:
    """Apply all call files that have arrived, in micro-batches."""
    query = (
        stream_calls(spark, landing, max_files)
        .writeStream.foreachBatch(lambda df, batch_id: apply_calls(df, batch_id, base, customers))
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
