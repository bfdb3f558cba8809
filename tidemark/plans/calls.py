"""Call events and customer changes: cleaning, scoring and the daily KPI tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.sentiment import DEFAULT, Lexicon, label, score_segments
from tidemark.functions.text import epoch_to_timestamp
from tidemark.operators.history import scd2
from tidemark.operators.quality import expect_or_drop, passes, quarantine

OPERATIONS = ("INSERT", "UPDATE", "DELETE")
# Columns that describe the delivery, not the customer.
BOOKKEEPING = ("operation", "source_file", "ingestion_timestamp")


# ---- expectations


def bronze_call_rules() -> dict[str, Column]:
    return {
        "valid_call_id": F.col("call_id").isNotNull(),
        "valid_customer_id": F.col("customer_id").isNotNull(),
        "valid_epoch": F.col("epoch_timestamp").isNotNull(),
        "non_negative_duration": F.col("duration_sec").isNull() | (F.col("duration_sec") >= 0),
    }


def bronze_change_rules() -> dict[str, Column]:
    return {
        "valid_customer_id": F.col("customer_id").isNotNull(),
        "valid_operation": F.col("operation").isin(*OPERATIONS),
        "valid_update_ts": F.col("update_ts").isNotNull(),
    }


def silver_call_rules() -> dict[str, Column]:
    return {
        "non_negative_duration": F.col("duration_sec") >= 0,
        "valid_event_ts": F.col("event_ts").isNotNull(),
        "valid_call_id": F.col("call_id").isNotNull(),
    }


# ---- calls


def with_event_time(calls: DataFrame) -> DataFrame:
    return calls.withColumn("event_ts", epoch_to_timestamp(F.col("epoch_timestamp")))


def flatten_metadata(calls: DataFrame) -> DataFrame:
    names = ("call_type", "channel", "region")
    return calls.select("*", *[F.col(f"metadata.{n}").alias(n) for n in names]).drop("metadata")


def explode_segments(calls: DataFrame) -> DataFrame:
    """One row per spoken turn; a call without turns leaves no row."""
    rest = [c for c in calls.columns if c != "transcript_segments"]
    return calls.select(*rest, F.inline("transcript_segments"))


def silver_calls(calls: DataFrame, watermark: str | None = None, lexicon: Lexicon = DEFAULT) -> DataFrame:
    """Scored segments of the distinct, valid calls; the same steps for a table and for a stream.

    With a watermark, rows later than it are dropped and the state of the deduplication stays bounded.
    Rows without an event time are filtered first, because a watermark does not hold them back.
    """
    timed = expect_or_drop(with_event_time(calls), silver_call_rules())
    if watermark:
        # a watermark needs a time with zone; event_ts itself stays the plain UTC clock reading
        moment = F.timestamp_seconds("epoch_timestamp")
        late_dropped = timed.withColumn("_event_time", moment).withWatermark("_event_time", watermark)
        once = late_dropped.dropDuplicates(["call_id", "_event_time"]).drop("_event_time")
    else:
        once = timed.dropDuplicates(["call_id", "event_ts"])
    return score_segments(explode_segments(flatten_metadata(once)).drop("_injection_type"), "text", lexicon)


def calls_without_segments(calls: DataFrame) -> DataFrame:
    """How many calls leave no segment row."""
    empty = F.coalesce(F.size("transcript_segments"), F.lit(-1)) <= 0
    return calls.agg(F.count_if(empty).alias("calls_without_segments"))


def lateness(calls: DataFrame, minutes: int = 10) -> DataFrame:
    """Calls by how long before the latest event they happened, in steps of `minutes`."""
    timed = with_event_time(calls).filter(F.col("event_ts").isNotNull())
    newest = timed.agg(F.max("epoch_timestamp").alias("_newest"))
    behind = F.floor((F.col("_newest") - F.col("epoch_timestamp")) / (60 * minutes)) * minutes
    return (
        timed.crossJoin(F.broadcast(newest))
        .groupBy(behind.alias("minutes_behind"))
        .agg(F.count(F.lit(1)).alias("n_calls"))
    )


# ---- customers


def _typed_columns() -> dict[str, Column]:
    kinds = {"customer_id": "int", "age": "int", "signup_date": "date", "update_ts": "timestamp_ntz"}
    return {c: F.col(c).cast("string").try_cast(kind) for c, kind in kinds.items()}


def typed_changes(raw: DataFrame) -> DataFrame:
    return raw.withColumns(_typed_columns())


def split_changes(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed valid changes, and the rejected raw rows with the first reason that applies.

    Checks run after typing: a value that cannot be cast is a reason of its own, and a NULL operation is
    invalid. What the rules do not pass is rejected, so every row is in exactly one part.
    """
    names = list(_typed_columns())
    valid = expect_or_drop(typed_changes(raw), bronze_change_rules())
    both = typed_changes(raw.withColumns({f"_raw_{c}": F.col(c) for c in names}))
    bad = {
        "null_customer_id": F.col("_raw_customer_id").isNull(),
        "uncastable_customer_id": F.col("customer_id").isNull(),
        "invalid_operation": ~passes(F.col("operation").isin(*OPERATIONS)),
        "null_update_ts": F.col("_raw_update_ts").isNull(),
        "uncastable_update_ts": F.col("update_ts").isNull(),
    }
    _, rejects = quarantine(both, bad)
    restored = rejects.withColumns({c: F.col(f"_raw_{c}") for c in names}).drop(*[f"_raw_{c}" for c in names])
    return valid, restored


def customer_history(changes: DataFrame) -> DataFrame:
    return scd2(
        changes,
        keys=["customer_id"],
        seq="update_ts",
        track=["city", "subscription_type"],
        delete_when=F.col("operation") == "DELETE",
        exclude=BOOKKEEPING,
    )


# ---- KPI tables


def call_level(silver: DataFrame) -> DataFrame:
    """Mean score and label per call, at the grain (call, customer, duration, time).

    The label follows the mean as it is; only the score that is shown is rounded.
    """
    score = F.col("sentiment_score").cast("decimal(10,4)")
    mean = F.sum(score).cast("double") / F.count("sentiment_score")
    return (
        silver.groupBy("call_id", "customer_id", "duration_sec", F.to_date("event_ts").alias("date"), "event_ts")
        .agg(mean.alias("_mean"))
        .select("*", F.round("_mean", 6).alias("call_sentiment_score"), label(F.col("_mean")).alias("call_label"))
        .drop("_mean")
    )


def with_current_customer(calls: DataFrame, customers: DataFrame) -> DataFrame:
    return calls.join(customers.select("customer_id", "city", "subscription_type", "age"), "customer_id", "left")


def _mean_score() -> Column:
    """Mean of call scores, summed exactly so that the order of summing does not matter."""
    total = F.sum(F.col("call_sentiment_score").cast("decimal(12,6)")).cast("double")
    return F.round(total / F.count("call_sentiment_score"), 4)


def _sentiment_by(calls: DataFrame, by: list[str]) -> DataFrame:
    labels = {f"{n}_calls": F.count_if(F.col("call_label") == n) for n in ("positive", "negative", "neutral")}
    return (
        calls.groupBy(*by)
        .agg(
            F.count_distinct("call_id").alias("total_calls"),
            *[c.alias(n) for n, c in labels.items()],
            _mean_score().alias("avg_sentiment_score"),
        )
        .withColumn("sentiment_ratio", F.round(F.col("positive_calls") / F.col("total_calls").cast("double"), 4))
    )


def sentiment_daily(calls: DataFrame) -> DataFrame:
    return _sentiment_by(calls, ["date"])


def call_volume_daily(silver: DataFrame) -> DataFrame:
    per_call = silver.groupBy("call_id", F.to_date("event_ts").alias("date")).agg(
        F.max("duration_sec").alias("duration_sec")
    )
    # a call has one row per day by now
    return per_call.groupBy("date").agg(
        F.count(F.lit(1)).alias("total_calls"),
        F.round(F.avg("duration_sec"), 1).alias("avg_duration_sec"),
        F.max("duration_sec").alias("max_duration_sec"),
        F.min("duration_sec").alias("min_duration_sec"),
    )


def high_risk_customers(
    calls: DataFrame, customers: DataFrame, threshold: int = 3, days: int = 7, as_of: Column | None = None
) -> DataFrame:
    """Customers with at least `threshold` negative calls in the `days` up to as_of (default: last call).

    Without as_of the calls are read twice, so they should be a stored table.

    Calls are reduced to one row per customer before the customer table is joined.
    """
    if as_of is None:
        latest = calls.agg(F.max("event_ts").alias("_as_of"))
        timed = calls.crossJoin(F.broadcast(latest))
    else:
        timed = calls.withColumn("_as_of", as_of)
    recent = timed.filter(
        (F.col("event_ts") >= F.col("_as_of") - F.make_dt_interval(days=F.lit(days))) & (F.col("event_ts") <= F.col("_as_of"))
    )
    negative = F.col("call_label") == "negative"
    risky = (
        recent.groupBy("customer_id")
        .agg(
            F.count_distinct("call_id").alias("total_calls_7d"),
            F.count(F.when(negative, True)).alias("negative_call_count_7d"),
            F.max(F.when(negative, F.col("event_ts"))).alias("last_negative_call_ts"),
            _mean_score().alias("avg_sentiment_score_7d"),
        )
        .filter(F.col("negative_call_count_7d") >= threshold)
    )
    return with_current_customer(risky, customers)


def region_sentiment(enriched: DataFrame) -> DataFrame:
    return _sentiment_by(enriched, ["city", "date"])


def subscription_sentiment(enriched: DataFrame) -> DataFrame:
    return _sentiment_by(enriched, ["subscription_type", "date"])
