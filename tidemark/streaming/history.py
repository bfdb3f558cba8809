"""Customer history kept up to date from a stream of change files, without replaying the log.

Every micro-batch adds a delta of its own; nothing that stands is rewritten. Parquet below the base folder:

    delta/moments/batch=N/bucket=B/period=P    the batch's valid changes, one per customer and time, by month of the change
    delta/versions/batch=N/bucket=B/until=P    the versions that the batch opened or changed, by the month they end in
    delta/cuts/batch=N/bucket=B                from which start on the batch replaces a customer's versions
    delta/heads/batch=N/bucket=B               the customers' newest state: what a change in order continues
    base/versions, base/heads (upto=N/...)     a bucket's versions and heads of all batches up to N in one segment
    rejects/batch=N                            the rejected rows with their reason
    manifest/batch=N                           what was read and written; written last, so it marks the batch as complete
    compacted/upto=N                           the buckets whose base segment up to N is complete; written last as well

A change later than its customer's head continues the head: nothing else is read. One that comes late reopens the version in
force before it; the customer's changes from that version's start on are read and the versions after it made anew. Months
before are skipped by their folders.

A reader takes each bucket's newest base and the deltas after it. A version counts unless a later batch cuts its customer at
or before its start. A bucket is compacted once its deltas hold as many versions as its base, so a version is
rewritten a logarithmic number of times. A batch or compaction that breaks off leaves folders that no manifest names;
readers don't see them and the next attempt overwrites them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.history import END, START, scd2
from tidemark.plans.calls import split_changes
from tidemark.schemas import HISTORY, TYPED_CHANGES
from tidemark.session import freeze
from tidemark.sources.files import stream_changes

KEY, SEQ = "customer_id", "update_ts"
TRACK, OTHERS = ["city", "subscription_type"], ["age", "signup_date"]
OPEN = "open"  # in the order of texts behind every month

_TYPES = {f.name: f.dataType for f in (*TYPED_CHANGES.fields, *HISTORY.fields)}


def _schema(*names: str, **more: T.DataType) -> T.StructType:
    kinds = _TYPES | {"gone": T.BooleanType(), "start": T.TimestampNTZType(), "cut": T.TimestampNTZType()} | more
    return T.StructType([T.StructField(c, kinds[c]) for c in names])


#: The columns of each table and the folders below its bucket.
TABLES = {
    "moments": (_schema(KEY, SEQ, "gone", *TRACK, *OTHERS), ["period"]),
    "versions": (_schema(*HISTORY.names), ["until"]),
    "cuts": (_schema(KEY, "cut"), []),
    "heads": (_schema(KEY, SEQ, "gone", *TRACK, *OTHERS, "start"), []),
}
PLACES = {"batch": T.LongType(), "upto": T.LongType(), "bucket": T.IntegerType(), "period": T.StringType(), "until": T.StringType()}
MANIFEST = T.StructType([
    T.StructField("bucket", T.IntegerType()), T.StructField("n_versions", T.LongType()),
    *(T.StructField(f"{t}_read", T.LongType()) for t in ("heads", "versions", "moments")),
])
COMPACTED = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n_versions", T.LongType())])


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.hash(key), F.lit(buckets))


def month_of(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM")


def _table(spark: SparkSession, path: str, schema: T.StructType, places: list[str]) -> DataFrame:
    """A table of folders, empty where nothing has been written yet."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    fields = [*schema.fields, *(T.StructField(p, PLACES[p]) for p in places)]
    return spark.read.schema(T.StructType(fields)).parquet(path)


@dataclass(frozen=True)
class Store:
    """The folders of one history."""

    spark: SparkSession
    base: str

    def manifest(self) -> DataFrame:
        return _table(self.spark, f"{self.base}/manifest", MANIFEST, ["batch"])

    def committed(self) -> int:
        """The newest complete batch, -1 before the first."""
        newest = self.manifest().agg(F.max("batch")).first()[0]
        return -1 if newest is None else newest

    @cached_property
    def segments(self) -> dict[int, tuple[int, int]]:
        """Up to which batch each bucket's base reaches and how many versions it holds; as many entries as buckets."""
        rows = _table(self.spark, f"{self.base}/compacted", COMPACTED, ["upto"])
        newest = rows.groupBy("bucket").agg(F.max(F.struct("upto", "n_versions")).alias("x"))
        return {r.bucket: (r.x.upto, r.x.n_versions) for r in newest.collect()}

    def read(self, name: str, before: int, since: dict[int, str] | None = None) -> DataFrame:
        """Rows of a table from the bases and from the deltas before a batch, with batch, the one they come from.

        since gives the buckets that are wanted and the first month of each ("" for all).
        """
        schema, below = TABLES[name]
        segments = self.segments
        places = ["bucket", *below]
        delta = _table(self.spark, f"{self.base}/delta/{name}", schema, ["batch", *places]).where(F.col("batch") < before)
        parts = [delta]
        if name in ("versions", "heads"):
            base = _table(self.spark, f"{self.base}/base/{name}", schema, ["upto", *places])
            by_upto: dict[int, list[int]] = {}
            for b, (upto, _) in segments.items():
                by_upto.setdefault(upto, []).append(b)
            here = [(F.col("upto") == u) & F.col("bucket").isin(bs) for u, bs in by_upto.items()]
            parts.append(base.where(reduce(lambda a, b: a | b, here, F.lit(False))).withColumnRenamed("upto", "batch"))
        if name != "moments":
            past = [F.col("bucket").isin(bs) & (F.col("batch") <= u) for u, bs in _grouped({b: u for b, (u, _) in segments.items()})]
            parts[0] = delta.where(~reduce(lambda a, b: a | b, past, F.lit(False)))
        rows = reduce(DataFrame.unionByName, parts)
        if since is not None:
            month = F.col(below[0]) if below else F.lit(OPEN)
            wanted = [F.col("bucket").isin(bs) & (month >= first) for first, bs in _grouped(since)]
            rows = rows.where(reduce(lambda a, b: a | b, wanted, F.lit(False)))
        return rows.drop(*below)

    def valid_versions(self, before: int, since: dict[int, str] | None = None) -> DataFrame:
        """Versions that no later batch has cut."""
        rows = self.read("versions", before, since)
        buckets = None if since is None else dict.fromkeys(since, "")
        cuts = self.read("cuts", before, buckets).select(F.struct(F.col(KEY).alias("k")).alias("_cell"), F.col("batch").alias("_later"), "cut")
        late = (F.struct(F.col(KEY).alias("k")) == F.col("_cell")) & (F.col("_later") > F.col("batch")) & (F.col("cut") <= F.col(START))
        return rows.join(cuts, late, "left_anti")

    def newest_heads(self, before: int, since: dict[int, str] | None = None) -> DataFrame:
        rows = self.read("heads", before, since)
        columns = [c for c in rows.columns if c not in (KEY, "bucket", "batch")]
        newest = rows.groupBy("bucket", KEY).agg(F.max_by(F.struct(*columns), "batch").alias("h"))
        return newest.select("bucket", KEY, "h.*")

    def write(self, rows: DataFrame, name: str, batch_id: int) -> None:
        rows.write.mode("overwrite").partitionBy("bucket", *TABLES[name][1]).parquet(f"{self.base}/delta/{name}/batch={batch_id}")


def _grouped(values: dict) -> list[tuple]:
    """Each value with the keys that have it."""
    out: dict = {}
    for k, v in values.items():
        out.setdefault(v, []).append(k)
    return list(out.items())


def apply_changes(changes: DataFrame, batch_id: int, base: str, buckets: int = 64, compact_rows: int = 100_000) -> None:
    """Add one batch of raw changes. A batch that is complete already is skipped, so repeating one changes nothing.

    Batches come in order, as Structured Streaming numbers them; the changes in them may come in any order. Buckets whose
    deltas have outgrown their base, and hold at least compact_rows versions, are compacted afterwards.
    """
    spark = changes.sparkSession
    store = Store(spark, base)
    if batch_id <= store.committed():
        return
    valid, rejects = split_changes(changes)
    rejects.write.mode("overwrite").parquet(f"{base}/rejects/batch={batch_id}")
    state = [F.coalesce(F.col("operation") == "DELETE", F.lit(False)).alias("gone"), *TRACK, *OTHERS]
    once = valid.groupBy(KEY, SEQ).agg(F.max(F.struct(*state)).alias("x")).select(KEY, SEQ, "x.*")
    placed = once.withColumn("bucket", bucket_of(KEY, buckets)).withColumn("period", month_of(F.col(SEQ)))
    store.write(placed, "moments", batch_id)
    fresh = _table(spark, f"{base}/delta/moments", TABLES["moments"][0], ["batch", "bucket", "period"])
    fresh = fresh.where(F.col("batch") == batch_id).drop("batch", "period")
    touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]  # at most `buckets` numbers

    seen: dict[str, int] = {}
    starts = _starts(store, fresh, touched, batch_id, seen)
    rows = freeze(_rows(store, fresh, starts, batch_id, seen))
    moments = rows.drop("bucket")
    versions = freeze(scd2(moments, [KEY], SEQ, TRACK, F.col("gone"), ["gone"])).withColumn("bucket", bucket_of(KEY, buckets))
    store.write(versions.withColumn("until", F.coalesce(month_of(F.col(END)), F.lit(OPEN))), "versions", batch_id)
    store.write(starts.select(KEY, "bucket", "cut"), "cuts", batch_id)
    last = rows.groupBy("bucket", KEY).agg(F.max(F.struct(SEQ, "gone", *TRACK, *OTHERS)).alias("x")).select("bucket", KEY, "x.*")
    opened = versions.where(F.col(END).isNull()).select(F.col(KEY).alias("_key"), F.col(START).alias("start"))
    store.write(last.join(opened, F.col(KEY) == F.col("_key"), "left").drop("_key"), "heads", batch_id)

    counts = {r.bucket: r.n for r in versions.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    read = [seen.get(t, 0) for t in ("heads", "versions", "moments")]
    marks = [(b, counts.get(b, 0), *read) for b in touched] or [(None, 0, *read)]
    spark.createDataFrame(marks, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{base}/manifest/batch={batch_id}")
    compact(spark, base, compact_rows)


def _starts(store: Store, fresh: DataFrame, touched: list[int], batch_id: int, seen: dict[str, int]) -> DataFrame:
    """A row for each customer of a batch: its head, whether a change is late, and from which start on versions are replaced."""
    wanted = dict.fromkeys(touched, "")
    # counted from the files' footers
    seen["heads"] = store.read("heads", batch_id, wanted).count()
    heads = store.newest_heads(batch_id, wanted)
    heads = heads.select(F.struct(F.col(KEY).alias("k")).alias("_cell"), F.struct(SEQ, "gone", *TRACK, *OTHERS, "start").alias("head"))
    keys = fresh.groupBy("bucket", KEY).agg(F.min(SEQ).alias("since"))
    keys = keys.join(heads, F.struct(F.col(KEY).alias("k")) == F.col("_cell"), "left").drop("_cell")
    keys = freeze(keys.withColumn("late", F.coalesce(F.col("since") <= F.col(f"head.{SEQ}"), F.lit(False))))
    continued = F.coalesce(F.col("head.start"), F.col("since"))
    ordered = keys.where("NOT late").withColumn("cut", continued)
    firsts = {r.bucket: r.m for r in keys.where("late").groupBy("bucket").agg(month_of(F.min("since")).alias("m")).collect()}
    if not firsts:
        return ordered
    seen["versions"] = store.read("versions", batch_id, firsts).count()
    held = store.valid_versions(batch_id, firsts).select(
        F.struct(F.col(KEY).alias("k")).alias("_cell"), F.col(START).alias("_start"), F.col(END).alias("_end")
    )
    # the version in force before the change: one a customer at most
    inside = (F.struct(F.col(KEY).alias("k")) == F.col("_cell")) & (F.col("_start") < F.col("since")) & (
        F.col("_end").isNull() | (F.col("_end") >= F.col("since"))
    )
    late = keys.where("late").join(held, inside, "left").withColumn("cut", F.coalesce("_start", "since")).select(*ordered.columns)
    return freeze(ordered.unionByName(late))


def _rows(store: Store, fresh: DataFrame, starts: DataFrame, batch_id: int, seen: dict[str, int]) -> DataFrame:
    """The changes that make the replaced versions anew: a head as a change at its version's start, or those read again."""
    columns = ["bucket", KEY, SEQ, "gone", *TRACK, *OTHERS]
    ordered = starts.where("NOT late")
    heads = ordered.where("head.start IS NOT NULL").select(
        "bucket", KEY, F.col("head.start").alias(SEQ), F.lit(False).alias("gone"), *(F.col(f"head.{c}").alias(c) for c in (*TRACK, *OTHERS))
    )
    cell = F.struct(F.col(KEY).alias("k"))
    new = fresh.join(ordered.select(cell.alias("_cell")), cell == F.col("_cell")).select(*columns)
    out = heads.unionByName(new)
    late = starts.where("late")
    firsts = {r.bucket: r.m for r in late.groupBy("bucket").agg(month_of(F.min("cut")).alias("m")).collect()}
    if firsts:
        again = store.read("moments", batch_id + 1, firsts)
        seen["moments"] = again.count()
        again = again.join(late.select(cell.alias("_cell"), "cut"), (cell == F.col("_cell")) & (F.col(SEQ) >= F.col("cut")))
        out = out.unionByName(again.select(*columns))
    return out


def compact(spark: SparkSession, base: str, least: int = 0) -> list[int]:
    """Write one segment for each bucket whose deltas hold at least as many versions as its base, and at least `least`.

    Gives those buckets. The mark is written last: until then readers go on with the old base and the deltas.
    """
    store = Store(spark, base)
    upto, segments = store.committed(), store.segments
    rows = store.manifest().where("bucket IS NOT NULL").groupBy("bucket", "batch").agg(F.sum("n_versions").alias("n"))
    past = [F.col("bucket").isin(bs) & (F.col("batch") <= u) for u, bs in _grouped({b: u for b, (u, _) in segments.items()})]
    rows = rows.where(~reduce(lambda a, b: a | b, past, F.lit(False))).groupBy("bucket").agg(F.sum("n").alias("n"))
    due = [r.bucket for r in rows.collect() if r.n >= max(least, segments.get(r.bucket, (0, 0))[1])]
    if not due:
        return due
    since = dict.fromkeys(due, "")
    versions = store.valid_versions(upto + 1, since).drop("batch").withColumn("until", F.coalesce(month_of(F.col(END)), F.lit(OPEN)))
    for name, table in (("versions", versions), ("heads", store.newest_heads(upto + 1, since))):
        table.write.mode("overwrite").partitionBy("bucket", *TABLES[name][1]).parquet(f"{base}/base/{name}/upto={upto}")
    written = _table(spark, f"{base}/base/versions", TABLES["versions"][0], ["upto", "bucket", "until"])
    counts = written.where(F.col("upto") == upto).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    counts = {r.bucket: r.n for r in counts.collect()}
    marks = spark.createDataFrame([(b, counts.get(b, 0)) for b in due], COMPACTED)
    marks.coalesce(1).write.mode("append").parquet(f"{base}/compacted/upto={upto}")
    return due


def read_history(spark: SparkSession, base: str) -> DataFrame:
    store = Store(spark, base)
    return store.valid_versions(store.committed() + 1).select(*HISTORY.names)


def work_log(spark: SparkSession, base: str) -> DataFrame:
    """batch, the versions it wrote and the rows it read of heads, versions and earlier changes."""
    sums = [F.max(f"{t}_read").alias(f"{t}_read") for t in ("heads", "versions", "moments")]
    return Store(spark, base).manifest().groupBy("batch").agg(F.sum("n_versions").alias("n_versions"), *sums)


def follow_changes(
    spark: SparkSession, landing: str, base: str, checkpoint: str, max_files: int | None = None, buckets: int = 64,
    compact_rows: int = 100_000,
) -> None:
    """Apply all change files that have arrived, in micro-batches."""
    query = (
        stream_changes(spark, landing, max_files)
        .writeStream.foreachBatch(lambda df, batch_id: apply_changes(df, batch_id, base, buckets, compact_rows))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
