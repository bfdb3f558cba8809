"""Files out: partitioned Parquet, small CSV summaries, report folders, copies and normalised tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.cleaning import dedup_first


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Parquet by folder. Rows are gathered per folder; a folder with very many rows is split over tasks."""
    gathered = df.hint("rebalance", *by)
    gathered.write.mode("overwrite").partitionBy(*by).parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, by: Sequence[str] = ()) -> DataFrame:
    """A catalogue table at a path, in buckets of the key sorted by it, so that joins on it need neither shuffle nor sort.

    Tables that are joined need the same number of buckets. One task writes a bucket, so the file of a bucket and folder is one
    and stays sorted; a key with a large share of all rows makes its bucket large, which is why orders are bucketed by
    their id and not by customer.
    """
    dealt = df.repartition(buckets, key)
    writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path)
    (writer.partitionBy(*by) if by else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def reload_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace the folders that df has rows for, and leave all others as they are."""
    gathered = df.hint("rebalance", *by)
    gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def sorted_by(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Sorted by the named columns, those with a minus sign from the largest down."""
    return df.orderBy(*[F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in order])


SMALL = 1_000_000


def write_single_csv(df: DataFrame, path: str, max_rows: int = SMALL) -> None:
    """One CSV file, for results that grouping or a limit keeps small; it is written by one task.

    More than max_rows are refused: the write stops one row beyond, and the path keeps what it held before. The rows are
    counted as they are written, and the work before the last shuffle stays spread.
    """
    spark, counted, aside = df.sparkSession, Observation(), f"{path.rstrip('/')}-unfinished"
    rows = df.limit(max_rows + 1).coalesce(1).observe(counted, F.count(F.lit(1)).alias("n"))
    rows.write.mode("overwrite").option("header", True).csv(aside)
    folder, target = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (aside, path))
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if counted.get["n"] > max_rows:
        fs.delete(folder, True)
        raise ValueError(f"more than {max_rows} rows for the single file {path}")
    fs.delete(target, True)
    fs.rename(folder, target)


def export_reports(
    reports: Mapping[str, DataFrame], out: str, order: Mapping[str, Sequence[str]] | None = None
) -> dict[str, str]:
    """One CSV file per named report in a folder of its own, sorted as order says; gives the folder of each."""
    paths = {name: f"{out.rstrip('/')}/{name}" for name in reports}
    for name, df in reports.items():
        by = (order or {}).get(name)
        write_single_csv(sorted_by(df, by) if by else df, paths[name])
    return paths


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """Write a copy and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def insert_rows(df: DataFrame, rows: Sequence[tuple]) -> DataFrame:
    """The table with a few literal rows added, checked against its schema."""
    return df.unionByName(df.sparkSession.createDataFrame(list(rows), df.schema))


class CopyError(RuntimeError):
    """The copy differs from its source."""


@dataclass(frozen=True)
class CopySummary:
    """What a data set holds: rows, columns and types, and for every source file a digest of its content."""

    n_rows: int
    columns: tuple[tuple[str, str], ...]
    files: frozenset[tuple]


def _hashed(name: str, kind: T.DataType) -> list[Column]:
    """A column for xxhash64, which skips NULL and takes no maps."""
    value = F.col(f"`{name}`")
    if isinstance(kind, T.MapType):
        value = F.array_sort(F.map_entries(value))
    return [value, value.isNull()]


LOW = 0xFFFFFFFF


def digests(rows: DataFrame, at: Column, by: Callable[[Column], Column], schema: T.StructType | None = None) -> DataFrame:
    """file, n_rows, and sums of hashes that don't depend on the order of rows: of whole rows, and of each column.

    The sums of columns tell where a difference is; that of the rows also tells values that have changed places. Rows are
    summed by `at` as it stands, a name that the scan gives, and `by` makes the file's name of it once per sum. Both halves of
    a hash are summed as whole numbers, exactly, and put together as DECIMAL after that; beyond 2^31 rows they raise.
    """
    columns = {f.name: _hashed(f.name, f.dataType) for f in (schema or rows.schema).fields}
    parts = [[x for c in columns.values() for x in c], *columns.values()]
    hashes = rows.select(at.alias("_at"), *[F.xxhash64(*c).alias(f"_{i}") for i, c in enumerate(parts)])
    halves = [x for i in range(len(parts)) for x in (
        F.sum(F.shiftright(f"_{i}", 32)).alias(f"_high_{i}"), F.sum(F.col(f"_{i}").bitwiseAND(F.lit(LOW))).alias(f"_low_{i}")
    )]
    found = hashes.groupBy("_at").agg(F.count(F.lit(1)).alias("_n"), *halves)

    def total(i: int) -> Column:
        return F.sum(F.col(f"_high_{i}").cast("decimal(38,0)") * F.lit(LOW + 1) + F.col(f"_low_{i}")).cast("decimal(38,0)")

    sums = F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*[total(i + 1) for i in range(len(columns))]))
    return found.groupBy(by(F.col("_at")).alias("file")).agg(F.sum("_n").alias("n_rows"), total(0).alias("rows"), sums.alias("columns"))


def _summary(rows: DataFrame, found: list) -> CopySummary:
    columns = tuple((f.name, f.dataType.simpleString()) for f in rows.schema)
    files = frozenset((r["file"], r["n_rows"], r["rows"], tuple(sorted(r["columns"].items()))) for r in found)
    return CopySummary(sum(r["n_rows"] for r in found), columns, files)


def _compare(before: CopySummary, after: CopySummary, source: str) -> None:
    if before == after:
        return
    if before.columns != after.columns:
        raise CopyError(f"copy of {source} has other columns: {before.columns} / {after.columns}")
    there = {f[0]: f for f in after.files}
    for file, n, _, columns in sorted(before.files - after.files):
        if file not in there:
            raise CopyError(f"copy of {source} lacks the {n} rows of file {file}")
        odd = [c for (c, x), (_, y) in zip(columns, there[file][3]) if x != y]
        raise CopyError(f"copy of {source} differs in file {file}: {n} / {there[file][1]} rows, columns {odd or 'alike, but rows mixed up'}")
    raise CopyError(f"copy of {source} has more files")


def verify_copy(spark: SparkSession, source: str, target: str) -> tuple[CopySummary, CopySummary]:
    """Read both sides and compare their content file by file; a difference raises.

    The digests, one row per file, are compared on the driver.
    """
    rows, copy = spark.read.parquet(source), spark.read.parquet(target)
    before = _summary(rows, digests(rows, F.col("_metadata.file_path"), F.sha1).collect())
    after = _summary(copy, digests(copy, F.col("_metadata.file_name"), lambda x: F.regexp_extract(x, "^([0-9a-f]{40})-", 1)).collect())
    _compare(before, after, source)
    return before, after


COPIED = "path string"


def copy_dataset(spark: SparkSession, source: str, target: str, step: int = 200) -> tuple[CopySummary, CopySummary]:
    """Copy a Parquet data set file by file and compare both sides by content; a mismatch raises.

    Each step copies up to `step` files to a folder beside the target, holds their digests against the source, moves them and
    then notes them in the manifest (target-manifest). A copy that broke off goes on with the files that are not noted.
    A target file is named by its source file, whatever tasks wrote it.
    """
    rows = spark.read.parquet(source)
    paths = sorted(rows.inputFiles())
    jvm = spark.sparkContext._jvm
    path_of = jvm.org.apache.hadoop.fs.Path
    folder, manifest, staged = path_of(target), f"{target.rstrip('/')}-manifest", f"{target.rstrip('/')}-staged"
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    fs.mkdirs(path_of(manifest))
    noted = {r["path"] for r in spark.read.schema(COPIED).parquet(manifest).collect()}
    left = [p for p in paths if p not in noted]
    if not paths or not rows.take(1):
        raise CopyError(f"{source} has no rows")
    for at in range(0, len(left), step):
        part = spark.read.option("basePath", source).schema(rows.schema).parquet(*left[at:at + step])
        path = F.col("_metadata.file_path")
        part.withColumn("_file", F.sha1(path)).write.mode("overwrite").partitionBy("_file").parquet(staged)
        written = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("_file", T.StringType())])).parquet(staged)
        found = digests(part, path, F.sha1).collect()
        _compare(_summary(part, found), _summary(rows, digests(written, F.col("_file"), lambda x: x, rows.schema).collect()), source)
        for status in fs.listStatus(path_of(staged)):
            if not status.isDirectory():
                continue
            stem = status.getPath().getName().split("=")[1]
            for old in fs.globStatus(path_of(f"{target}/{stem}-*.parquet")):
                fs.delete(old.getPath(), True)
            pieces = fs.globStatus(path_of(f"{status.getPath()}/*.parquet"))
            for i, piece in enumerate(pieces):
                fs.rename(piece.getPath(), path_of(f"{target}/{stem}-{i}.parquet"))
        spark.createDataFrame([(p,) for p in left[at:at + step]], COPIED).coalesce(1).write.mode("append").parquet(manifest)
        fs.delete(path_of(staged), True)
    return verify_copy(spark, source, target)


def split_sales(wide: DataFrame, order: Sequence[str]) -> dict[str, DataFrame]:
    """Customers, products and facts of wide sales rows; per key the latest row's attributes win."""
    customer = ["customer_id", "customer_name", "segment", "city", "region"]
    product = ["product_id", "product_name", "category", "sub_category"]
    facts = [c for c in wide.columns if c not in {*customer[1:], *product[1:]}]

    def dimension(columns: list[str]) -> DataFrame:
        latest = dedup_first(wide.select(*dict.fromkeys([*columns, *order])), columns[:1], list(order), last=True)
        return latest.select(*columns)

    return {"customers": dimension(customer), "products": dimension(product), "orders": wide.select(*facts)}
