"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't use yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose values in a column take at most limit bytes, or single rows."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    values = batch.column(column)
    size = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
    start = total = 0
    for i, n in enumerate(size.to_pylist()):
        n = n or 0
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    yield batch.slice(start)


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """run for mapInArrow, with the memory that earlier tasks of the same worker have left given back to the system first.

    Workers are used again from stage to stage, and what their caches took would otherwise stay with the executor.
    """

    def started(batches):
        import ctypes
        import gc

        import pyarrow as pa

        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass
        yield from run(batches)

    return started


def bounded_sample(df: DataFrame, group: str, key: str, per_group: int) -> DataFrame:
    """At most per_group rows of every group, those with the least hash of the key; the same rows each time.

    Rows are first thinned by hash to little more than that number, so the window that makes the bound sees no more
    than it either, however large a group is. Rows without a group or key are left out.
    """
    rows = df.where(F.col(group).isNotNull() & F.col(key).isNotNull()).withColumn("_h", F.xxhash64(key, F.lit("sample")))
    counts = rows.groupBy(F.col(group).alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
    share = F.least(F.lit(1.0), per_group * 1.1 / F.col("_n"))
    # one row per group, and the groups are few: grades or languages
    near = rows.join(F.broadcast(counts), F.col(group) == F.col("_g")).where(F.pmod(F.col("_h"), F.lit(1 << 32)) < share * (1 << 32))
    order = Window.partitionBy(group).orderBy("_h", key)
    return near.withColumn("_i", F.row_number().over(order)).where(F.col("_i") <= per_group).select(df.columns)


def share(spark: SparkSession, value: object) -> Callable[[], object]:
    """Broadcast a value of fixed size once; the result, called in a task, gives it there."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(sent.value)
